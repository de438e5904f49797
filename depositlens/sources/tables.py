"""Table sources and sinks, and the ingest from landing files to Bronze tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depositlens import schemas
from depositlens.sources.files import read_csv
from depositlens.sources.versions import publish, write_version

CONTACT_MONTH = "contact_month"


def load_table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"`{database}`.`{name}`")


def save_table(df: DataFrame, database: str, name: str, partition_by: str | None = None) -> None:
    """Write the whole table anew, in the session's format (``spark.sql.sources.default``, Parquet if unset).

    The rows of before stay readable until the new ones are whole: see :mod:`depositlens.sources.versions`. A partitioned table is rebalanced on its
    partition column first.
    """
    publish(df.sparkSession, database, {name: write_version(df, database, name, partition_by)})


def save_contacts(contacts: DataFrame, database: str, name: str = "contacts_bronze") -> None:
    """Contacts are the table that grows with activity, and are asked for by date: partition by month."""
    dated = contacts.withColumn(CONTACT_MONTH, F.trunc("contact_date", "month"))
    save_table(dated, database, name, partition_by=CONTACT_MONTH)


def save_all(spark: SparkSession, saves: list[Callable[[], None]]) -> None:
    """Run independent writes side by side: the last tasks of one overlap with the first of the next.

    Returns when all are done, and raises the first error if one failed.
    """
    with ThreadPoolExecutor(len(saves)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(save)) for save in saves]:
            done.result()


def ingest_bronze(spark: SparkSession, landing: str, database: str) -> list[str]:
    """Turn ``<landing>/<table>`` CSV files into ``<table>_bronze`` tables; returns the table names."""

    def save(table: str) -> None:
        free_text = table in schemas.FREE_TEXT_TABLES
        df = read_csv(spark, f"{landing}/{table}", schemas.BRONZE[table], free_text)
        if table == "contacts":
            save_contacts(df, database)
        else:
            save_table(df, database, f"{table}_bronze")

    save_all(spark, [partial(save, table) for table in schemas.BRONZE])
    return [f"{table}_bronze" for table in schemas.BRONZE]
