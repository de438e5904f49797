"""The daily job, for spark-submit:

    spark-submit depositlens/plans/daily.py --database bank --segments wealthy mass [--landing /landing]
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from depositlens.functions.dates import AsOf
from depositlens.plans.prepare import prepare_silver
from depositlens.plans.refresh import TARGETS, refresh_gold
from depositlens.schemas import BRONZE, SILVER_DISPLAY_NAMES
from depositlens.session import CLUSTER_CONF
from depositlens.sources.namespace import comment_columns, create_schema, require_delivery, tag_table
from depositlens.sources.tables import ingest_bronze


def run_daily(
    spark: SparkSession,
    database: str,
    segments: Sequence[str],
    landing: str | None = None,
    as_of: AsOf = None,
    tags: Mapping[str, str] | None = None,
) -> list[str]:
    """Create the schema unless it is there, ingest (if there is a landing folder, in which every table must have been delivered), prepare,
    refresh; each step only after the one before.

    The Silver tables and the target list then get their headings as column comments, all written tables the ``tags``.
    """
    create_schema(spark, database, "customers to call")
    if landing:  # before any table changes
        require_delivery(spark, landing, BRONZE)
    bronze = ingest_bronze(spark, landing, database) if landing else []
    silver = prepare_silver(spark, database)
    written = [*bronze, *silver, *refresh_gold(spark, database, segments, as_of)]
    for name in [*silver, TARGETS]:
        comment_columns(spark, f"`{database}`.`{name}`", SILVER_DISPLAY_NAMES)
    if tags:
        for name in written:
            tag_table(spark, f"`{database}`.`{name}`", tags)
    return written


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Regenerate the Silver tables and the dashboard datasets.")
    parser.add_argument("--database", required=True)
    parser.add_argument("--segments", nargs="+", required=True, help="columns of the heat map")
    parser.add_argument("--landing", help="folder with one folder of CSV files per table")
    parser.add_argument("--as-of", help="date that plays today, as YYYY-MM-DD")
    parser.add_argument("--tags", nargs="*", default=[], help="tags of the written tables, as key=value")
    chosen = parser.parse_args(arguments)
    own = SparkSession.builder.appName("depositlens daily").config(map=CLUSTER_CONF)
    spark = SparkSession.getActiveSession() or own.getOrCreate()  # a session that is there keeps its settings
    tags = dict(tag.split("=", 1) for tag in chosen.tags)
    for name in run_daily(spark, chosen.database, chosen.segments, chosen.landing, chosen.as_of, tags):
        print(f"{chosen.database}.{name}")


if __name__ == "__main__":
    main()
