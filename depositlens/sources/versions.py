"""Tables that are never absent: each write makes a new version beside the old one, and a view names the current one.

A version is an ordinary table ``<name>__v<number>``. The view ``<name>`` is replaced by one catalog change once the version is whole, so a reader gets the
rows before or after it, and a write that fails leaves the view as it was. The version before the current one stays for readers that have begun with it; older
ones, and what failed writes left, go at the next change. The view keeps its comment, column comments and tags from one version to the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MARK = "__v"
CURRENT, PREVIOUS = "current_version", "previous_version"


def quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def full_name(database: str, name: str) -> str:
    return f"`{database}`.`{name}`"


def is_view(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW"


def properties(spark: SparkSession, view: str) -> dict[str, str]:
    found = spark.sql(f"SHOW TBLPROPERTIES {view}").collect()
    return {row.key: row.value for row in found if not row.key.startswith("view.") and row.key != "transient_lastDdlTime"}


def current_version(spark: SparkSession, database: str, name: str) -> str | None:
    view = full_name(database, name)
    return properties(spark, view).get(CURRENT) if is_view(spark, view) else None


def write_version(df: DataFrame, database: str, name: str, partition_by: str | None = None) -> str:
    """Write ``df`` as a new version of the table, in the session's format, and return the version's name. Nothing reads it yet.

    Rows are counted on their way into the files and in the table afterwards. If the numbers differ, the rows are counted once more, since tasks that a
    lost executor made run twice count twice on the way; a table that lacks rows even so is dropped, like one whose write failed, and is an error.
    """
    spark = df.sparkSession
    version = f"{name}{MARK}{uuid.uuid4().hex}"
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        # Neither scattered over one file per task nor squeezed into one task when it is hot: adaptive execution splits large partitions.
        writer = writer.hint("rebalance", partition_by)
    writer = writer.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    try:
        writer.saveAsTable(full_name(database, version))
        written = spark.table(full_name(database, version)).count()
        if written != counted.get["rows"] and written != (expected := df.count()):
            raise RuntimeError(f"{name}: {written} of {expected} rows were written")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {full_name(database, version)}")
        raise
    return version


def publish(spark: SparkSession, database: str, versions: Mapping[str, str]) -> None:
    """Make these versions (by table name) the current ones, one catalog change each, right after one another; older ones go."""
    for name, version in versions.items():
        view = full_name(database, name)
        before = properties(spark, view) if is_view(spark, view) else {}
        if not before and spark.catalog.tableExists(view):  # a plain table from before there were versions
            before = {CURRENT: f"{name}{MARK}0"}
            spark.sql(f"ALTER TABLE {view} RENAME TO {full_name(database, before[CURRENT])}")
        comments = {column.name: column.description for column in spark.catalog.listColumns(view)} if CURRENT in before and is_view(spark, view) else {}
        about = spark.catalog.getTable(view).description if comments else None
        point(spark, database, name, version, before | {PREVIOUS: before.get(CURRENT, "")}, comments, about)
    for name, version in versions.items():
        keep = {version, properties(spark, full_name(database, name)).get(PREVIOUS)}
        for table in versions_of(spark, database, name):
            if table not in keep:
                spark.sql(f"DROP TABLE IF EXISTS {full_name(database, table)}")


def point(
    spark: SparkSession,
    database: str,
    name: str,
    version: str,
    tags: Mapping[str, str],
    comments: Mapping[str, str | None],
    about: str | None,
) -> None:
    """The view ``name`` on ``version``, with properties, column comments and a comment."""
    columns = spark.table(full_name(database, version)).columns
    listed = ", ".join(f"`{column}`" + (f" COMMENT {quoted(comments[column])}" if comments.get(column) else "") for column in columns)
    held = ", ".join(f"{quoted(key)} = {quoted(value)}" for key, value in {**tags, CURRENT: version}.items() if key != "comment")
    comment = f" COMMENT {quoted(about)}" if about else ""
    spark.sql(f"CREATE OR REPLACE VIEW {full_name(database, name)} ({listed}){comment} TBLPROPERTIES ({held}) AS SELECT * FROM {full_name(database, version)}")


def versions_of(spark: SparkSession, database: str, name: str) -> list[str]:
    tables = spark.sql(f"SHOW TABLES IN `{database}` LIKE {quoted(name + MARK + '*')}").collect()
    return [row.tableName for row in tables if row.tableName.startswith(name.lower() + MARK) or row.tableName.startswith(name + MARK)]
