"""Catalog, schema, landing folder, comments and tags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

from depositlens.sources.versions import CURRENT, full_name, is_view, point, properties, versions_of
from depositlens.sources.versions import quoted as _text


def use_catalog(spark: SparkSession, catalog: str) -> None:
    spark.catalog.setCurrentCatalog(catalog)


def create_schema(spark: SparkSession, schema: str, comment: str = "", location: str | None = None) -> None:
    """Create the schema unless it exists. ``location`` places its tables, e.g. below the shared folder."""
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}` COMMENT {_text(comment)}{place}")


def use_schema(spark: SparkSession, schema: str) -> None:
    spark.catalog.setCurrentDatabase(schema)


def landing_path(root: str, schema: str) -> str:
    """Folder for the source files of a schema."""
    return f"{root.rstrip('/')}/{schema}/source_files"


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def create_landing(spark: SparkSession, root: str, schema: str, tables: Iterable[str]) -> str:
    """Make the landing folder of a schema, with a folder for each table, unless they are there; returns its path."""
    path = landing_path(root, schema)
    for table in tables:
        store, place = _store(spark, f"{path}/{table}")
        store.mkdirs(place)
    return path


def landing_files(spark: SparkSession, landing: str, tables: Iterable[str]) -> dict[str, int]:
    """Bytes delivered for each table: files below its folder, without hidden ones; -1 if the folder is not there."""
    found = {}
    for table in tables:
        store, place = _store(spark, f"{landing.rstrip('/')}/{table}")
        if not store.exists(place):
            found[table] = -1
            continue
        files = [status for status in store.listStatus(place) if status.isFile()]
        found[table] = sum(status.getLen() for status in files if status.getPath().getName()[0] not in "._")
    return found


def require_delivery(spark: SparkSession, landing: str, tables: Iterable[str]) -> None:
    """Raise an error that names the tables for which nothing has been delivered."""
    missing = [table for table, size in landing_files(spark, landing, tables).items() if size <= 0]
    if missing:
        raise FileNotFoundError(f"nothing in {landing} for {', '.join(sorted(missing))}")


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop the table, with all its versions if it has any."""
    if not is_view(spark, table):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        return
    found = spark.catalog.getTable(table)
    database = found.namespace[-1]
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    for version in versions_of(spark, database, found.name):
        spark.sql(f"DROP TABLE IF EXISTS {full_name(database, version)}")


def reset_schema(spark: SparkSession, schema: str) -> None:
    """Drop the schema with everything in it, to start over."""
    spark.sql(f"DROP SCHEMA IF EXISTS `{schema}` CASCADE")


def _repoint(spark: SparkSession, view: str, comments: Mapping[str, str], about: str | None = None) -> None:
    """Comments of a view are part of its definition: write it anew on the same version."""
    found = spark.catalog.getTable(view)
    tags = properties(spark, view)
    held = {column.name: column.description for column in spark.catalog.listColumns(view)}
    point(spark, found.namespace[-1], found.name, tags[CURRENT], tags, held | dict(comments), about or found.description)


def comment_table(spark: SparkSession, table: str, comment: str) -> None:
    if is_view(spark, table):
        _repoint(spark, table, {}, comment)
    else:
        spark.sql(f"COMMENT ON TABLE {table} IS {_text(comment)}")


def comment_columns(spark: SparkSession, table: str, comments: Mapping[str, str]) -> None:
    """Comment the named columns; names the table lacks are passed over."""
    present = {column: comment for column, comment in comments.items() if column in spark.table(table).columns}
    if is_view(spark, table):
        _repoint(spark, table, present)
        return
    for column, comment in present.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {_text(comment)}")


def tag_table(spark: SparkSession, table: str, tags: Mapping[str, str]) -> None:
    pairs = ", ".join(f"{_text(key)} = {_text(value)}" for key, value in tags.items())
    kind = "VIEW" if is_view(spark, table) else "TABLE"
    spark.sql(f"ALTER {kind} {table} SET TBLPROPERTIES ({pairs})")
