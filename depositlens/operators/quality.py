"""Looking at a table: first rows, row counts around a cleansing step, missing values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIFF_BUCKETS = 4096


def preview(df: DataFrame, *order_by: str, rows: int = 20) -> DataFrame:
    """The first rows by a total order, so that the same rows come back each time."""
    return df.orderBy(*order_by).limit(rows)


def row_reconcile(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after a cleansing step, and how many it removed.

    Each side is counted once, without moving rows.
    """
    counts = before.agg(
        F.count("*").alias("rows_before"),
    ).select("rows_before", after.agg(F.count("*")).scalar().alias("rows_after"))
    return counts.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def bucket_digests(df: DataFrame, buckets: int = DIFF_BUCKETS) -> DataFrame:
    """(bucket, rows, first, second): how many rows have a hash that falls into the bucket, and two sums of hashes, whatever the order.

    Every row counts as often as it is there. One pass without moving rows: a task sends a row per bucket.
    """
    whole = [F.lit(name) for name in df.columns] + [F.coalesce(F.to_json(F.struct(F.col(f"`{name}`"))), F.lit("")) for name in df.columns]
    first, second = F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole)
    exact = lambda hashed: F.sum(hashed.cast("decimal(38,0)"))
    return (
        df.select(F.pmod(first, F.lit(buckets)).cast("int").alias("bucket"), first.alias("one"), second.alias("two"))
        .groupBy("bucket")
        .agg(F.count("*").alias("rows"), exact(F.col("one")).alias("first"), exact(F.col("two")).alias("second"))
    )


def row_diff(before: DataFrame, after: DataFrame, *keys: str, buckets: int = DIFF_BUCKETS) -> DataFrame:
    """Which rows a step removed, added or changed: the keys, ``change``, ``changed_columns`` and ``row_count``, how many rows more or fewer.

    Both tables count as multisets. A key with one kind of row gone and one new, as many of each, is ``changed``, with the names of the
    columns that differ, in order; everything else is ``removed`` or ``added``. Columns must be the same; a missing value equals a missing value.

    First both tables are summed up by bucket of a row hash; only rows of buckets whose sums differ are read again and compared whole. Equal tables
    are read once. The numbers of the buckets that differ, ``buckets`` at most, go through the driver; rows never do.
    """
    if before.columns != after.columns or not keys:
        raise ValueError("row_diff needs the same columns on both sides, and a key")
    names = before.columns
    left, right = bucket_digests(before, buckets).alias("l"), bucket_digests(after, buckets).alias("r")
    same = reduce(lambda a, b: a & b, (F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in ("rows", "first", "second")))
    differ = left.join(right, F.col("l.bucket") == F.col("r.bucket"), "full").where(~same)
    opened = [row[0] for row in differ.select(F.coalesce("l.bucket", "r.bucket")).collect()]

    def rows(df: DataFrame, side: int) -> DataFrame:
        whole = [F.lit(name) for name in names] + [F.coalesce(F.to_json(F.struct(F.col(f"`{name}`"))), F.lit("")) for name in names]
        inside = F.pmod(F.xxhash64(*whole), F.lit(buckets)).cast("int").isin(opened)
        return df.where(inside).select(F.struct(*(F.col(f"`{name}`") for name in names)).alias("row"), F.lit(side).alias("side"))

    counted = rows(before, -1).unionByName(rows(after, 1)).groupBy("row").agg(F.sum("side").alias("more")).where("more <> 0")
    key = F.struct(*(F.col(f"row.`{name}`") for name in keys)).alias("key")
    gone, new = F.col("more") < 0, F.col("more") > 0
    by_key = counted.select(key, "row", "more").groupBy("key").agg(
        F.count_if(gone).alias("kinds_gone"), F.count_if(new).alias("kinds_new"), F.sum("more").alias("more"),
        F.sum(F.when(new, F.col("more")).otherwise(0)).alias("rows_new"), F.sum(F.when(gone, -F.col("more")).otherwise(0)).alias("rows_gone"),
        F.min(F.when(gone, F.struct("row"))).alias("old_row"), F.min(F.when(new, F.struct("row"))).alias("new_row"),
    )
    swapped = (F.col("kinds_gone") == 1) & (F.col("kinds_new") == 1) & (F.col("more") == 0)
    differing = F.concat_ws(
        ",", *(F.when(~F.col(f"old_row.row.`{name}`").eqNullSafe(F.col(f"new_row.row.`{name}`")), F.lit(name)) for name in names)
    )
    change = lambda kind, columns, n: F.struct(F.lit(kind).alias("change"), columns.alias("changed_columns"), n.alias("row_count"))
    none = F.lit(None).cast("string")
    found = F.when(swapped, F.array(change("changed", differing, F.col("rows_new")))).otherwise(
        F.array(change("removed", none, F.col("rows_gone")), change("added", none, F.col("rows_new")))
    )
    return by_key.select("key", F.explode(found).alias("c")).where("c.row_count > 0").select("key.*", "c.*")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that several rows have, and how many; a lookup table should have none."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def require_unique(df: DataFrame, name: str, *keys: str) -> None:
    """Raise an error that names some of the repeated keys of a lookup table."""
    repeated = duplicate_keys(df, *keys).limit(5).collect()
    if repeated:
        shown = ", ".join(str(tuple(row)[: len(keys)]) for row in repeated)
        raise ValueError(f"{name} has several rows for {', '.join(keys)}: {shown}")


def null_profile(df: DataFrame) -> DataFrame:
    """Type and missing values of every column, in one pass."""
    stats = df.agg(
        F.count("*").alias("row_count"),
        *(F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in df.columns),
    )
    types = F.create_map(*(F.lit(part) for name, kind in df.dtypes for part in (name, kind)))
    counters = [F.col(f"`{name}`") for name in df.columns]
    return stats.unpivot("row_count", counters, "column_name", "null_count").select(
        "column_name",
        types[F.col("column_name")].alias("data_type"),
        "null_count",
        "row_count",
    )
