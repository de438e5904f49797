"""What the columns of a table hold: distinct values, quantiles and frequent values, from sketches that can be merged.

Every cell goes into a small number of buckets, and a bucket keeps a count, a least hash and an extent. These merge in any order, so each
task sends one row per bucket it has met, however many rows it reads and whatever value a third of them holds.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTER_DIGITS, HASH_DIGITS = 3, 12  # hexadecimal digits of a digest: 4096 registers, hashes of 48 bits
REGISTERS, HASHES = 16**REGISTER_DIGITS, 16**HASH_DIGITS
WIDTH = 1.01  # a bucket of numbers ends 1 % above its start
SECONDS = 3600  # a bucket of timestamps is an hour
NOT_HASHED = -1
_HASHED, _PRESENT, _NUMBER = 0, 1, 2
LEAST_ONE_IN = 1000
_INDEX_SHIFT, _BEYOND = 100_000, 1_000_000

_TIMES = (T.TimestampType, T.TimestampNTZType)
_MEASURED = (T.NumericType, T.DateType, *_TIMES)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)


def _fields(df: DataFrame) -> list[T.StructField]:
    """The columns with a text form that equal values share; nested and binary columns have none."""
    return [field for field in df.schema.fields if not isinstance(field.dataType, _NESTED)]


def _value(field: T.StructField) -> Column:
    return F.col(f"`{field.name}`")


def _text(field: T.StructField) -> Column:
    value = _value(field)
    if isinstance(field.dataType, T.FloatType | T.DoubleType):
        value = value + F.lit(0.0).cast(field.dataType)  # -0.0 is 0.0
    return value.cast("string")


def _register(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, REGISTER_DIGITS), 16, 10).cast("int")


def _hash(digest: Column) -> Column:
    return F.conv(F.substring(digest, REGISTER_DIGITS + 1, HASH_DIGITS), 16, 10).cast("long")


def _number(field: T.StructField) -> Column:
    """The value as a double: itself, days since 1970, seconds since 1970."""
    value = _value(field)
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(field.dataType, _TIMES):
        return F.unix_micros(value.cast("timestamp")) / F.lit(1e6)
    return value.cast("double")


def _unit(field: T.StructField) -> float | None:
    """The width of a bucket that has a fixed one: a day, an hour."""
    if isinstance(field.dataType, T.DateType):
        return 1.0
    return SECONDS if isinstance(field.dataType, _TIMES) else None


def _bucket(number: Column, unit: Column) -> Column:
    """Buckets in the order of their numbers: of a fixed width, or numbers of one sign within a hundredth of each other."""
    size = F.abs(number)
    endless = F.isnan(number) | (size == math.inf)
    usual = F.when(~endless & (size > 0), size).otherwise(1.0)
    index = F.ceil(F.log(usual) / math.log(WIDTH)) + _INDEX_SHIFT
    return (
        F.when(unit.isNotNull(), F.floor(number / unit))
        .when(F.isnan(number), _BEYOND + 1)
        .when(endless, F.signum(number) * _BEYOND)
        .when(number == 0, 0)
        .otherwise(F.signum(number) * index)
        .cast("long")
    )


def _cells(entries: list[Column], df: DataFrame) -> DataFrame:
    return df.select(F.explode(F.array(*entries)).alias("cell")).select("cell.*")


def column_sketch(df: DataFrame) -> DataFrame:
    """(place, register, bucket, row_count, least_hash, least, largest): the sketch of every column, by its place in the table.

    A row has either a register (of the values' hashes; -1 in nested columns) or a bucket (of numbers and dates); missing values are in the row with neither. Sketches of parts of
    a table merge by the same sums, least and largest values. One aggregation: a column leaves at most 4096 registers a task, and
    the buckets its numbers reach.
    """

    entries = []
    for place, field in enumerate(df.schema.fields):

        def entry(kind: int, text: Column | None = None, number: Column | None = None, unit: float | None = None) -> Column:
            given = {"place": (place, "int"), "kind": (kind, "int"), "unit": (unit, "double")}  # noqa: B023
            fixed = (F.lit(value).cast(type_).alias(name) for name, (value, type_) in given.items())
            return F.struct(*fixed, (F.lit(None).cast("string") if text is None else text).alias("text"), (F.lit(None).cast("double") if number is None else number).alias("number"))

        if isinstance(field.dataType, _NESTED):
            entries.append(entry(_PRESENT, F.when(_value(field).isNotNull(), F.lit(""))))
        else:
            entries.append(entry(_HASHED, _text(field)))
        if isinstance(field.dataType, _MEASURED):
            entries.append(entry(_NUMBER, number=_number(field), unit=_unit(field)))
    # Digests and buckets come after the explode: one short expression for all columns instead of one long one per column.
    digested = _cells(entries, df).where((F.col("kind") != _NUMBER) | F.col("number").isNotNull()).withColumn("digest", F.md5(F.col("text").cast("binary")))
    here = F.col("text").isNotNull()
    cells = digested.select(
        "place",
        F.when(here, F.when(F.col("kind") == _PRESENT, NOT_HASHED).otherwise(_register(F.col("digest")))).alias("register"),
        _bucket(F.col("number"), F.col("unit")).alias("bucket"),
        F.when(here & (F.col("kind") == _HASHED), _hash(F.col("digest"))).alias("hashed"),
        "number",
    )
    return cells.groupBy("place", "register", "bucket").agg(
        F.count("*").alias("row_count"),
        F.min("hashed").alias("least_hash"),
        F.min("number").alias("least"),
        F.max("number").alias("largest"),
    )


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """The sketch of all rows together, of tables with the same columns."""
    return (
        reduce(DataFrame.unionByName, sketches)
        .groupBy("place", "register", "bucket")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.min("least_hash").alias("least_hash"),
            F.min("least").alias("least"),
            F.max("largest").alias("largest"),
        )
    )


def _shown(fields: list[T.StructField], number: Column) -> Column:
    """A number of a column as text in the column's own type."""
    text = F.lit(None).cast("string")
    kinds = {field.dataType for field in fields if isinstance(field.dataType, _MEASURED)}
    for kind in sorted(kinds, key=str):
        places = [place for place, field in enumerate(fields) if field.dataType == kind]
        if isinstance(kind, T.DateType):
            own = F.date_from_unix_date(number.cast("int")).cast("string")
        elif isinstance(kind, _TIMES):
            own = F.timestamp_micros(F.round(number * 1e6).cast("long")).cast(kind).cast("string")
        else:
            own = number.try_cast(kind).cast("string")
        text = F.when(F.col("place").isin(places), own).otherwise(text)
    return text


def read_sketch(sketch: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per column of ``schema``, as ``column_profile`` gives it, from a sketch of a table."""
    fields = schema.fields
    ranked = sketch.withColumn(
        "upto", F.sum(F.when(F.col("bucket").isNotNull(), F.col("row_count"))).over(Window.partitionBy("place").orderBy(F.col("bucket").asc_nulls_first()))
    ).withColumn("measured", F.sum(F.when(F.col("bucket").isNotNull(), F.col("row_count"))).over(Window.partitionBy("place")))
    at = lambda quarter: F.min(
        F.when(F.col("bucket").isNotNull() & (F.col("upto") >= F.ceil(F.col("measured") * quarter / 4)), F.struct("bucket", "largest"))
    )["largest"]
    hashed, whole = F.col("register") >= 0, F.col("bucket").isNull()
    missing = whole & F.col("register").isNull()
    totals = ranked.groupBy("place").agg(
        F.coalesce(F.sum(F.when(whole, F.col("row_count"))), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(missing, F.col("row_count"))), F.lit(0)).alias("null_count"),
        F.count_if(hashed).alias("filled"),
        F.coalesce(F.sum("least_hash"), F.lit(0)).alias("hashes"),
        F.min(F.when(F.col("bucket").isNotNull(), F.struct("bucket", "least")))["least"].alias("smallest"),
        at(1).alias("lower_quartile"), at(2).alias("median"), at(3).alias("upper_quartile"), at(4).alias("largest"),
    )
    waited = F.col("hashes").cast("double") + (REGISTERS - F.col("filled")).cast("double") * float(HASHES)
    distinct = F.round(F.col("filled") * float(REGISTERS * HASHES) / waited).cast("long")
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("place") + 1)
    nested = [place for place, field in enumerate(fields) if isinstance(field.dataType, _NESTED)]
    every = sketch.sparkSession.range(len(fields), numPartitions=1).select(F.col("id").cast("int").alias("place"))
    quantiles = ["smallest", "lower_quartile", "median", "upper_quartile", "largest"]
    return every.join(totals, "place", "left").select(
        of([field.name for field in fields]).alias("column_name"),
        of([field.dataType.simpleString() for field in fields]).alias("data_type"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("null_count", F.lit(0)).alias("null_count"),
        F.when(~F.col("place").isin(nested), F.coalesce(distinct, F.lit(0))).alias("distinct_estimate"),
        *(_shown(fields, F.col(name)).alias(name) for name in quantiles),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, missing values, an estimate of the distinct values, and extremes and quartiles as text in the column's type.

    The estimate has a standard error of at most 1/64 (1.6 %) at any number of values, and is exact for a few: each of 4096 registers keeps its least hash, and
    the estimate is the rate at which hashes arrive, over registers with and without one. A quartile is a value of the column whose rank is at least
    the one asked for: at most 1 % from the exact one for numbers, an hour for timestamps, exact for dates. Numbers are compared as doubles; NaN comes last.
    Text has no quartiles; nested and binary columns have rows and missing values only. An empty table has a row per column, with zeros.
    """
    return read_sketch(column_sketch(df), df.schema)


def frequent_values(df: DataFrame, one_in: int = 100) -> DataFrame:
    """(column_name, value, value_count): every value, as text, that at least one of ``one_in`` rows holds, with its exact number of rows.

    A value that frequent makes its register that frequent, so only values in such registers are counted: at most ``one_in`` registers a column,
    which is the bound of the broadcast. Both passes count in the task first. Missing values are not values; nested and binary columns are left out.
    """
    if not 1 <= one_in <= LEAST_ONE_IN:
        raise ValueError(f"one_in is between 1 and {LEAST_ONE_IN}")
    fields = _fields(df)

    if not fields:
        return df.sparkSession.createDataFrame([], "column_name string, value string, value_count long")
    values = _cells([F.struct(F.lit(place).alias("place"), _text(field).alias("value")) for place, field in enumerate(fields)], df)
    cells = values.withColumn("register", _register(F.md5(F.col("value").cast("binary"))))
    counted = cells.groupBy("place", "register").agg(F.count("*").alias("n"))
    rows = counted.withColumn("row_count", F.sum("n").over(Window.partitionBy("place")))
    heavy = rows.where(F.col("register").isNotNull() & (F.col("n") * one_in >= F.col("row_count"))).drop("n")
    names = F.element_at(F.array(*(F.lit(field.name) for field in fields)), F.col("place") + 1)
    return (
        cells.where("register IS NOT NULL")
        .join(F.broadcast(heavy), ["place", "register"])
        .groupBy("place", "value")
        .agg(F.count("*").alias("value_count"), F.first("row_count").alias("row_count"))
        .where(F.col("value_count") * one_in >= F.col("row_count"))
        .select(names.alias("column_name"), "value", "value_count")
    )
