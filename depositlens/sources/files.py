"""CSV files: comma separated, header, UTF-8, quoted text, LF or CRLF line ends."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _options(free_text: bool, encoding: str) -> dict[str, str]:
    return {
        "encoding": encoding,
        "quote": '"',
        "escape": '"',
        "multiLine": str(free_text).lower(),
        "mode": "FAILFAST",
    }


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    free_text: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Scan CSV files with a declared schema.

    A file whose header names other columns, or the same in another order, is an error, and so is a value
    that does not fit its type. An empty cell, quoted or not, is NULL.

    ``free_text`` allows line breaks inside quotes; such files are read as :func:`read_quoted_csv` does. One in another encoding than
    UTF-8 is read whole by a single task: deliver those in many files.
    """
    if free_text and encoding.upper() in ("UTF-8", "UTF8"):
        return read_quoted_csv(spark, path, schema)
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.options(**_options(free_text, encoding)).csv(path)


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files with line breaks inside quotes, each read by as many tasks as it has splits.

    A line break ends a record if the quotes before it, from the start of the file, are even in number: a doubled quote inside a cell does not
    change that. A first pass counts the quotes of every split, and the sums of the splits before it tell how each one begins; the driver gets the offsets of those
    that begin inside quotes, eight bytes for each split of some hundred megabytes at most. The second pass cuts every split into
    records with that, without a shuffle. Only records that cross from one split to the next, two pieces a split at most, are gathered, each by itself.

    Quotes belong around cells, as in RFC 4180: a quote inside a cell without quotes is an error if it leaves the file's quotes odd, else its record
    does not fit the schema. Lines may end in LF or CRLF; empty lines between records are passed over, a byte order mark too. A file without
    a line gives no rows.
    """
    lines = _lines(spark, path)
    sizes = lines.groupBy("file", "start").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("start")
    begun = sizes.select("file", "start", "quotes", (F.sum("quotes").over(before) - F.col("quotes")).alias("earlier"), F.sum("quotes").over(Window.partitionBy("file")).alias("all"))
    inside: dict[str, set[int]] = {}
    for file, start, odd in begun.where("earlier % 2 = 1 OR all % 2 = 1").select("file", "start", F.col("all") % 2 == 1).collect():
        if odd:
            raise ValueError(f"{file}: a quoted cell does not end")
        inside.setdefault(file, set()).add(start)
    shared = spark.sparkContext.broadcast(inside)
    header = schema.names

    # Nested, so that it travels to the executors by value and they need not have this package.
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(file, start, piece, record): 0 a whole record, 1 what a split begins with and another ended with, 2 the open end, 3 both."""
        split: tuple[str, int] | None = None
        held: list[str] = []
        out: list[tuple[str, int, int, str]] = []
        open_ = headed = begun_before = False

        def put(more_follows: bool) -> None:
            nonlocal headed
            record = "\n".join(held)
            if not headed:
                headed = True
                names = next(csv.reader([record.removeprefix("\ufeff").removesuffix("\r")]), [])
                if [name.strip().lower() for name in names] != [name.lower() for name in header]:
                    raise ValueError(f"{split[0]}: its header is {names}, not {header}")
            elif begun_before or more_follows or record not in ("", "\r"):
                out.append((*split, begun_before + 2 * more_follows, record))
            held.clear()

        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("file", "start", "line", "quotes"))
            for file, start, line, quotes in zip(*columns, strict=True):
                if (file, start) != split:
                    if held:
                        put(True)
                    split, headed = (file, start), start > 0
                    open_ = begun_before = start in shared.value.get(file, ())
                held.append(line)
                open_ ^= quotes & 1
                if not open_:
                    put(False)
                    begun_before = False
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*out, strict=True)], ["file", "start", "piece", "record"])
                out.clear()
        if held:
            put(True)
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*out, strict=True)], ["file", "start", "piece", "record"])

    pieces = lines.mapInArrow(cut, "file string, start bigint, piece bigint, record string")
    records = pieces.where("piece = 0").select("record")
    if inside:
        # A record that crosses splits: an open end, whole splits inside it, and what the last one begins with.
        order = Window.partitionBy("file").orderBy("start", F.col("piece") % 2 == 0)
        number = F.sum((F.col("piece") == 2).cast("long")).over(order)
        joined = pieces.where("piece > 0").withColumn("number", number).groupBy("file", "number")
        parts = F.sort_array(F.collect_list(F.struct("start", "record")))
        records = records.unionByName(joined.agg(F.array_join(F.transform(parts, lambda part: part["record"]), "\n").alias("record")).select("record"))
    parsed = F.from_csv(F.regexp_replace("record", r"\r\z", ""), schema.simpleString()[7:-1].replace(":", " "), _options(True, "UTF-8"))
    return records.select(parsed.alias("row")).select("row.*")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, line, quotes): the lines of each split in order, where the split starts, and how many quotes a line has."""
    text = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        text.alias("line"),
        (F.length(text) - F.length(F.replace(text, F.lit('"')))).alias("quotes"),
    )


def write_csv(df: DataFrame, path: str, max_records_per_file: int = 1_000_000) -> None:
    """Write CSV files that :func:`read_csv` reads back unchanged, but for empty text, which becomes NULL.

    The row cap per file starts further files, it drops nothing.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", max_records_per_file)
        .csv(path)
    )
