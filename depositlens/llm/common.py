"""Helpers shared by the corpus operators: settled tables, column checks, byte batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depositlens.sources.shared import fresh_path

LONGEST_WORD = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    settled = df.sparkSession.read.schema(df.schema).parquet(path)
    settled.settled_path = path
    return settled


def forget(*frames: DataFrame) -> None:
    """Remove the files of settled tables that nothing reads any more."""
    for frame in frames:
        context = frame.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(frame.settled_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def lower_az(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def crc_bucket(key: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; NULL for a NULL id."""
    return F.crc32(key.cast("string").cast("binary")) % buckets


def free_name(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def map_arrow(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return df.mapInArrow(run, schema)


def pieces(batches: Iterator[pa.RecordBatch], octets: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the binary column ``octets`` has about ``most`` bytes in each, whole rows though.

    After the last one Arrow's pool gives back what it no longer uses: workers stay for the tasks of other steps.
    """
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(octets)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, done + most, "right")))
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()


def most_frequent(counted: DataFrame, word: str, count: str, most: int) -> list[tuple[bytes | str, int]]:
    """Words of up to ``LONGEST_WORD`` bytes with their counts, frequent first, ties by the word: all down to the level of count at
    which there are ``most`` at most. So the driver gets ``most * LONGEST_WORD`` bytes of words at most, and callers
    treat a longer word like a rare one.

    Levels are eighths of a power of two, so the driver gets a few hundred level sizes and then ``most`` rows at most, however
    many tasks and words there are.
    """
    levelled = counted.where(F.octet_length(word) <= LONGEST_WORD).withColumn("level", F.floor(F.log2(F.col(count)) * 8))
    sizes = sorted(levelled.groupBy("level").count().collect(), key=lambda row: -row.level)
    lowest, total = None, 0
    for row in sizes:
        total += row["count"]
        if total > most:
            break
        lowest = row.level
    if lowest is None:
        return []
    rows = levelled.where(F.col("level") >= lowest).select(word, count).collect()
    return sorted(((bytes(w) if isinstance(w, bytearray) else w, n) for w, n in rows), key=lambda pair: (-pair[1], pair[0]))
