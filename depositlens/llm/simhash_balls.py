"""SimHash near-copies by meeting in the middle: variants of each fingerprint are the shuffle keys.

Two fingerprints differ in two bits at most if and only if some 64-bit value is within one bit of both. Each
distinct fingerprint is sent, with a note of the flipped bit, to the 65 values within one bit of it. What
arrives at a value fits a fixed-size state, 64 marks and a flag: a value never holds more than 65
fingerprints, however many copies a document has. Fingerprints of one value
all differ by two bits at most; each is linked to the smallest, so that no link between components is lost and no pairs are listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depositlens.llm.common import forget, free_name, pieces, settle
from depositlens.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
COUNT_ROWS = 1 << 16
PIECE = 4 << 20


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of UTF-8 text; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, len(grams))
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), COUNT_ROWS):
        octets = hashes[start : start + COUNT_ROWS].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` and a long column ``name``: the fingerprint's bits."""
    place = [column.lower() for column in docs.columns].index(text_col.lower())

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, docs_text, PIECE):
            marks = [fingerprint(text, shingle) for text in batch.column(place).cast(pa.binary()).to_pylist()]
            column = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, name])

    docs_text = docs.columns[place]
    return docs.mapInArrow(mark, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def links(fingerprints: DataFrame) -> DataFrame:
    """(x, y): enough links of at most two bits between distinct fingerprints ``fp`` to connect all that are linked.

    Fingerprints are dealt to all partitions before each becomes 65 rows, and balls are counted only where they meet: few
    fingerprints share a value, so combining them before the shuffle would hold 65 entries for each and save no row.
    """
    parts = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    balls = (
        fingerprints.repartition(parts, "fp")
        .select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("bit"))
        .selectExpr("CASE WHEN bit < 64 THEN fp ^ shiftleft(1L, bit) ELSE fp END AS ball", "CAST(bit AS TINYINT) AS bit")
        .repartition("ball")
        .groupBy("ball")
        .agg(
            F.expr("bit_or(CASE WHEN bit < 64 THEN shiftleft(1L, bit) ELSE 0L END)").alias("flips"),
            F.expr("max(CAST(bit = 64 AS INT))").alias("own"),
        )
        .where("bit_count(flips) + own >= 2")
    )
    members = balls.selectExpr(
        "concat(IF(own = 1, array(ball), array()), transform(filter(sequence(0, 63), "
        "bit -> getbit(flips, bit) = 1), bit -> ball ^ shiftleft(1L, bit))) AS members"
    )
    return (
        members.select(F.array_min("members").alias("x"), F.explode("members").alias("y"))
        .where(f"x <> y AND bit_count(x ^ y) <= {MAX_BITS}")
        .distinct()
    )


def classes(marks: DataFrame, id_col: str) -> DataFrame:
    """(label, fp, first, component_id): per fingerprint of ``marks`` its own and its component's smallest id."""
    firsts = settle(marks.groupBy("fp").agg(F.min(id_col).alias("first")), "fingerprints")
    labels, kept = components(links(firsts.select("fp")))
    labelled = settle(
        firsts.join(labels, firsts["fp"] == labels["node"], "left").select(
            "fp", "first", F.coalesce("label", "fp").alias("label")
        ),
        "labels",
    )
    forget(firsts, *kept)
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    return labelled.join(smallest, "label")


def near_copy_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """Per row of ``docs`` its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Words are runs of other than ASCII white space, A-Z lower-cased; a text of fewer words than a shingle is
    one shingle; a text without words, empty or NULL, has fingerprint zero and is linked like any other. A
    component's id is the smallest reachable id, NULL ids aside (NULL if it has no other). Repeated rows are
    rows of their own, with one class. An empty table gives no rows. Other columns are not read.
    """
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marks = settle(with_fingerprint(texts, "fp", "text", shingle).select("id", "fp"), "marks")
    found = classes(marks, "id")
    return marks.join(found, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, that with the smallest id; columns and other rows as they are.

    Rows without an id stay only if their class has no id at all; of rows that repeat id and fingerprint one stays.
    Which rows stay is settled on numbers of rows; whole rows are shuffled once.
    """
    mark, row = free_name(docs, "fp"), free_name(docs, "row")
    marked = settle(with_fingerprint(docs, mark, text_col).withColumn(row, F.monotonically_increasing_id()), "marked")
    marks = marked.select(F.col(f"`{mark}`").alias("fp"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{row}`").alias("row"))
    found = classes(marks, "id")
    chosen = (
        found.where(F.col("first").eqNullSafe(F.col("component_id")))
        .groupBy("label")
        .agg(F.min("fp").alias("chosen_fp"), F.min("component_id").alias("chosen_id"))
    )
    same = marks["id"].eqNullSafe(chosen["chosen_id"]) & (marks["fp"] == chosen["chosen_fp"])
    kept = marks.join(chosen, same, "left_semi").groupBy("fp").agg(F.min("row").alias("kept"))
    return marked.join(kept, marked[f"`{row}`"] == kept["kept"], "left_semi").drop(mark, row)
