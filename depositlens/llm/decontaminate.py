"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A benchmark window is ten consecutive words of an item and is taken as the set of its shingles of five words.
An occurrence holds all of them, so the prefix that has to be joined is one token: the window's rarest shingle
by the number of windows that hold it. Documents are read once: each position's shingle is looked
up among the prefix tokens, length and position bounds tell where the window would have to start, and the
words there are compared. The documents are never shuffled; only verified occurrences and one
row per document are.

There is one prefix row for each distinct window, however many items share it; which items those are is joined, by a shuffle, after
the windows of each document are known. Prefix rows are broadcast in blocks of about ``BLOCK_BYTES``, dealt by hash of the window, so a
token of many windows is spread too. A larger benchmark takes more blocks, each one pass over the documents; its size is counted beforehand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depositlens.llm.common import lower_az, settle

WINDOW = 10
SHINGLE = 5
BLOCK_BYTES = 64 << 20
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased runs of digits, ASCII letters and all characters beyond ASCII; none for NULL."""
    parts = F.array_remove(F.split(lower_az(text), SEPARATORS), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def _shingle(at: Column, size: int) -> Column:
    """Hash of the ``size`` words from position ``at``; NULL where the text ends earlier."""
    parts = [F.get("words", at + i) for i in range(size)]
    return F.when(at + size <= F.col("n_words"), F.xxhash64(F.lit(size), *parts))


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, window), distinct: the windows of each item, as their words joined by spaces, which no word holds."""
    items = (
        benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), words(F.col(f"`{text_col}`")).alias("words"))
        .withColumn("n_words", F.size("words"))
        .where("n_words > 0")
        .withColumn("length", F.least("n_words", F.lit(window)))
    )
    starts = items.withColumn("start", F.explode(F.expr("sequence(0, n_words - length)")))
    return starts.select("item", F.expr("array_join(slice(words, start + 1, length), ' ')").alias("window")).distinct()


def prefix_tokens(windows: DataFrame, shingle: int) -> DataFrame:
    """(window, window_words, length, size, token, at): one prefix token for each distinct window."""
    cut = (
        windows.select("window")
        .distinct()
        .withColumn("words", F.split("window", " "))
        .withColumn("n_words", F.size("words"))
        .withColumn("size", F.least("n_words", F.lit(shingle)))
    )
    by_size = F.coalesce(*(F.when(F.col("size") == n, _shingle(F.col("at"), n)) for n in range(1, shingle + 1)))
    tokens = cut.withColumn("at", F.explode(F.expr("sequence(0, n_words - size)"))).withColumn("token", by_size)
    held = tokens.groupBy("token").agg(F.countDistinct("window").alias("windows"))
    return (
        tokens.join(held, "token")
        .groupBy("window", F.col("n_words").alias("length"), "size")
        .agg(F.min(F.struct("windows", "token", "at")).alias("rarest"))
        .select("window", F.split("window", " ").alias("window_words"), "length", "size", "rarest.token", "rarest.at")
    )


def _occurrences(docs: DataFrame, prefixes: DataFrame, sizes: list[int], every: bool) -> DataFrame:
    """Verified windows of ``docs`` (one row each); with ``every`` also one row with NULL item_start per document."""
    end = F.col("pos") == F.col("n_words")
    spread = docs.select(
        "doc", "text_hash", "words", "n_words",
        F.posexplode(F.array_append("words", F.lit(None).cast("string"))).alias("pos", "word"),
    )
    if len(sizes) == 1:
        spread = spread.withColumn("token", _shingle(F.col("pos"), sizes[0]))
    else:
        every_size = F.array(*(_shingle(F.col("pos"), size) for size in sizes))
        spread = spread.withColumn("token", F.explode(F.when(end, F.slice(every_size, 1, 1)).otherwise(every_size)))
    joined = spread.join(F.broadcast(prefixes), "token", "left" if every else "inner")
    start = F.col("pos") - F.col("at")
    fits = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    there = F.when(fits, F.slice("words", start + 1, F.col("length")) == F.col("window_words"))
    found = F.col("at").isNotNull() & F.coalesce(there, F.lit(False))
    return joined.where(found | end if every else found).select(
        "doc", "text_hash", "n_words",
        F.when(found, F.struct(start.alias("start"), F.col("length").alias("length"))).alias("hit"),
        F.when(found, F.col("window")).alias("window"),
        end.alias("is_end"),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: id, text_hash, n_words, n_hit, items (sorted array of item ids as text).

    A document word inside any occurrence of a window is hit. An item of fewer words than ``window`` is one window;
    one without words, empty or NULL, occurs nowhere. A NULL or empty text has no words. An item without an id
    hits words and is not listed. Repeated items count once, repeated rows of ``docs`` stay rows. An empty
    benchmark hits nothing, empty ``docs`` give no rows. Other columns are not read.
    """
    members = settle(item_windows(benchmark, item_col, item_text_col, window), "members")
    prefixes = settle(prefix_tokens(members, shingle), "prefixes")
    row_bytes = F.sum(F.expr("aggregate(window_words, 96 + octet_length(window), (n, w) -> n + 32 + octet_length(w))"))
    sizes, total = [], 0
    for size, octets in prefixes.groupBy("size").agg(row_bytes).collect():  # at most `shingle` rows
        sizes.append(size)
        total += octets
    blocks = 1 + total // block_bytes
    texts = docs.select(
        F.col(f"`{id_col}`").alias("doc"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
        words(F.col(f"`{text_col}`")).alias("words"),
    ).withColumn("n_words", F.size("words"))
    in_block = F.pmod(F.xxhash64("window"), F.lit(blocks))
    found = reduce(
        DataFrame.union,
        (
            _occurrences(texts, prefixes.where(in_block == block).drop("size"), sorted(sizes) or [shingle], block == 0)
            for block in range(blocks)
        ),
    )
    covered = "size(array_distinct(flatten(transform(hits, h -> sequence(h.start, h.start + h.length - 1)))))"
    by_document = (
        found.groupBy("doc", "text_hash", "n_words")
        .agg(F.collect_set("hit").alias("hits"), F.collect_set("window").alias("windows"), F.count_if("is_end").alias("copies"))
        .withColumn("n_hit", F.expr(covered).cast("long"))
    )
    # Documents without a window look for one of their own, which no item has: they spread over all tasks.
    own = F.concat(F.lit(" "), F.col("text_hash").cast("string"), F.coalesce(F.col("doc").cast("string"), F.lit("")))
    asked = by_document.select("doc", "text_hash", "n_words", "n_hit", "copies", F.explode_outer("windows").alias("window"))
    return (
        asked.withColumn("window", F.coalesce("window", own))
        .join(members, "window", "left")
        .groupBy("doc", "text_hash", "n_words", "n_hit", "copies")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .select(
            F.col("doc").alias(id_col), "text_hash", F.col("n_words").cast("long").alias("n_words"), "n_hit", "items",
            F.explode(F.expr("sequence(1L, copies)")).alias("copy"),
        )
        .drop("copy")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, without any benchmark window in them."""
    hit = (
        contamination(docs, benchmark, id_col, text_col)
        .where("n_hit > 0")
        .select(F.col(id_col).alias("hit_id"), F.col("text_hash").alias("hit_hash"))
        .distinct()
    )
    same = docs[f"`{id_col}`"].eqNullSafe(hit["hit_id"]) & (F.xxhash64(docs[f"`{text_col}`"]) == hit["hit_hash"])
    return docs.join(hit, same, "left_anti")
