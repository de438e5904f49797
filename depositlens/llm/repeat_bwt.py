"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

A string of ``LENGTH`` bytes that occurs twice is cut at the same places in both occurrences if the cuts depend on nearby
bytes alone. So texts are parsed first: an anchor is a position whose eight bytes have the smallest hash of some
window of ``WINDOW`` positions, and its symbol stands for the bytes that decide it. Any two occurrences share all anchors of
their inner part, one at least. A text thus becomes a short string of symbols; symbols that occur once cut it into pieces.

* Each shard sorts the suffixes of its symbol strings and keeps their Burrows-Wheeler transform.
* The transforms are merged by refining the interleave: all shards begin with the intervals of equal first symbols, and
  each round extends every interval by the symbols before it, one step of each shard's LF mapping. An extended interval
  that is alone over all shards is resolved and leaves. After ``ORDER`` rounds each suffix knows its common prefix with
  others. No suffix of the whole is ever sorted again, and no shard sees another's text.
* Only the starts whose inner symbols lie in a repeated interval can be repeated. They are verified on bytes: runs of starts between
  two anchors by the digest of all bytes they cover; where runs with the same anchor differ, in steps of ``STEP`` starts, and single
  starts only where steps with the same common bytes differ.

Digests are 128-bit XXH3 of the bytes themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depositlens.llm.common import forget, pieces, settle

LENGTH = 400
GRAM = 8
ORDER = 3
STEP = 8
SHARD_ANCHORS = 1 << 16
PIECE = 4 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


class Cut:
    """Sizes that follow from the length of the strings looked for."""

    def __init__(self, length: int):
        if not 8 * GRAM <= length < 1 << 15:
            raise ValueError(f"the length has to be {8 * GRAM} at least and below {1 << 15}")
        self.length = length
        grams = length - GRAM + 1
        self.window = (grams + 2) // 3
        self.left = self.window - 1  # an anchor depends on so many bytes before it
        self.right = self.window - 1 + GRAM  # and on so many from it on
        self.last = grams - self.window  # the last inner position of a string


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each ``width`` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        values = pick(values[:-reach], values[reach:])
        reach *= 2
    return pick(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def anchors(data: bytes, cut: Cut) -> np.ndarray:
    """Positions whose gram has the smallest hash of some window of grams."""
    count, width = len(data) - GRAM + 1, cut.window
    if count < width:
        return np.zeros(0, np.int64)
    words = np.empty(-(-count // GRAM) * GRAM, np.uint64)
    padded = data + bytes(2 * GRAM)
    for shift in range(GRAM):
        words[shift::GRAM] = np.frombuffer(padded, "<u8", len(words) // GRAM, shift)
    hashes = ((words[:count] * MIX) >> np.uint64(32)).astype(np.uint32)
    least = _sliding(hashes, width, np.minimum)
    edge = np.zeros(width - 1, np.uint32)
    return np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), width, np.maximum) == hashes)


def _parsed(texts: list[bytes], cut: Cut) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """(text, position, symbol) of the anchors of ``texts``, a few megabytes at a time; long texts in overlapping pieces."""
    margin = cut.left + cut.right
    held: list[tuple[int, int, int, bytes]] = []

    def flush():
        data = b"".join(piece for *_, piece in held)
        ends = np.cumsum([len(piece) for *_, piece in held])
        found = anchors(data, cut)
        which = np.searchsorted(ends, found, "right")
        starts = ends - [len(piece) for *_, piece in held]
        inside = (found - cut.left >= starts[which]) & (found + cut.right <= ends[which])
        found, which = found[inside], which[inside]
        text, offset, first = (np.array([piece[n] for piece in held]) for n in range(3))
        at = found - starts[which] + offset[which]
        own = at >= first[which]
        found, which, at = found[own], which[own], at[own]
        symbols = [xxhash.xxh3_64_intdigest(data[x - cut.left : x + cut.right]) for x in found.tolist()]
        held.clear()
        return text[which], at, symbols

    size = 0
    for n, text in enumerate(texts):
        if len(text) < cut.length:
            continue
        for start in range(0, len(text), PIECE):  # a piece owns the anchors whose context ends in it
            offset = max(0, start - margin)
            held.append((n, offset, 0 if start == 0 else start - cut.right + 1, text[offset : start + PIECE]))
            size += len(held[-1][-1])
            if size >= PIECE:
                yield flush()
                size = 0
    if held:
        yield flush()


def pack(high: np.ndarray, middle: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Three numbers in one: of any, 16 and 16 bits."""
    return high.astype(np.int64) << 32 | middle.astype(np.int64) << 16 | low.astype(np.int64)


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 32, packed >> 16 & 0xFFFF, packed & 0xFFFF


PARSED = ["doc", "text_hash", "row", "n_bytes", "sha256", "at", "links", "symbol"]


def _parser(cut: Cut):
    """Per text a row with its number, size and digest; per anchor a row with its position ``at``, ``links`` (bytes to the
    anchors before and after, 0 for none, and to the end, if near) and ``symbol``."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in pieces(batches, "octets", PIECE):
            texts = [text or b"" for text in batch.column(2).to_pylist()]
            count = len(texts)
            rows = np.arange(number, number + count)
            number += count
            sizes = np.array([len(text) for text in texts], np.int64)
            digests = pa.array([hashlib.sha256(text).hexdigest() for text in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows), pa.array(sizes), digests, *[pa.nulls(count, pa.int64())] * 3], PARSED)
            parts = list(_parsed(texts, cut))
            of, at = (np.concatenate([np.zeros(0, np.int64), *(part[n] for part in parts)]) for n in range(2))
            if not len(of):
                continue
            symbols = np.array([symbol for part in parts for symbol in part[2]], np.uint64).view(np.int64)
            same = np.concatenate([[False], of[1:] == of[:-1]])
            before = np.where(same, at - np.roll(at, 1), 0)
            after = np.where(np.roll(same, -1), np.roll(at, -1) - at, 0)
            links = pack(before, after, np.minimum(sizes[of] - at, 0xFFFF))
            none = pa.nulls(len(of), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(of), batch.column(0).type), none, pa.array(rows[of]), none, pa.nulls(len(of), pa.string()), pa.array(at), pa.array(links), pa.array(symbols)], PARSED)

    return parse


# --- transforms and their merge ----------------------------------------------------------------------


def transform(rows: np.ndarray, at: np.ndarray, before: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, ...]:
    """Suffix array by four symbols, the first symbol of each suffix, and the place of the suffix one symbol longer.

    Anchors are given by row and position. Strings break where the row changes or the anchor before is missing; there the
    place is -1. The symbol before a suffix, its entry in the transform, is the first symbol at that place.
    """
    count = len(rows)
    joined = np.zeros(count, bool)
    joined[1:] = (rows[1:] == rows[:-1]) & (before[1:] > 0) & (at[1:] - before[1:] == at[:-1])
    piece = np.cumsum(~joined)
    rank = np.unique(symbols, return_inverse=True)[1] + 1
    for reach in (1, 2):
        ahead = np.zeros(count, np.int64)
        ahead[:-reach] = np.where(piece[reach:] == piece[:-reach], rank[reach:], 0)
        rank = np.unique(rank * (rank.max() + 1) + ahead, return_inverse=True)[1] + 1
    suffixes = np.argsort(rank, kind="stable")
    place = np.empty(count, np.int64)
    place[suffixes] = np.arange(count)
    return suffixes, symbols[suffixes], np.where(joined[suffixes], place[suffixes - 1], -1)


def _shards(alive: DataFrame) -> DataFrame:
    """One row per shard: its transform, and where its suffixes are."""

    def build(_: tuple, anchors: pd.DataFrame) -> pd.DataFrame:
        anchors = anchors.sort_values(["row", "at"], ignore_index=True)
        row, at, links, symbols = (anchors[c].to_numpy() for c in ("row", "at", "links", "symbol"))
        suffixes, first, longer = transform(row, at, unpack(links)[0], symbols)
        blobs = {"suffixes": suffixes.astype(np.int32), "first": first, "longer": longer.astype(np.int32), "row": row, "at": at, "links": links}
        return pd.DataFrame({"shard": [anchors["shard"][0]]} | {name: [blob.tobytes()] for name, blob in blobs.items()})

    schema = "shard bigint, suffixes binary, first binary, longer binary, row binary, at binary, links binary"
    return alive.groupBy("shard").applyInPandas(build, schema)


INTERVALS = "shard bigint, key bigint, lo int, hi int"


def first_intervals(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, lo and hi of the runs of equal first symbols."""
    lo = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
    return first[lo], lo, np.append(lo[1:], len(first))


def _flat(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the intervals, and the interval of each."""
    sizes = hi - lo
    owner = np.repeat(np.arange(len(lo)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[owner], owner


def extend(first: np.ndarray, longer: np.ndarray, keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """The intervals one symbol longer to the left: key, lo, hi."""
    places, owner = _flat(lo.astype(np.int64), hi.astype(np.int64))
    joined = longer[places] >= 0
    targets, owner = longer[places[joined]], owner[joined]
    symbols = first[targets]
    order = np.lexsort((targets, symbols, owner))
    symbols, owner, targets = symbols[order], owner[order], targets[order]
    new = np.ones(len(order), bool)
    new[1:] = (symbols[1:] != symbols[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    sizes = np.diff(np.append(start, len(order)))
    mixed = (keys[owner[start]].astype(np.uint64) * MIX) ^ symbols[start].astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
    return mixed.view(np.int64), targets[start], targets[start] + sizes


def _second_intervals(shards: DataFrame) -> DataFrame:
    """The first round: every interval of one symbol is repeated, as only such symbols are left."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first, longer in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                first = np.frombuffer(first, np.int64)
                key, lo, hi = extend(first, np.frombuffer(longer, np.int32), *first_intervals(first))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), shard)), pa.array(key), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], ["shard", "key", "lo", "hi"])

    return shards.select("shard", "first", "longer").mapInArrow(step, INTERVALS)


def _extended(shards: DataFrame, intervals: DataFrame) -> DataFrame:
    def step(transform: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(transform):
            return pd.DataFrame({"shard": [], "key": [], "lo": [], "hi": []})
        first, longer = np.frombuffer(transform["first"][0], np.int64), np.frombuffer(transform["longer"][0], np.int32)
        key, lo, hi = extend(first, longer, *(own[c].to_numpy() for c in ("key", "lo", "hi")))
        return pd.DataFrame({"shard": transform["shard"][0], "key": key, "lo": lo, "hi": hi})

    left = shards.select("shard", "first", "longer").groupBy("shard")
    return left.cogroup(intervals.groupBy("shard")).applyInPandas(step, INTERVALS)


def _repeated(intervals: DataFrame) -> DataFrame:
    """Intervals with two suffixes or more over all shards."""
    counts = intervals.groupBy("key").agg(F.sum(F.col("hi") - F.col("lo")).alias("n")).where("n > 1").select("key")
    counts = settle(counts, "interval-keys")
    return intervals.join(counts, "key", "left_semi").select("shard", "key", "lo", "hi")


def merged_intervals(shards: DataFrame) -> list[DataFrame]:
    """Settled repeated intervals of 2 .. ``ORDER`` symbols."""
    found: list[DataFrame] = []
    for _ in range(2, ORDER + 1):
        longer = settle(_extended(shards, found[-1]) if found else _second_intervals(shards), "extended")
        found.append(settle(_repeated(longer), "intervals"))
        forget(longer)
    return found


def start_runs(row: np.ndarray, at: np.ndarray, links: np.ndarray, depth: np.ndarray, cut: Cut) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, packed run): starts whose first inner anchor it is and whose inner symbols lie in a repeated interval.

    A run is its first start, its anchor's distance from it and the number of starts after it.
    """
    before, after, room = unpack(links)
    lo = np.maximum(np.where(before > 0, at - before + 1 - cut.left, 0), np.maximum(at - cut.last, 0))
    hi = np.minimum(at - cut.left, at + room - cut.length)
    # A start's inner part must not reach the anchor after the repeated symbols; ORDER symbols stand for any number.
    final = np.arange(len(row)) + depth - 1
    short = (depth < ORDER) & (after[final] > 0)
    hi = np.where(short, np.minimum(hi, at[final] + after[final] - 1 - cut.last), hi)
    keep = np.flatnonzero(hi >= lo)
    return keep, pack(lo[keep], (at - lo)[keep], (hi - lo)[keep])


def _start_runs(shards: DataFrame, intervals: list[DataFrame], cut: Cut) -> DataFrame:
    """(row, symbol, run) for all anchors with starts."""

    def step(transform: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(transform):
            return pd.DataFrame({"row": [], "symbol": [], "run": []})
        row, at, links, first = (np.frombuffer(transform[name][0], np.int64) for name in ("row", "at", "links", "first"))
        suffixes = np.frombuffer(transform["suffixes"][0], np.int32)
        symbols = np.empty(len(first), np.int64)
        symbols[suffixes] = first
        depth = np.ones(len(row), np.int64)
        places, owner = _flat(own["lo"].to_numpy(np.int64), own["hi"].to_numpy(np.int64))
        np.maximum.at(depth, suffixes[places], own["order"].to_numpy(np.int64)[owner])
        keep, runs = start_runs(row, at, links, depth, cut)
        return pd.DataFrame({"row": row[keep], "symbol": symbols[keep], "run": runs})

    union = reduce(DataFrame.union, (own.withColumn("order", F.lit(order)) for order, own in enumerate(intervals, 2)))
    left = shards.drop("longer").groupBy("shard")
    return left.cogroup(union.drop("key").groupBy("shard")).applyInPandas(step, "row bigint, symbol bigint, run bigint")


# --- verification on bytes ---------------------------------------------------------------------------


def _halves(digests: list[bytes]) -> tuple[pa.Array, pa.Array]:
    pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
    return pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))


def _run_digests(candidates: DataFrame, cut: Cut) -> DataFrame:
    """(row, run, symbol, d1, d2): digest of the bytes that the run's starts cover."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "octets", PIECE):
            texts, lists = batch.column(1).to_pylist(), batch.column(2)
            of = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
            symbol, run = lists.flatten().field("symbol"), lists.flatten().field("run")
            lo, _, more = unpack(run.to_numpy())
            made = [
                xxhash.xxh3_128_digest(texts[n][x:y])
                for n, x, y in zip(of.tolist(), lo.tolist(), (lo + more + cut.length).tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), run, symbol, *_halves(made)], ["row", "run", "symbol", "d1", "d2"])

    return candidates.select("row", "octets", "runs").mapInArrow(digest, "row bigint, run bigint, symbol bigint, d1 bigint, d2 bigint")


def steps(run: int, cut: Cut) -> list[tuple[int, int, int, int]]:
    """A run in steps of ``STEP`` starts counted from its anchor: first and last start, first byte and end of what all starts of
    such a step have in common."""
    lo, distance, more = (int(x) for x in unpack(np.int64(run)))
    at, found = lo + distance, []
    for n in range((distance - more) // STEP, distance // STEP + 1):
        first, last = max(lo, at - n * STEP - STEP + 1), min(lo + more, at - n * STEP)
        found.append((first, last, at - n * STEP, at - n * STEP - STEP + 1 + cut.length))
    return found


def _step_digests(opened: DataFrame, cut: Cut) -> DataFrame:
    """(row, lo, hi, alone, digests v1, v2 of all bytes of a step's starts and c1, c2 of the common ones)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "octets", PIECE):
            out: list[tuple] = []
            whole, common = [], []
            for row, text, runs in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                for run in runs:
                    for first, last, start, end in steps(run["run"], cut):
                        out.append((row, first, last, run["alone"]))
                        whole.append(xxhash.xxh3_128_digest(text[first : last + cut.length]))
                        common.append(xxhash.xxh3_128_digest(text[start:end]))
            if out:
                columns = [pa.array(column) for column in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, *_halves(whole), *_halves(common)], ["row", "lo", "hi", "alone", "v1", "v2", "c1", "c2"])

    return opened.mapInArrow(digest, "row bigint, lo bigint, hi bigint, alone boolean, v1 bigint, v2 bigint, c1 bigint, c2 bigint")


def _start_digests(opened: DataFrame, cut: Cut) -> DataFrame:
    """(row, lo, alone, s1, s2): each single start of the steps given, with its own bytes' digest."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "octets", PIECE):
            out: list[tuple] = []
            made = []
            for row, text, runs in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                for run in runs:
                    for start in range(run["lo"], run["hi"] + 1):
                        out.append((row, start, run["alone"]))
                        made.append(xxhash.xxh3_128_digest(text[start : start + cut.length]))
            if out:
                yield pa.RecordBatch.from_arrays([*(pa.array(column) for column in zip(*out, strict=True)), *_halves(made)], ["row", "lo", "alone", "s1", "s2"])

    return opened.mapInArrow(digest, "row bigint, lo bigint, alone boolean, s1 bigint, s2 bigint")


def covered_spans(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal covered spans (start, end) of strings that start in ``runs`` (first, last start)."""
    spans: list[tuple[int, int]] = []
    for lo, hi in sorted(runs):
        if spans and lo <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], hi + length))
        else:
            spans.append((lo, hi + length))
    return spans


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _removed(found: DataFrame, kind: T.DataType, cut: Cut) -> DataFrame:
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "octets", PIECE):
            sizes, kept, spans = [], [], []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = covered_spans([(run["lo"], run["hi"]) for run in runs or ()], cut.length)
                rest = hashlib.sha256()
                last = 0
                for start, end in own:
                    rest.update(text[last:start])
                    last = end
                rest.update(text[last:])
                sizes.append(len(text))
                kept.append(rest.hexdigest())
                spans.append([{"start": start, "end": end} for start, end in own])
            arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, arrow)], ["doc", "n_bytes", "kept_sha256", "spans"])

    return found.mapInArrow(remove, T.StructType([T.StructField("doc", kind), T.StructField("n_bytes", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("spans", SPANS)]))


def _with_runs(candidates: DataFrame, rows: DataFrame, *fields: str) -> DataFrame:
    """(row, octets, runs): the texts that ``rows`` name, with those rows gathered; a text has so many starts at most."""
    runs = rows.groupBy("row").agg(F.collect_set(F.struct(*fields)).alias("runs"))
    return candidates.select("row", "octets").join(runs, "row")


def _twice(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that several rows have; settled, so that a join with them can split a hot key."""
    return settle(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "twice")


def repeated_runs(candidates: DataFrame, cut: Cut) -> DataFrame:
    """(row, lo, hi): all repeated starts of ``candidates`` (row, octets, runs)."""
    digests = settle(_run_digests(candidates, cut), "run-digests")
    one = F.min(F.struct("row", "run")).alias("one")
    contexts = settle(digests.groupBy("d1", "d2", "symbol").agg(F.count("*").alias("n"), one), "contexts")
    either = F.struct("d1", "d2")
    differing = contexts.groupBy("symbol").agg((F.min(either) != F.max(either)).alias("differ")).where("differ").select("symbol")
    differing = settle(differing, "differing")
    single = contexts.join(differing, "symbol", "left_semi").select("one.*", (F.col("n") == 1).alias("alone"))
    parts = settle(_step_digests(_with_runs(candidates, single, "run", "alone"), cut), "steps")
    one = F.min(F.struct("row", "lo", "hi", "alone")).alias("one")
    variants = settle(parts.groupBy("c1", "c2", "v1", "v2").agg(F.count("*").alias("n"), one), "variants")
    mixed = variants.join(_twice(variants, "c1", "c2"), ["c1", "c2"], "left_semi")
    opened = mixed.select("one.row", "one.lo", "one.hi", ((F.col("n") == 1) & F.col("one.alone")).alias("alone"))
    starts = settle(_start_digests(_with_runs(candidates, opened, "lo", "hi", "alone"), cut), "starts")
    lo, more = F.expr("run >> 32"), F.expr("run & 65535")
    plain = digests.join(contexts.where("n > 1").select("d1", "d2"), ["d1", "d2"], "left_semi").select("row", lo.alias("lo"), (lo + more).alias("hi"))
    whole = variants.where("n > 1").select("v1", "v2")
    steps_too = parts.where("alone").join(whole, ["v1", "v2"], "left_semi").select("row", "lo", "hi")
    starts_too = starts.where("alone").join(_twice(starts, "s1", "s2"), ["s1", "s2"], "left_semi").select("row", "lo", F.col("lo").alias("hi"))
    found = settle(plain.union(steps_too).union(starts_too), "repeated")
    forget(digests, contexts, parts, variants, starts)
    return found


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, spans (array of start, end in bytes).

    Removed is each byte of the UTF-8 text covered by a string of ``length`` bytes that also starts anywhere else, in the same
    row or another, as judged on the input; strings do not cross rows. Repeated rows are repeats of each other. A NULL or
    empty text, or one shorter than ``length``, keeps all its bytes. An empty table gives no rows; other columns are not read.
    """
    cut = Cut(length)
    texts = docs.select(
        F.col(f"`{id_col}`").alias("doc"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"), F.col(f"`{text_col}`").cast("binary").alias("octets")
    )
    kind = texts.schema["doc"].dataType
    longs = T.LongType()
    schema = T.StructType([T.StructField(name, kind if name == "doc" else T.StringType() if name == "sha256" else longs) for name in PARSED])
    parsed = settle(texts.mapInArrow(_parser(cut), schema), "parsed")
    whole = settle(parsed.where("sha256 IS NOT NULL").select("doc", "text_hash", "row", "n_bytes", "sha256"), "whole")
    found = parsed.where("symbol IS NOT NULL").select("row", "at", "links", "symbol")
    alive = settle(found.join(_twice(found, "symbol"), "symbol", "left_semi"), "alive")
    forget(parsed)
    shard_count = 1 + alive.count() // SHARD_ANCHORS
    shards = settle(_shards(alive.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shard_count)))), "shards")
    forget(alive)
    intervals = merged_intervals(shards)
    runs = settle(_start_runs(shards, intervals, cut), "runs")
    forget(shards, *intervals)

    by_row = runs.groupBy("row").agg(F.collect_list(F.struct("symbol", "run")).alias("runs"))
    named = whole.select(F.col("doc").alias("doc_"), F.col("text_hash").alias("hash_"), "row")
    by_text = settle(named.join(by_row, "row").dropDuplicates(["doc_", "hash_"]), "runs-by-text")
    forget(runs)
    same = texts["doc"].eqNullSafe(by_text["doc_"]) & (texts["text_hash"] == by_text["hash_"])
    candidates = settle(texts.join(by_text, same).select("doc", "row", "octets", "runs"), "candidates")
    gathered = repeated_runs(candidates, cut).groupBy("row").agg(F.collect_set(F.struct("lo", "hi")).alias("found"))
    changed = _removed(candidates.select("doc", "row", "octets").join(gathered, "row", "left").select("doc", "octets", "found"), kind, cut)
    seen = by_text.select("doc_", "hash_")
    other = whole["doc"].eqNullSafe(seen["doc_"]) & (whole["text_hash"] == seen["hash_"])
    clean = whole.join(seen, other, "left_anti").select("doc", "n_bytes", F.col("sha256").alias("kept_sha256"), F.array().cast(SPANS).alias("spans"))
    length_of = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return changed.union(clean).select(
        F.col("doc").alias(id_col), "n_bytes", length_of.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans"
    )
