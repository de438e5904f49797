"""Exact ranked search with ball trees over sparse document vectors.

A document is a vector of integer term scores, a query one of integer term weights, and the score their inner product. Every batch of documents becomes a
binary tree: a node holds the centroid of its documents and, per group of terms of like frequency, the radius around it. Within a group a document's
part of the score is at most that of the centroid plus the query's length times the radius (Cauchy-Schwarz), so the sum over the groups bounds
all documents of the node. Bounds are made in floating point and widened by more than their rounding. Nodes are opened best bound first; once the
best is below the query's k-th score, the rest of the tree stays closed. Leaves are scored in 64-bit integers, ties go to the smaller id, and the k-th
scores are carried from batch to batch of a task; Spark ranks what the tasks found.

Only terms that some query holds get vectors; statistics count all terms of all documents. Queries go round in blocks of ``QUERY_TERMS`` terms and
``QUERY_BYTES`` bytes of them, or one query where that has more. The driver reads them as a stream; a block is asked and its results written before the
next one is read, so the driver and the workers hold one block at a time.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depositlens.llm.common import forget, pieces, settle

TOP = 20
QUERY_TERMS, QUERY_BYTES = 1 << 18, 8 << 20
LEAF = 32
TREE = 2048
GROUPS = 2304
SINGLE = 2048
SKETCH = 48
PIECE = 4 << 20
SCALE, LENGTH_SHARE = 1_000_000_000, 25
#: Bytes that are no part of a term become spaces, A-Z become a-z.
TERM_BYTES = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """ASCII letters and digits and whatever is not ASCII, in runs; A-Z lower-cased."""
    return (text or b"").translate(TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def term_scores(tfs: np.ndarray, lengths: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """Integer scores of term counts in documents of these lengths."""
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * n_docs) // max(total, 1)
    return (SCALE * tfs) // (1000 * tfs + 12 * m)


def asked_terms(items: DataFrame) -> DataFrame:
    """(item, term, tf) of ``items`` (item, octets)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms_of(text) for text in batch.column("octets").to_pylist()]
            of = np.repeat(np.arange(len(found)), [len(own) for own in found])
            columns = [batch.column("item").take(pa.array(of)), pa.array([term for own in found for term in own], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["item", "term"])

    schema = T.StructType([items.schema["item"], T.StructField("term", T.BinaryType())])
    return items.mapInArrow(count, schema).groupBy("item", "term").agg(F.count(F.lit(1)).alias("tf"))


def vectors(texts: DataFrame, numbers: Broadcast) -> DataFrame:
    """``texts`` (doc, octets) as (doc, n, terms, tfs): all terms counted, those with a number listed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = numbers.value.get
        for batch in pieces(batches, "octets", PIECE):
            lengths, sizes, found = [], [], []
            for text in batch.column("octets").to_pylist():
                own = terms_of(text)
                known = [number for term in own if (number := get(term)) is not None]
                lengths.append(len(own))
                sizes.append(len(known))
                found += known
            rows = len(lengths)
            width = len(numbers.value) + 1
            keys, tfs = np.unique(np.repeat(np.arange(rows), sizes) * width + np.array(found, np.int64), return_counts=True)
            starts = pa.array(np.searchsorted(keys, np.arange(rows + 1) * width), pa.int32())
            terms = pa.ListArray.from_arrays(starts, pa.array(keys % width, pa.int32()))
            counts = pa.ListArray.from_arrays(starts, pa.array(tfs, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(lengths, pa.int64()), terms, counts], ["doc", "n", "terms", "tfs"])

    schema = T.StructType([texts.schema["doc"], T.StructField("n", T.LongType()), *(T.StructField(name, T.ArrayType(T.IntegerType())) for name in ("terms", "tfs"))])
    return texts.mapInArrow(count, schema)


def frequencies(listed: DataFrame) -> DataFrame:
    """(term, df): in how many of the vectors a numbered term is, added up per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            own = np.bincount(batch.column("terms").flatten().to_numpy(), minlength=len(total))
            own[: len(total)] += total
            total = own
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["term", "df"])

    return listed.select("terms").mapInArrow(count, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def blocks_of(asked: DataFrame) -> Iterator[list[tuple]]:
    """The rows of ``asked``, cut between items; no rows are one empty block."""
    block: list[tuple] = []
    own: list[tuple] = []
    octets = 0
    for item, term, tf in chain(asked.sort("item", "term").toLocalIterator(), [(None, b"", 0)]):
        if own and item != own[0][0]:
            size = sum(len(held) for _, held, _ in own)
            if block and (len(block) + len(own) > QUERY_TERMS or octets + size > QUERY_BYTES):
                yield block
                block, octets = [], 0
            block += own
            octets, own = octets + size, []
        own.append((item, bytes(term), tf))
    yield block


class Queries:
    """A block of queries: per query its term numbers and integer weights, its groups and its length within each."""

    def __init__(self, rows: list, numbers: dict[bytes, int], df: dict[int, int], n_docs: int, total: int):
        self.n_docs, self.total = n_docs, total
        self.size = len(numbers)
        order = sorted(range(self.size), key=lambda number: (-df.get(number, 0), number))
        self.group = np.zeros(self.size, np.int64)  # frequent terms have a group each, the rest share by frequency
        for place, number in enumerate(order):
            self.group[number] = place if place < SINGLE else SINGLE + (place - SINGLE) * (GROUPS - SINGLE) // max(1, self.size - SINGLE)
        asked: dict[object, dict[int, int]] = {}
        for item, term, tf in rows:
            number = numbers[term]
            if number in df:
                asked.setdefault(item, {})[number] = weight(n_docs, df[number]) * tf
        self.items = sorted(asked)
        self.terms, self.weights, self.groups, self.norms = [], [], [], []
        for item in self.items:
            own = np.array(sorted(asked[item].items()), np.int64).reshape(-1, 2)
            groups, place = np.unique(self.group[own[:, 0]], return_inverse=True)
            self.terms.append(own[:, 0])
            self.weights.append(own[:, 1])
            self.groups.append(groups)
            self.norms.append(np.sqrt(np.bincount(place, own[:, 1].astype(float) ** 2)))


class BallTree:
    """Documents of one batch: order, leaves, centroids (by term) and radii (by group of terms)."""

    def __init__(self, queries: Queries, lengths: np.ndarray, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
        rows = len(lengths)
        of = np.repeat(np.arange(rows), np.diff(starts))
        scores = term_scores(tfs.astype(np.int64), lengths[of], queries.n_docs, queries.total)
        signs = np.where(terms * 2654435761 >> 7 & 1, 1.0, -1.0)
        sketch = np.bincount(of * SKETCH + (terms * 40503 >> 3) % SKETCH, scores * signs, rows * SKETCH).reshape(rows, SKETCH)
        self.order = np.arange(rows)
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self._split(sketch, 0, rows)
        place = np.empty(rows, np.int64)
        place[self.order] = np.arange(rows)
        sort = np.argsort(place[of], kind="stable")
        self.terms, self.scores, row = terms[sort], scores[sort], place[of][sort]
        self.starts = np.searchsorted(row, np.arange(rows + 1))
        self._balls(queries, row)

    def _split(self, sketch: np.ndarray, low: int, high: int) -> int:
        """Cut at the median along the direction of greatest spread in the signed sketch; the number of the node."""
        node = len(self.spans)
        self.spans.append((low, high))
        self.children.append(None)
        if high - low > LEAF:
            own = sketch[self.order[low:high]]
            own = own - own.mean(axis=0)
            column = own @ np.linalg.eigh(own.T @ own)[1][:, -1]
            middle = (high - low) // 2
            self.order[low:high] = self.order[low:high][np.argpartition(column, middle)]
            self.children[node] = (self._split(sketch, low, low + middle), self._split(sketch, low + middle, high))
        return node

    def _balls(self, queries: Queries, row: np.ndarray) -> None:
        nodes = len(self.spans)
        self.radii = np.zeros((nodes, GROUPS), np.float32)
        held_terms, held_nodes, held_means = [], [], []
        for node, (low, high) in enumerate(self.spans):
            own = slice(self.starts[low], self.starts[high])
            terms, place = np.unique(self.terms[own], return_inverse=True)
            if not len(terms):
                continue
            values = self.scores[own].astype(float)
            means = np.bincount(place, values) / (high - low)
            groups, at = np.unique(queries.group[terms], return_inverse=True)
            # |v - c|^2 within a group, from c^2 of all its terms and the terms the document has
            squares = np.bincount(at, means**2)[None] + np.bincount(
                (row[own] - low) * len(groups) + at[place], values**2 - 2 * values * means[place], (high - low) * len(groups)
            ).reshape(high - low, len(groups))
            radii = np.sqrt(np.maximum(squares.max(axis=0), 0) + 1e-9 * np.bincount(at, means**2) + 1)
            self.radii[node, groups] = np.nextafter(radii.astype(np.float32), np.float32(np.inf))
            held_terms.append(terms)
            held_nodes.append(np.full(len(terms), node))
            held_means.append(means)
        terms = np.concatenate([*held_terms, np.zeros(0, np.int64)]).astype(np.int64)
        sort = np.argsort(terms, kind="stable")
        self.of_node = np.concatenate([*held_nodes, np.zeros(0, np.int64)]).astype(np.int64)[sort]
        self.means = np.concatenate([*held_means, np.zeros(0)])[sort]
        self.first = np.searchsorted(terms[sort], np.arange(queries.size + 1))

    def bounds(self, queries: Queries, query: int) -> np.ndarray:
        """No document of a node scores more than its bound."""
        lists = [slice(self.first[term], self.first[term + 1]) for term in queries.terms[query]]
        parts = [self.means[own] * w for own, w in zip(lists, queries.weights[query], strict=True)]
        centre = np.bincount(np.concatenate([self.of_node[own] for own in lists]), np.concatenate(parts), len(self.spans))
        return (centre + self.radii[:, queries.groups[query]] @ queries.norms[query]) * (1 + 1e-6) + 1

    def search(self, queries: Queries, query: int, scratch: np.ndarray, least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the batch (and scores) that may be among the ``top``, given the k-th score ``least`` so far."""
        bounds = self.bounds(queries, query)
        if bounds[0] < max(least, 1):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        scratch[queries.terms[query]] = queries.weights[query]
        rows, scores, open_ = np.zeros(0, np.int64), np.zeros(0, np.int64), [(-bounds[0], 0)]
        while open_ and -open_[0][0] >= max(least, 1):
            _, node = heapq.heappop(open_)
            if self.children[node] is not None:
                for child in self.children[node]:
                    if bounds[child] >= max(least, 1):
                        heapq.heappush(open_, (-bounds[child], child))
                continue
            low, high = self.spans[node]
            own = slice(self.starts[low], self.starts[high])
            sums = np.concatenate([[0], np.cumsum(self.scores[own] * scratch[self.terms[own]])])
            found = np.diff(sums[self.starts[low : high + 1] - self.starts[low]])
            keep = np.flatnonzero(found >= max(least, 1))
            if len(keep):
                rows, scores = np.concatenate([rows, self.order[low + keep]]), np.concatenate([scores, found[keep]])
                if len(scores) >= top:
                    least = max(least, int(np.partition(scores, -top)[-top]))
        scratch[queries.terms[query]] = 0
        keep = scores >= least
        return rows[keep], scores[keep]


def best_of(docs: list, scores: np.ndarray, top: int) -> tuple[list, np.ndarray]:
    order = sorted(range(len(docs)), key=lambda n: (-scores[n], docs[n] is None, docs[n]))[:top]
    return [docs[n] for n in order], scores[order]


def ask(listed: DataFrame, shared: Broadcast, item_field: T.StructField, top: int) -> DataFrame:
    """(item, doc, score): each task's best documents for every query of the block."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        scratch = np.zeros(queries.size, np.int64)
        best: list[tuple[list, np.ndarray]] = [([], np.zeros(0, np.int64)) for _ in queries.items]
        kind = None
        for batch in (batch.slice(start, TREE) for batch in batches for start in range(0, batch.num_rows, TREE)):
            kind = batch.schema.field("doc").type
            column = batch.column("terms")
            offsets = column.offsets.to_numpy()
            tree = BallTree(queries, batch.column("n").to_numpy(), offsets - offsets[0], column.flatten().to_numpy().astype(np.int64), batch.column("tfs").flatten().to_numpy())
            docs = batch.column("doc").to_pylist()
            for query in range(len(queries.items)):
                held, scores = best[query]
                rows, new = tree.search(queries, query, scratch, int(scores[-1]) if len(held) == top else 0, top)
                if len(rows):
                    best[query] = best_of([*held, *(docs[row] for row in rows)], np.concatenate([scores, new]), top)
        if kind is not None:
            items = [queries.items[query] for query, (held, _) in enumerate(best) for _ in held]
            columns = [pa.array(items, item_kind(item_field)), pa.array([doc for held, _ in best for doc in held], kind), pa.array(np.concatenate([scores for _, scores in best]))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc", "score"])

    schema = T.StructType([item_field, listed.schema["doc"], T.StructField("score", T.LongType())])
    return listed.mapInArrow(search, schema)


def item_kind(field: T.StructField) -> pa.DataType:
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string()}
    if field.dataType not in kinds:
        raise TypeError("ids of items are integers or text")
    return kinds[field.dataType]


def rank(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", top: int = TOP) -> DataFrame:
    """The ``top`` documents of ``docs`` (``id_col``, ``text_col``) for each text of ``items`` (``item_col``, ``text_col``): item, ``rank`` (int, from 1), document and ``score`` (long).

    Terms are runs of ASCII letters and digits and of anything that is not ASCII, A-Z lower-cased; a missing text has none. A term weighs
    ``floor(1000 ln((2N + 2) / (2df + 1)))``, and gives ``weight * (10^9 tf // (1000 tf + 12 m))`` with ``m = 75 + 25 n N // L``, for each time the item holds it. Equal scores
    go by id, a missing one last. Documents of score 0 are no result, so an item whose terms no document holds has no rows, nor has one without
    an id. Rows of ``items`` that share an id are one query. Repeated rows of ``docs`` are results of their own. Empty tables give no
    rows. Ids of items are integers or text. Other columns are not read.
    """
    octets = F.col(f"`{text_col}`").cast("binary").alias("octets")
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), octets)
    spark = docs.sparkSession
    asked = settle(asked_terms(items.select(F.col(f"`{item_col}`").alias("item"), octets).where("item IS NOT NULL")), "asked")
    found = []
    for rows in blocks_of(asked):
        numbers = {term: number for number, term in enumerate(sorted({term for _, term, _ in rows}))}
        known = spark.sparkContext.broadcast(numbers)
        listed = settle(vectors(texts, known), "vectors")
        n_docs, total = listed.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {row.term: row.df for row in frequencies(listed).collect()}
        shared = spark.sparkContext.broadcast(Queries(rows, numbers, df, n_docs, total))
        found.append(settle(ask(listed.where(F.size("terms") > 0), shared, asked.schema["item"], top), "found"))
        forget(listed)
        known.unpersist()
        shared.unpersist()
    forget(asked)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("item").alias(item_col), F.col("rank").cast("int"), F.col("doc").alias(id_col), "score")
