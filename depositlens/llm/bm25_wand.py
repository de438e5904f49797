"""Exact top-k BM25 search with block-max WAND, per shard and merged.

Corpus statistics (number of documents, mean length, document frequencies) come from one job over all texts, so every shard
scores alike and the merge of the shards' results is exact. A shard is one Arrow batch of documents. It gets an
inverted index of the terms asked for, with each term's largest contribution per block of ``BLOCK`` documents.
A query adds up the block maxima of its terms: a block whose sum is below the k-th score so far cannot hold a result and stays
closed; the best block is opened first to raise that score, then all blocks still above it. The terms of smallest maxima that
together stay below the k-th score cannot make a result by themselves: their postings are only looked up for
documents of the other terms that may still reach it. The k-th scores are carried along from shard to shard of a task.

Queries go round in blocks of about ``QUERY_TERMS`` terms; each block is one pass over the documents, with the queries broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depositlens.llm.common import settle

K1, B = 1.2, 0.75
TOP = 10
BLOCK = 256
QUERY_TERMS = 1 << 18
SLACK = 1e-8
LOOK_UP = 16
FLUSH_WORDS = 1 << 18


def words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or b"").lower().split()


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(term, df, length): in how many of ``texts`` (octets) a term is; the empty term has all texts and their length."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        length = 0

        def flush() -> pa.RecordBatch:
            lengths = np.zeros(len(held), np.int64)
            terms = list(held)
            if b"" in held:
                lengths[terms.index(b"")] = length
            batch = pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), pa.array(held.values(), pa.int64()), pa.array(lengths)], ["term", "n", "length"])
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column("octets").to_pylist():
                found = words(text)
                length += len(found)
                held.update(set(found))
                held[b""] += 1
                if len(held) >= FLUSH_WORDS:
                    yield flush()
                    length = 0
        if held:
            yield flush()

    counted = texts.select("octets").mapInArrow(count, "term binary, n bigint, length bigint")
    return counted.groupBy("term").agg(F.sum("n").alias("df"), F.sum("length").alias("length"))


def term_counts(texts: DataFrame) -> DataFrame:
    """(query_id, term, tf) of ``texts`` (query_id, octets)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(words(text)) for text in batch.column("octets").to_pylist()]
            of = np.repeat(np.arange(len(found)), [len(own) for own in found])
            if len(of):
                terms = [term for own in found for term in own]
                tfs = [n for own in found for n in own.values()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array(terms, pa.binary()), pa.array(tfs, pa.int64())], ["query_id", "term", "tf"])

    kind = texts.schema["query_id"].dataType
    schema = T.StructType([T.StructField("query_id", kind), T.StructField("term", T.BinaryType()), T.StructField("tf", T.LongType())])
    return texts.select("query_id", "octets").mapInArrow(count, schema).groupBy("query_id", "term").agg(F.sum("tf").alias("tf"))


def make_queries(texts: DataFrame, frequencies: DataFrame, n_docs: int, terms: int | None = None) -> DataFrame:
    """(query_id, place, term, idf): the distinct terms of each text of ``texts`` by tf * idf, ties by the term; all or the first ``terms``."""
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = term_counts(texts).join(frequencies.select("term", "df"), "term").withColumn("idf", idf)
    best = Window.partitionBy("query_id").orderBy(F.round(F.col("tf") * F.col("idf"), 9).desc(), "term")
    placed = weighed.withColumn("place", F.row_number().over(best))
    return (placed if terms is None else placed.where(F.col("place") <= terms)).select("query_id", "place", "term", "idf")


class Queries:
    """A block of queries: term numbers and idf; of each query the numbers of its terms."""

    def __init__(self, rows: list):
        self.ids = sorted({row.query_id for row in rows})
        place = {own: n for n, own in enumerate(self.ids)}
        self.terms = {term: n for n, term in enumerate(sorted({bytes(row.term) for row in rows}))}
        self.idf = np.zeros(len(self.terms))
        asked: list[list[int]] = [[] for _ in self.ids]
        for row in sorted(rows, key=lambda row: row.place):
            number = self.terms[bytes(row.term)]
            self.idf[number] = row.idf
            asked[place[row.query_id]].append(number)
        self.asked = [np.array(own, np.int64) for own in asked]


class Shard:
    """Inverted index over one batch of documents, for the terms asked for."""

    def __init__(self, queries: Queries, texts: list[bytes | None], mean_length: float):
        get, found, lengths = queries.terms.get, [], []
        sizes = []
        for text in texts:
            own = words(text)
            lengths.append(len(own))
            known = [number for word in own if (number := get(word)) is not None]
            sizes.append(len(known))
            found += known
        documents = np.repeat(np.arange(len(texts)), sizes)
        self.size = len(texts)
        self.keys, tf = np.unique(np.array(found, np.int64) * self.size + documents, return_counts=True)
        term, self.documents = self.keys // self.size, self.keys % self.size
        norm = K1 * (1 - B + B * np.array(lengths)[self.documents] / mean_length)
        self.parts = queries.idf[term] * (tf * (K1 + 1) / (tf + norm))
        self.first = np.searchsorted(term, np.arange(len(queries.terms) + 1))
        self.blocks = -(-self.size // BLOCK)
        cells, start = np.unique(term * self.blocks + self.documents // BLOCK, return_index=True)
        self.maxima = np.zeros(len(queries.terms) * self.blocks, np.float32)
        if len(cells):
            self.maxima[cells] = np.nextafter(np.maximum.reduceat(self.parts, start).astype(np.float32), np.float32(np.inf))
        self.maxima = self.maxima.reshape(len(queries.terms), self.blocks)
        self.tops = self.maxima.max(1).astype(np.float64)

    def search(self, asked: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Documents (and scores) that may be among the ``TOP``, given the k-th score ``least`` so far."""
        asked = asked[self.tops[asked] > 0]
        bounds = self.maxima[asked].sum(0, dtype=np.float64)
        if not len(asked) or bounds.max() + SLACK < least:
            return np.zeros(0, np.int64), np.zeros(0)
        asked = asked[np.argsort(self.tops[asked], kind="stable")]
        best = int(bounds.argmax())
        scores = self._block(asked, best)
        if np.count_nonzero(scores) >= TOP:
            least = max(least, np.partition(scores, -TOP)[-TOP])
        sums = np.cumsum(self.tops[asked])
        idle = int(np.searchsorted(sums, least - SLACK))  # so many terms stay below the k-th score together
        gap = sums[idle - 1] if idle else 0.0
        scores = self._sum(asked[idle:])
        documents = np.flatnonzero((scores > 0) & (scores + gap + SLACK >= least))
        documents = documents[bounds[documents // BLOCK] + SLACK >= least]
        scores = scores[documents]
        if idle and len(documents):
            scores = scores + self._look_up(asked[:idle], documents)
        scores = scores.round(9)
        if len(documents) > TOP:
            least = max(least, np.partition(scores, -TOP)[-TOP])
        keep = scores + SLACK >= least
        return documents[keep], scores[keep]

    def _sum(self, asked: np.ndarray) -> np.ndarray:
        """What the terms give each document."""
        if not len(asked):
            return np.zeros(self.size)
        lists = [slice(self.first[number], self.first[number + 1]) for number in asked]
        documents = np.concatenate([self.documents[own] for own in lists])
        return np.bincount(documents, np.concatenate([self.parts[own] for own in lists]), self.size)

    def _block(self, asked: np.ndarray, block: int) -> np.ndarray:
        """The scores of a block's documents."""
        start = np.searchsorted(self.keys, asked * self.size + block * BLOCK)
        end = np.searchsorted(self.keys, asked * self.size + min(self.size, (block + 1) * BLOCK))
        picked = np.concatenate([np.arange(*pair) for pair in zip(start, end, strict=True)])
        return np.bincount(self.documents[picked] - block * BLOCK, self.parts[picked], BLOCK).round(9)

    def _look_up(self, asked: np.ndarray, documents: np.ndarray) -> np.ndarray:
        """What the terms give these documents: searched for in the postings, or summed up whole if that is less work."""
        if len(asked) * len(documents) * LOOK_UP > (self.first[asked + 1] - self.first[asked]).sum():
            return self._sum(asked)[documents]
        wanted = (asked[:, None] * self.size + documents).ravel()
        places = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[places] == wanted, self.parts[places], 0.0).reshape(len(asked), -1).sum(0)


def _best(ids: list, scores: np.ndarray) -> tuple[list, np.ndarray]:
    order = sorted(range(len(ids)), key=lambda n: (-scores[n], ids[n] is None, ids[n]))[:TOP]
    return [ids[n] for n in order], scores[order]


def _search(texts: DataFrame, rows: list, mean_length: float) -> DataFrame:
    """(query_id, doc_id, score): each task's best documents for every query of the block."""
    shared = texts.sparkSession.sparkContext.broadcast(Queries(rows))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        best: list[tuple[list, np.ndarray]] = [([], np.zeros(0)) for _ in queries.ids]
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = Shard(queries, batch.column("octets").to_pylist(), mean_length)
            ids = batch.column("doc").to_pylist()
            for n, asked in enumerate(queries.asked):
                held, scores = best[n]
                found, new = shard.search(asked, scores[-1] if len(held) == TOP else 0.0)
                if len(found):
                    best[n] = _best([*held, *(ids[d] for d in found)], np.concatenate([scores, new]))
        of = [queries.ids[n] for n, (held, _) in enumerate(best) for _ in held]
        if of:
            columns = [pa.array(of), pa.array([d for held, _ in best for d in held]), pa.array(np.concatenate([scores for _, scores in best]))]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "doc_id", "score"]).cast(arrow)

    kind = texts.schema["doc"].dataType
    fields = [T.StructField("query_id", kind), T.StructField("doc_id", kind), T.StructField("score", T.DoubleType())]
    arrow = pa.schema([(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.string() if isinstance(f.dataType, T.StringType) else pa.float64()) for f in fields])
    return texts.select("doc", "octets").mapInArrow(search, T.StructType(fields))


def search(docs: DataFrame, asking: DataFrame, id_col: str = "doc_id", text_col: str = "text", terms: int | None = None) -> DataFrame:
    """The ``TOP`` documents of ``docs`` for each text of ``asking`` (same columns): query_id, rank, doc_id, score.

    A text asks with all its distinct terms, or with the ``terms`` of highest tf * idf in ``docs`` if given; BM25 scores are rounded to nine digits and ties go to
    the smaller id. A document without any of the terms is no result; a NULL or empty text, or one without an id, asks
    nothing. Rows of ``asking`` that share an id are one query. Repeated rows of ``docs`` are results of their own. Empty tables
    give no rows. Ids are integers or text; other columns are not read.
    """
    octets = F.col(f"`{text_col}`").cast("binary").alias("octets")
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), octets)
    frequencies = settle(document_frequencies(texts), "frequencies")
    total = frequencies.where(F.octet_length("term") == 0).first()
    n_docs, length = (total.df, total.length) if total else (0, 0)
    asked = asking.select(F.col(f"`{id_col}`").alias("query_id"), octets).where("query_id IS NOT NULL")
    queries = settle(make_queries(asked, frequencies.where(F.octet_length("term") > 0), n_docs, terms), "queries")
    blocks = 1 + queries.count() // QUERY_TERMS
    part = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    found = reduce(
        DataFrame.union,
        (_search(texts, queries.where(part == block).collect(), max(length, 1) / max(n_docs, 1)) for block in range(blocks)),
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return ranked.select("query_id", "rank", "doc_id", "score")
