"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of up to three preceding bytes with the counts of the byte that follows. A
context that has seen the next byte gives it n / (t + d), for t bytes and d different ones seen; otherwise the escape
d / (t + d) passes the bytes not yet seen on to the next shorter context, with the seen ones excluded, down to
equal shares of all 256 bytes. The statistics are frozen after training, so the code length of a byte depends on
its three predecessors alone and is tabulated once; a text's code length under every language is then a sum of table rows.
The language with the shortest code wins; the score is its share of 2 ** -length.

Trained on a bounded sample of labelled texts, ``SAMPLE_TEXTS`` whole texts of each language at most. The tree
keeps the ``MAX_CONTEXTS`` most frequent contexts of three bytes and all shorter ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depositlens.llm.common import crc_bucket, free_name, pieces

UNKNOWN = "und"
SAMPLE_TEXTS = 256
MAX_CONTEXTS = 1 << 15
CHUNK = 1 << 19
PAD = b"\n\n\n"
LETTER = regex.compile(r"\p{L}")


def octets(text: str | None) -> bytes | None:
    """What is coded: lower-cased text in UTF-8; None for a text without letters."""
    return text.lower().encode() if text and LETTER.search(text) else None


def held_out(key: Column) -> Column:
    """Documents that are never learned from; one without an id is learned from."""
    return F.coalesce(crc_bucket(key, 4) == 2, F.lit(False))


def _gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each run of four bytes, first byte highest, with its count; a text starts after three line feeds."""
    found: dict[int, np.ndarray] = {}
    for n, text in enumerate(texts):
        x = np.frombuffer(PAD + text, np.uint8).astype(np.uint32)
        found[n] = (x[:-3] << 24) | (x[1:-2] << 16) | (x[2:-1] << 8) | x[3:]
    grams = np.concatenate(list(found.values())) if found else np.zeros(0, np.uint32)
    return np.unique(grams, return_counts=True)


def sample_counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """(lang, gram, n) over a sample: of each language the text of smallest id hash in each of ``texts`` hash classes."""
    known = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    hashed = F.xxhash64("id")
    chosen = (
        known.groupBy(F.col("lang").alias("of"), F.pmod(hashed, F.lit(texts)).alias("part"))
        .agg(F.min_by("id", hashed).alias("chosen"))
        .select("of", "chosen")
    )
    sample = known.join(
        F.broadcast(chosen), (known["lang"] == chosen["of"]) & known["id"].eqNullSafe(chosen["chosen"]), "left_semi"
    ).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = [octets(text) or b"" for text in batch.column(1).to_pylist()]
            for lang in sorted(set(langs)):
                grams, counts = _gram_counts([text for text, own in zip(texts, langs, strict=True) if own == lang])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(counts.astype(np.int64))],
                    ["lang", "gram", "n"],
                )

    counted = sample.mapInArrow(count, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTrees:
    """Frozen code lengths: ``bits[state * symbols + symbol, language]``, ``state`` from three preceding symbols."""

    def __init__(self, langs: np.ndarray, grams: np.ndarray, counts: np.ndarray, max_contexts: int = MAX_CONTEXTS):
        self.languages = sorted(set(langs.tolist()))
        parts = np.stack([(grams >> shift) & 255 for shift in (24, 16, 8, 0)]).astype(np.int64)
        seen = np.unique(parts)
        self.symbol = np.zeros(256, np.int64)  # 0: a byte that training has not seen
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        size = self.size = len(seen) + 1
        a, b, c, d = self.symbol[parts]
        which = np.searchsorted(self.languages, langs) if len(langs) else np.zeros(0, np.int64)
        keys = (a * size + b) * size + c
        distinct, place = np.unique(keys, return_inverse=True)
        weight = np.bincount(place, counts, len(distinct)) if len(distinct) else np.zeros(0)
        top = np.sort(distinct[np.lexsort((distinct, -weight))[:max_contexts]])
        contexts = [np.zeros(1, np.int64), np.unique(c), np.unique(b * size + c), top]
        first = np.cumsum([0, *map(len, contexts)])
        self.bits = np.zeros((first[-1], size, len(self.languages)), np.float32)
        shares = np.ones(size)
        shares[0] = 256 - len(seen)
        for k in range(len(self.languages)):
            own = which == k
            rows = shares[None, :] / 256
            for order, known in enumerate(contexts):
                context = (keys % size**order)[own]
                at = np.searchsorted(known, context)
                at[at == len(known)] = 0
                hit = known[at] == context if len(known) else np.zeros(len(context), bool)
                n = np.bincount(at[hit] * size + d[own][hit], counts[own][hit], len(known) * size).reshape(-1, size)
                shorter = known % size ** max(order - 1, 0)
                up = rows if order == 0 else rows[np.searchsorted(contexts[order - 1], shorter)]
                rows = self._rows(n, up)
                self.bits[first[order] : first[order + 1], :, k] = -np.log2(rows / shares)
        self.bits = self.bits.reshape(first[-1] * size, len(self.languages))
        self.state = np.zeros(size**3, np.int32)
        for order, known in enumerate(contexts[1:], 1):
            tails = known[:, None] + np.arange(0, size**3, size**order)[None, :]
            self.state[tails.ravel()] = np.repeat(first[order] + np.arange(len(known)), tails.shape[1])

    @staticmethod
    def _rows(n: np.ndarray, up: np.ndarray) -> np.ndarray:
        """Shares of the next symbol in contexts with counts ``n``, escaping to the shares ``up``."""
        total, kinds = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True)
        rest = np.where(n > 0, 0, up)
        left = rest.sum(1, keepdims=True)
        escape = np.where(left > 0, kinds, 0) / np.maximum(total + np.where(left > 0, kinds, 0), 1)
        own = n / np.maximum(total + np.where(left > 0, kinds, 0), 1)
        return np.where(total > 0, own + escape * rest / np.where(left > 0, left, 1), up)

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of each text (rows) under each language (columns), in pieces of ``CHUNK`` bytes."""
        totals = np.zeros((len(texts), len(self.languages)))
        pieces: list[tuple[int, bytes]] = []
        held = 0
        for n, text in enumerate(texts):
            for start in range(0, len(text), CHUNK):
                before = (PAD + text[max(start - 3, 0) : start])[-3:]
                pieces.append((n, before + text[start : start + CHUNK]))
                held += len(pieces[-1][1])
                if held >= CHUNK:
                    self._add(totals, pieces)
                    pieces, held = [], 0
        if pieces:
            self._add(totals, pieces)
        return totals

    def _add(self, totals: np.ndarray, pieces: list[tuple[int, bytes]]) -> None:
        symbols = self.symbol[np.frombuffer(b"".join(piece for _, piece in pieces), np.uint8)]
        context = (symbols[:-3] * self.size + symbols[1:-2]) * self.size + symbols[2:-1]
        costs = self.bits[self.state[context] * self.size + symbols[3:]]
        ends = np.cumsum([len(piece) for _, piece in pieces])
        starts = np.concatenate([[0], ends[:-1]])  # of the piece's own bytes in costs: three bytes are context
        bounds = np.stack([starts, ends - 3], 1).ravel()
        sums = np.add.reduceat(costs, bounds[:-1], axis=0, dtype=np.float64)[::2]
        np.add.at(totals, [n for n, _ in pieces], sums)


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_texts: int = SAMPLE_TEXTS) -> ContextTrees:
    counts = sample_counts(docs, id_col, text_col, lang_col, sample_texts).toPandas()
    return ContextTrees(
        counts["lang"].to_numpy(object), counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    )


def _judge(model: ContextTrees, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    rows = [i for i, text in enumerate(texts) if text is not None] if model.languages else []
    if rows:
        bits = model.lengths([texts[i] for i in rows])
        best = bits.argmin(1)
        scores[rows] = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
        for i, k in zip(rows, best, strict=True):
            langs[i] = model.languages[k]
    return langs, scores


def with_language(docs: DataFrame, model: ContextTrees, lang: str, score: str, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns: the language predicted from the text alone, and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = [column.lower() for column in docs.columns].index(text_col.lower())
    name = docs.columns[place]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in pieces(batches, name, CHUNK):
            langs, scores = _judge(trees, [octets(text) for text in batch.column(place).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores)], [*batch.schema.names, lang, score])

    fields = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    return docs.mapInArrow(judge, T.StructType([*docs.schema.fields, *fields]))


def predict_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_texts: int = SAMPLE_TEXTS
) -> DataFrame:
    """Per row of ``docs``: id, held_out, lang_pred, score.

    Learned from texts with a language whose crc32 of the id is not 2 modulo 4. A text that is NULL or has no
    letters is ``und`` with score 0, as is every text if nothing could be learned. Ties go to the first language
    by name. Repeated rows stay rows; empty ``docs`` give no rows; other columns are not read.
    """
    model = train(docs, id_col, text_col, lang_col, sample_texts)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = with_language(texts, model, "lang_pred", "score")
    return found.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def keep_known_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is known (not ``und``), as they are."""
    model = train(docs, id_col, text_col, lang_col)
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    return with_language(docs, model, lang, score, text_col).where(F.col(lang) != UNKNOWN).drop(lang, score)
