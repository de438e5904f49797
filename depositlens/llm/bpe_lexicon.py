"""BPE encoding through a lexicon transducer of frequent words, and decoding.

What white space separates in all texts is counted by a Spark job; the words of the ``LEXICON_CHUNKS`` most frequent are
merged once and compiled into a minimal acyclic transducer: common prefixes and suffixes share states, and the numbers on the arcs
of a word add up to its row in a table of token ids. The file is written to the shared folder and memory-mapped by the
Python workers, which so share one copy on a machine; where the shared folder is a store without
file paths they use the same bytes from a broadcast. A word that the transducer does not accept is merged by the
ranks, exactly.

Strings of the file's special tokens are cut out of a text first. White space always parts words, so the rest is
taken in chunks between white space, of which most are known from earlier; a new one is normalised and split
into words by the file's own rules. Each different chunk of a batch is looked up once, and all words that are new in it walk
through the transducer together, letter by letter, as those it does not accept are merged together, pair by pair.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import struct
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache, cached_property
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from depositlens.llm.common import forget, most_frequent, pieces, settle
from depositlens.sources.shared import fresh_path

LEXICON_CHUNKS = 1 << 18
FLUSH_WORDS = 1 << 18
CACHED_CHUNKS = 1 << 19
CACHED_IDS = 1 << 22
CACHED_LENGTH = 64
SHORT = 24
MERGED_WORDS = 1 << 12
PIECE = 4 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)
NEVER = np.int32(2**31 - 1)
SPACE = pa.scalar(" ", pa.large_string())
INFORMATION_SEPARATORS = re.compile("[\x1c-\x1f]")
WHITE_SPACE = re.compile("[^\\S\x1c-\x1f]+")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies: itself, or else those from 256 on."""
    itself = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (byte for byte in range(256) if byte not in itself)
    return {byte: chr(byte) for byte in itself} | {byte: chr(256 + n) for n, byte in enumerate(others)}


END_OF_LATIN = "\u0250"
BYTE_LETTERS = byte_letters()


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all slices that begin at ``starts`` and have ``sizes``, one slice after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)])


class Pairs:
    """Ranks of pairs of token ids in an open-addressed table, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, ids: int):
        self.ids, bits = ids, max(8, (4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NEVER, np.int32)
        left = np.arange(len(keys))
        slots = self._slots(keys)
        while len(left):  # of the keys that want a free slot, the last one gets it
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[left[free]]
            placed = self.keys[slots] == keys[left]
            self.ranks[slots[placed]] = left[placed]
            left, slots = left[~placed], (slots[~placed] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MIX) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NEVER`` where there is none; an id below zero is in no pair."""
        keys = np.where((left < 0) | (right < 0), -2, left.astype(np.int64) * self.ids + right)
        slots = self._slots(keys)
        held = self.keys[slots]
        ranks = np.where(held == keys, self.ranks[slots], NEVER)
        open_ = np.flatnonzero((held != keys) & (held >= 0) & (keys >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[slots[open_]]
            same = held == keys[open_]
            ranks[open_[same]] = self.ranks[slots[open_[same]]]
            open_ = open_[~same & (held >= 0)]
        return ranks


class Vocabulary:
    """A tokenizer file's merges, ids, word pattern and special tokens."""

    def __init__(self, definition: str):
        parts = json.loads(definition)
        model = parts["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {token["content"]: token["id"] for token in parts["added_tokens"] if token["special"]}
        self.tokens = {number: token for token, number in (self.ids | self.special).items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        steps = parts["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(next(step["pattern"]["Regex"] for step in steps if step["type"] == "Split"))
        rules = Tokenizer.from_str(definition)
        self.normalize, self.split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str

    def chunks(self, text: str) -> list[str]:
        """What white space separates; special tokens are chunks of their own."""
        cut = "<|" in text
        if text.isascii() and not cut:
            text = text.lower()
        elif not cut and not INFORMATION_SEPARATORS.search(text):
            return text.split()
        found: list[str] = []
        for part in self.cut.split(text) if cut else [text]:
            if part in self.special:
                found.append(part)
            elif INFORMATION_SEPARATORS.search(part):  # white space for split(), not for the pattern
                found += filter(None, WHITE_SPACE.split(part))
            else:
                found += part.split()
        return found

    def chunk_lists(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The chunks of all texts, NULL as an empty one: one after the other, their number per text, and the text of each number."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        plain, cut = pc.string_is_ascii(texts), pc.match_substring(texts, "<|")
        odd = pc.or_(cut, pc.and_not(pc.match_substring_regex(texts, "[\x1c-\x1f]"), plain))
        kinds = (
            (pc.and_not(plain, odd), lambda some: pc.ascii_split_whitespace(pc.ascii_lower(some))),
            (pc.and_not(pc.invert(plain), odd), pc.utf8_split_whitespace),
            (odd, lambda some: pa.array(map(self.chunks, some.to_pylist()), pa.list_(pa.large_string()))),
        )
        found, sizes, order = [pa.array([], pa.large_string())], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for of_kind, split in kinds:
            places = np.flatnonzero(of_kind.to_numpy(zero_copy_only=False))
            if len(places):
                lists = split(texts.take(pa.array(places)))
                found.append(lists.flatten())
                sizes.append(pc.list_value_length(lists).to_numpy().astype(np.int64))
                order.append(places)
        chunks, sizes = pa.concat_arrays(found), np.concatenate(sizes)
        some = pc.binary_length(chunks).to_numpy() > 0  # splitting leaves empty ones at a text's ends
        return chunks.filter(pa.array(some)), np.diff(offsets(some)[offsets(sizes)]), np.concatenate(order)

    def words(self, chunk: str) -> list[str]:
        """The chunk's words, each byte as the letter that stands for it.

        Printable Latin letters are composed already, and lower-casing and splitting them needs no other tables.
        """
        if chunk.isprintable() and (chunk.isascii() or max(chunk) < END_OF_LATIN):
            low = chunk.lower()
            words = [low] if low.isalpha() else self.pattern.findall(low)
            return words if low.isascii() else [word.encode().decode("latin-1").translate(BYTE_LETTERS) for word in words]
        return [word for word, _ in self.split(self.normalize(chunk))]

    def merge(self, word: str) -> list[int]:
        """Token ids of one word: the pair of lowest rank is merged, the leftmost first, until none is left."""
        parts = list(word)
        parts[-1] += self.end
        parts = self._merge_short(parts) if len(parts) <= SHORT else self._merge_long(parts)
        return [self.ids[part] for part in parts]

    def _merge_short(self, parts: list[str]) -> list[str]:
        rank, none = self.ranks.get, len(self.ranks)
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), none)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a heap over a linked list, for words of any length."""
        size = len(parts)
        after, before = [*range(1, size), -1], [*range(-1, size - 1)]
        heap = [(self.ranks[pair], n, pair) for n, pair in enumerate(zip(parts, parts[1:], strict=False)) if pair in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, at, pair = heapq.heappop(heap)
            right = after[at]
            if right < 0 or (parts[at], parts[right]) != pair:
                continue
            parts[at], parts[right] = parts[at] + parts[right], ""
            after[at] = after[right]
            if after[right] >= 0:
                before[after[right]] = at
            after[right] = -1
            for left in (before[at], at):
                if left >= 0 and after[left] >= 0:
                    pair = (parts[left], parts[after[left]])
                    if pair in self.ranks:
                        heapq.heappush(heap, (self.ranks[pair], left, pair))
        return [part for part in parts if part]

    @cached_property
    def names(self) -> tuple[pa.Array, pa.Array]:
        """Each id in decimals, and its token."""
        most = range(max(self.tokens) + 1)
        return pa.array(map(str, most), pa.large_string()), pa.array((self.tokens.get(n, "") for n in most), pa.large_string())

    @cached_property
    def tables(self) -> tuple[Pairs, np.ndarray, np.ndarray, np.ndarray] | None:
        """The pairs' ranks, the ids they merge to, and the ids of letters inside and at the end of a word, if it has them all."""
        letters = BYTE_LETTERS.values()
        if not all(letter in self.ids and letter + self.end in self.ids for letter in letters):
            return None
        inside, final = (np.full(ord(max(letters)) + 1, -1, np.int32) for _ in range(2))
        for letter in letters:
            inside[ord(letter)], final[ord(letter)] = self.ids[letter], self.ids[letter + self.end]
        if list(self.ranks.values()) != list(range(len(self.ranks))):
            return None
        left, right, merged = (np.fromiter(ids, np.int64, len(self.ranks)) for ids in zip(*((self.ids[a], self.ids[b], self.ids[a + b]) for a, b in self.ranks), strict=True))
        most = max(self.ids.values()) + 1
        return Pairs(left * most + right, most), merged.astype(np.int32), inside, final

    def merge_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids, one word after the other: those of ``merge``."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        counts, parts, of = np.zeros(len(words), np.int64), [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        together = sizes <= SHORT if self.tables else np.zeros(len(words), bool)
        order = np.flatnonzero(together)
        order = order[np.argsort(sizes[order], kind="stable")]
        for start in range(0, len(order), MERGED_WORDS):
            some = order[start : start + MERGED_WORDS]
            counts[some], ids = self._merge_together("".join(words[n] for n in some.tolist()), sizes[some])
            parts.append(ids)
            of.append(some)
        for n in np.flatnonzero(~together).tolist():
            parts.append(np.array(self.merge(words[n]), np.int32))
            counts[n] = len(parts[-1])
            of.append(np.array([n]))
        ids, of = np.concatenate(parts), np.concatenate(of)
        starts = np.empty(len(words), np.int64)
        starts[of] = offsets(counts[of])[:-1]
        return counts, ids[ragged(starts, counts)]

    def _merge_together(self, letters: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words side by side in columns, one merge in each at a time; parts merged into the one before are -1."""
        pairs, merged, inside, final = self.tables
        codes, ends, width, columns = np.frombuffer(letters.encode("utf-16-le"), np.uint16), np.cumsum(sizes), sizes.max(), np.arange(len(sizes))
        ids = inside[codes]
        ids[ends - 1] = final[codes[ends - 1]]
        grid = np.full((width + 1, len(sizes)), -1, np.int32)
        grid[ragged(np.zeros(len(sizes), np.int64), sizes), np.repeat(columns, sizes)] = ids
        place = np.arange(width + 1, dtype=np.int32)[:, None]
        before, after = (np.repeat(place + step, len(sizes), axis=1) for step in (-1, 1))

        def key(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
            ranks = pairs(left, right)
            return np.where(ranks < NEVER, ranks << 5 | at, NEVER)  # the least is the lowest rank, the leftmost of those

        keys = np.full((width + 1, len(sizes)), NEVER, np.int32)
        for at in range(width - 1):
            keys[at] = key(grid[at], grid[at + 1], np.int32(at))
        while True:
            best = keys.min(axis=0)
            some = np.flatnonzero(best < NEVER)
            if not len(some):
                break
            at, new = best[some] & 31, merged[best[some] >> 5]
            gone = after[at, some]
            right, left = after[gone, some], before[at, some]
            grid[at, some], grid[gone, some], keys[gone, some] = new, -1, NEVER
            after[at, some], before[right, some] = right, at
            keys[at, some] = key(new, grid[right, some], at)
            has = left >= 0
            left, some, new = left[has], some[has], new[has]
            keys[left, some] = key(grid[left, some], new, left)
        rows = grid.T
        return (rows >= 0).sum(axis=1), rows[rows >= 0]


class Transducer:
    """A minimal acyclic automaton in a memory-mapped file; a word's arc outputs add up to its row of ids.

    File: five counts, then states (first arc; one more as the end), accepting flags, arc bytes, arc
    targets, arc outputs, row starts, ids.
    """

    def __init__(self, octets: mmap.mmap | bytes):
        self.map = octets
        states, arcs, rows, ids, self.root = struct.unpack_from("<5q", self.map)
        place, self.parts = 40, []
        for count, width in ((states + 1, 4), (states, 1), (arcs, 1), (arcs, 4), (arcs, 4), (rows + 1, 4), (ids, 4)):
            view = memoryview(self.map)[place : place + count * width]
            self.parts.append(view.cast("i") if width == 4 else view)
            if len(self.parts) == 3:
                self.labels = place
            place += -(-count * width // 4) * 4
        self.symbols = [bytes([byte]) for byte in range(256)]

    def __call__(self, word: bytes) -> list[int] | None:
        first, accepts, _, target, output, starts, ids = self.parts
        state, row, base = self.root, 0, self.labels
        for byte in word:
            arc = self.map.find(self.symbols[byte], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return None
            row += output[arc]
            state = target[arc]
        return ids[starts[row] : starts[row + 1]].tolist() if accepts[state] else None

    @cached_property
    def keys(self) -> np.ndarray:
        """State and byte of each arc in one number, ascending."""
        first, labels = np.asarray(self.parts[0]), np.frombuffer(self.parts[2], np.uint8)
        return np.repeat(np.arange(len(first) - 1) << 8, np.diff(first)) | labels

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word begin in the table of ids, -1 if it is not accepted, and how many it has."""
        _, accepts, _, target, output, starts, _ = map(np.asarray, self.parts)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        octets, begin = np.frombuffer(b"".join(words), np.uint8), offsets(sizes)[:-1]
        at, counts = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64)
        who, state, row, depth = np.arange(len(words)), np.full(len(words), self.root), np.zeros(len(words), np.int64), 0
        while len(who):
            done = sizes[who] == depth
            accepted = done & (accepts[state] > 0)
            at[who[accepted]] = starts[row[accepted]]
            counts[who[accepted]] = starts[row[accepted] + 1] - starts[row[accepted]]
            who, state, row = who[~done], state[~done], row[~done]
            wanted = state << 8 | octets[begin[who] + depth]
            arc = np.searchsorted(self.keys, wanted)
            has = arc < len(self.keys)
            has[has] = self.keys[arc[has]] == wanted[has]
            who, arc = who[has], arc[has]
            state, row, depth = target[arc].astype(np.int64), row[has] + output[arc], depth + 1
        return at, counts


def compile_transducer(words: dict[bytes, list[int]]) -> bytes:
    """The minimal transducer of ``words``: sorted insertion, equal suffix states are merged as they close."""
    register: dict[tuple, int] = {}
    closed: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    held: list[int] = []  # accepted words below each closed state
    order = sorted(words)

    def close(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(closed)
            closed.append(key)
            held.append(key[0] + sum(held[child] for _, child in key[1]))
        return register[key]

    path_open: list[list] = [[False, []]]  # open states along the last word: accepts, arcs of closed children
    last = b""

    def shrink(depth: int) -> None:
        while len(path_open) > depth + 1:
            node = path_open.pop()
            path_open[-1][1].append((last[len(path_open) - 1], close(node)))

    for word in order:
        common = len(os.path.commonprefix([last, word]))
        shrink(common)
        path_open.extend([False, []] for _ in word[common:])
        path_open[-1][0] = True
        last = word
    shrink(0)
    root = close(path_open[0])

    first, labels, target, output = [0], bytearray(), [], []
    for accepts, arcs in closed:
        below = int(accepts)
        for byte, child in arcs:
            labels.append(byte)
            target.append(child)
            output.append(below)
            below += held[child]
        first.append(len(target))
    starts = np.cumsum([0, *(len(words[word]) for word in order)])
    ids = [number for word in order for number in words[word]]
    out = [struct.pack("<5q", len(closed), len(target), len(order), len(ids), root)]
    for part in (first, bytes(accepts for accepts, _ in closed), bytes(labels), target, output, starts, ids):
        raw = part if isinstance(part, bytes) else np.asarray(part, np.int32).tobytes()
        out.append(raw + bytes(-len(raw) % 4))
    return b"".join(out)


def publish(spark: SparkSession, octets: bytes) -> str | None:
    """Write a file to the shared folder; its path, or None where the folder has no file paths."""
    place = urlparse(fresh_path(spark, "lexicon"))
    if place.scheme not in ("", "file"):
        return None
    os.makedirs(os.path.dirname(place.path), exist_ok=True)
    with open(place.path, "wb") as file:
        file.write(octets)
    return place.path


def mapped(path: str | None, octets: bytes) -> mmap.mmap | bytes:
    if path is None:
        return octets
    with open(path, "rb") as file:
        return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)


def frequent_words(docs: DataFrame, definition: str, text_col: str, words: int) -> set[str]:
    """The words of the most frequent chunks, ``words`` chunks at most; ``definition`` is the tokenizer file's text."""
    shared = docs.sparkSession.sparkContext.broadcast(Lexicon(definition))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, chunks = shared.value.vocabulary, Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(chunks.keys(), pa.string()), pa.array(chunks.values(), pa.int64())], ["chunk", "n"])
            chunks.clear()
            return batch

        for batch in pieces(batches, "text", PIECE):
            found = vocabulary.chunk_lists(batch.column(0))[0].value_counts()
            for chunk, n in zip(*(part.to_pylist() for part in found.flatten()), strict=True):
                chunks[chunk] += n
            if len(chunks) >= FLUSH_WORDS:
                yield flush()
        if chunks:
            yield flush()

    texts = docs.select(F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    counted = settle(texts.mapInArrow(count, "chunk string, n bigint").groupBy("chunk").agg(F.sum("n").alias("n")), "chunk-counts")
    found = most_frequent(counted, "chunk", "n", words)
    forget(counted)
    vocabulary = vocabulary_of(definition)
    return {word for chunk, _ in found if chunk not in vocabulary.special for word in vocabulary.words(chunk)}


@cache
def vocabulary_of(definition: str) -> Vocabulary:
    return Vocabulary(definition)


class Encoder:
    """Ids of chunks, filled as chunks are met and begun anew when there are ``CACHED_CHUNKS`` or ``CACHED_IDS``."""

    def __init__(self, vocabulary: Vocabulary, transducer: Transducer):
        self.vocabulary, self.transducer = vocabulary, transducer
        self.lexicon_ids = np.asarray(transducer.parts[6])
        self._begin()

    def _begin(self) -> None:
        self.rows: dict[str, int] = {}  # chunk -> its slice of the ids
        self.starts, self.counts, self.ids = (np.zeros(0, kind) for kind in (np.int64, np.int64, np.int32))

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids, one word after the other."""
        starts, counts = self.transducer.find([word.encode() for word in words])
        special = self.vocabulary.special
        fixed = [n for n, word in enumerate(words) if word in special]
        starts[fixed], counts[fixed] = range(len(self.lexicon_ids), len(self.lexicon_ids) + len(fixed)), 1
        rare = np.flatnonzero(starts < 0)
        counts[rare], merged = self.vocabulary.merge_all([words[n] for n in rare.tolist()])
        starts[rare] = len(self.lexicon_ids) + len(fixed) + offsets(counts[rare])[:-1]
        ids = np.concatenate([self.lexicon_ids, np.array([special[words[n]] for n in fixed], np.int32), merged])
        return counts, ids[ragged(starts, counts)]

    def _learn(self, chunks: list[str]) -> None:
        """Append the ids of ``chunks``."""
        special, split = self.vocabulary.special, self.vocabulary.words
        parts = [[chunk] if chunk in special else split(chunk) for chunk in chunks]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        number: dict[str, int] = {}
        of = np.fromiter((number.setdefault(word, len(number)) for words in parts for word in words), np.int64, int(sizes.sum()))
        counts, ids = self.word_ids(list(number))
        ids = ids[ragged(offsets(counts)[:-1][of], counts[of])]
        ends = offsets(counts[of])[offsets(sizes)]
        self.starts = np.concatenate([self.starts, len(self.ids) + ends[:-1]])
        self.counts = np.concatenate([self.counts, np.diff(ends)])
        self.ids = np.concatenate([self.ids, ids])

    def _slices(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each chunk begin, and how many it has."""
        if len(self.rows) > CACHED_CHUNKS or len(self.ids) > CACHED_IDS:
            self._begin()
        rows = np.fromiter(map(self.rows.get, chunks, [-1] * len(chunks)), np.int64, len(chunks))
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = np.arange(len(self.starts), len(self.starts) + len(new))
            found = [chunks[n] for n in new.tolist()]
            self._learn(found)
            self.rows.update((chunk, row) for chunk, row in zip(found, rows[new].tolist(), strict=True) if len(chunk) <= CACHED_LENGTH)
        return self.starts[rows], self.counts[rows]

    def encode_all(self, texts: pa.Array, lists: bool = False) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Per text the number of tokens, their ids (``lists``: as integers, or else joined by a space) and the tokens joined by a space."""
        chunks, sizes, order = self.vocabulary.chunk_lists(texts)
        coded = chunks.dictionary_encode()
        codes = coded.indices.to_numpy()
        starts, counts = self._slices(coded.dictionary.to_pylist())
        ids, of_chunk = self.ids[ragged(starts, counts)], pa.array(offsets(counts))
        total = offsets(counts[codes])[offsets(sizes)]
        some = counts[codes] > 0
        if not some.all():
            codes, sizes = codes[some], np.diff(offsets(some)[offsets(sizes)])
        of_text, places = pa.array(offsets(sizes)), pa.array(codes)

        def joined(names: pa.Array) -> pa.Array:
            by_chunk = pc.binary_join(pa.LargeListArray.from_arrays(of_chunk, names.take(pa.array(ids))), SPACE)
            return pc.binary_join(pa.LargeListArray.from_arrays(of_text, by_chunk.take(places)), SPACE)

        if lists:
            flat = ids[ragged(offsets(counts)[:-1][codes], counts[codes])]
            numbers = pa.LargeListArray.from_arrays(pa.array(total), pa.array(flat))
        else:
            numbers = joined(self.vocabulary.names[0])
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return np.diff(total)[back], numbers.take(pa.array(back)), joined(self.vocabulary.names[1]).take(pa.array(back))

    def encode(self, text: str) -> tuple[int, str, str]:
        counts, ids, tokens = self.encode_all(pa.array([text], pa.large_string()))
        return int(counts[0]), ids[0].as_py(), tokens[0].as_py()


class Lexicon:
    """What workers encode with, made by each at first use. A worker keeps it from task to task as the value of a broadcast, and drops it
    with the first task that does not read that broadcast, so steps after this one have the memory for themselves."""

    def __init__(self, definition: str, path: str | None = None, octets: bytes | None = None):
        self.definition, self.path, self.octets = definition, path, octets

    @cached_property
    def vocabulary(self) -> Vocabulary:
        return Vocabulary(self.definition)

    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(self.vocabulary, Transducer(mapped(self.path, self.octets)))


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", digest: bool = False, keep_text: bool = True, lexicon_chunks: int = LEXICON_CHUNKS) -> DataFrame:
    """``docs`` with ``n_tokens`` and either ``ids`` (array of int) and ``decoded`` or, with ``digest``, ``ids_sha256``
    (of the decimal ids joined by a space) and ``decoded_sha256`` in place of them.

    Ids and decoded text are those of the tokenizer file without added, truncated or padded tokens. NULL counts as
    an empty text: no tokens, empty decoded text. Columns of ``docs`` with one of the new names are replaced; the
    text column goes unless ``keep_text``.
    Repeated rows stay rows; an empty table gives no rows.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()
    spark = docs.sparkSession
    vocabulary = vocabulary_of(definition)
    lexicon = {word.encode(): vocabulary.merge(word) for word in frequent_words(docs, definition, text_col, lexicon_chunks)}
    octets = compile_transducer(lexicon)
    shared = spark.sparkContext.broadcast(Lexicon(definition, publish(spark, octets), octets))
    new = [T.StructField("n_tokens", T.LongType())]
    if digest:
        new += [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    else:
        new += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    read = [field for field in docs.schema.fields if field.name.lower() not in {f.name for f in new}]

    place = [field.name.lower() for field in read].index(text_col.lower())
    kept = [n for n in range(len(read)) if keep_text or n != place]

    def digests(texts: pa.Array) -> pa.Array:
        return pa.array((hashlib.sha256(text).hexdigest() for text in texts.cast(pa.large_binary()).to_pylist()), pa.string())

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value.encoder
        for batch in pieces(batches, read[place].name, PIECE):
            counts, ids, tokens = encoder.encode_all(batch.column(place), lists=not digest)
            made = [pa.array(counts), *((digests(ids), digests(tokens)) if digest else (ids.cast(pa.list_(pa.int32())), tokens.cast(pa.string())))]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *made], [*(read[n].name for n in kept), *(f.name for f in new)])

    ready = docs.select(*(F.col(f"`{field.name}`") for field in read))
    return ready.mapInArrow(work, T.StructType([*(read[n] for n in kept), *new]))
