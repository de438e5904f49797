"""Operators over the whole corpus, against brute force: repeats, language model, decontamination, near-copies, search, pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import difference, oracle_connection
from depositlens.llm import bm25_wand, common, decontaminate, log_bilinear, repeat_bwt, simhash_balls
from depositlens.llm.components import components
from depositlens.llm.queries import ORACLE, QUERIES

DOCS = "doc_id long, text string"
FOLDER = "/root/testdata/sf0.001"


def words(chance, n):
    return " ".join("".join(chance.choices("abcde", k=chance.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Own text, exact and near copies, a shared passage, tiny, empty and missing texts, one text of one letter."""
    chance = random.Random(3)
    found = [words(chance, chance.randint(1, 150)) for _ in range(40)]
    passage = words(chance, 60)
    found += [f"{words(chance, 20)} {passage} {words(chance, 20)}" for _ in range(12)]
    found += [found[3], found[3], found[45], found[7].replace("a", "b", 1), found[9] + " tail", None, "", " \n", "a" * 700, "É" * 300]
    return found


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOCS)


def test_queries_equal_their_sql(spark):
    connection = oracle_connection(FOLDER)
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, FOLDER)
        result = connection.execute(sql)
        assert difference([tuple(r) for r in df.collect()], df.columns, result.fetchall(), [c[0] for c in result.description]) is None


# --- components ----------------------------------------------------------------------------------------


def test_components(spark):
    pairs = [(n, n + 1) for n in range(1, 60)] + [(100, n) for n in range(101, 130)] + [(200, 201), (201, 200), (7, 7), (None, 3)]
    labels, _ = components(spark.createDataFrame(pairs, "x long, y long"))
    found = defaultdict(set)
    for row in labels.collect():
        found[row.label].add(row.node)
    assert sorted(map(sorted, found.values())) == [list(range(1, 61)), list(range(100, 130)), [200, 201]]
    labels, _ = components(spark.createDataFrame([], "x long, y long"))
    assert labels.isEmpty()


# --- near-copies ---------------------------------------------------------------------------------------


def brute_fingerprint(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(own[n : n + 3]) for n in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_near_copies(spark, docs, texts):
    prints = [brute_fingerprint(text) for text in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for a, x in enumerate(prints):
            for b, y in enumerate(prints):
                if (x ^ y).bit_count() <= 2:
                    label[a] = min(label[a], label[b])
    found = simhash_balls.near_copy_classes(docs.withColumn("fp", F.lit("clash"))).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == [(n, f"{prints[n]:016x}", label[n]) for n in range(len(texts))]
    kept = simhash_balls.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(label))


def test_links_of_two_bits(spark):
    prints = [0, 0b11, 0b111, 0b11111, -(1 << 63), -1, -4, 0xF0F0F0F0]
    labels, _ = components(simhash_balls.links(spark.createDataFrame([(p,) for p in prints], "fp long")))
    groups = defaultdict(set)
    for row in labels.collect():
        groups[row.label].add(row.node)
    assert sorted(map(sorted, groups.values())) == [sorted(prints[:5]), [-4, -1]]


def test_near_copies_with_nulls_and_repeats(spark):
    long = " ".join(map(str, range(40)))
    rows = [(None, long), (1, long), (1, long), (None, "alone here now"), (None, "alone here now"), (5, "other words in this"), (5, "quite different text there")]
    found = simhash_balls.drop_near_copies(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == [(0, "alone here now"), (1, long), (5, "other words in this"), (5, "quite different text there")]
    assert simhash_balls.near_copy_classes(spark.createDataFrame([], DOCS)).isEmpty()


def test_near_copies_hold_no_balls_before_the_shuffle(spark):
    plan = simhash_balls.links(spark.range(5).withColumnRenamed("id", "fp"))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(ball", 1)
    assert "HashAggregate" in above and "Generate explode" in below
    assert "Aggregate" not in below
    assert "Exchange" in below.split("Generate explode", 1)[1]  # fingerprints are spread before they become 65 rows


def test_near_copies_sort_and_gather_no_whole_rows(spark, docs, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    plan = simhash_balls.drop_near_copies(docs)._jdf.queryExecution().executedPlan().toString()
    assert "text" in plan
    assert not [line for line in plan.splitlines() if "Aggregate" in line and "text" in line]
    rows = plan.split("FileScan parquet", 1)[0]
    assert rows.count("Exchange hashpartitioning(") == 1, plan


# --- decontamination -----------------------------------------------------------------------------------


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("block_bytes", [64 << 20, 2000])
def test_contamination(spark, docs, texts, block_bytes):
    items = [(1, texts[45]), (2, "Ab, c! " + (texts[4] or "")), (3, "a b"), (3, "a b"), (4, None), (5, ""), (6, "d"), (None, texts[5]), (7, "é É")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = []
    for n, text in enumerate(texts):
        own, hit, held = bench_words(text), set(), set()
        for item, item_text in items:
            parts = bench_words(item_text)
            size = min(len(parts), 10)
            windows = {tuple(parts[s : s + size]) for s in range(len(parts) - size + 1)} if parts else set()
            places = [s for s in range(len(own) - size + 1) if tuple(own[s : s + size]) in windows] if windows else []
            hit.update(p for s in places for p in range(s, s + size))
            held.update([str(item)] if places and item is not None else [])
        expected.append((n, len(own), len(hit), sorted(held)))
    found = decontaminate.contamination(docs.withColumn("words", F.lit(1)), bench, block_bytes=block_bytes).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found) == expected
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [row[0] for row in expected if not row[2]]


@pytest.mark.parametrize("block_bytes", [30_000, 64 << 20])
def test_a_window_of_all_items_is_one_prefix_row(spark, block_bytes):
    shared = "one two three four five six seven eight nine ten"
    items = [(f"i{n}", f"{shared} own{n}" if n % 3 else shared) for n in range(300)] + [(None, shared), ("short", "alpha beta"), ("none", None)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    members = decontaminate.item_windows(bench, "item_id", "text", 10)
    prefixes = decontaminate.prefix_tokens(members, 5)
    assert members.where(F.col("window") == shared).count() == 301
    assert prefixes.where(F.col("window") == shared).count() == 1 and prefixes.count() == 1 + 200 + 1
    texts = [f"x {shared} own4 y {shared}", shared.upper(), "alpha  beta", "clean words", "", None, f"{shared} {shared}"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, shared)], "doc_id long, text string")
    found = {row.doc_id: row for row in decontaminate.contamination(docs, bench, block_bytes=block_bytes).collect()}
    everyone = sorted(f"i{n}" for n in range(300))
    assert len(found) == 8
    assert [found[i].n_hit for i in range(7)] == [21, 10, 2, 0, 0, 0, 20] and found[None].n_hit == 10
    assert all(found[i].items == everyone for i in (0, 1, 6, None))
    assert found[2].items == ["short"] and all(found[i].items == [] for i in (3, 4, 5))


def test_contamination_stays_native_and_keeps_rows(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    twice = docs.union(docs)
    found = decontaminate.contamination(twice, bench)
    assert found.count() == twice.count() and found.where("n_hit > 0").isEmpty()
    assert "Python" not in found._jdf.queryExecution().toString()
    assert decontaminate.contamination(docs.limit(0), bench).isEmpty()


# --- repeats -------------------------------------------------------------------------------------------


def brute_repeats(texts, length):
    octets = [(text or "").encode() for text in texts]
    counts = Counter(own[s : s + length] for own in octets for s in range(len(own) - length + 1))
    found = []
    for n, own in enumerate(octets):
        gone = bytearray(len(own))
        for s in range(len(own) - length + 1):
            if counts[own[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        kept = bytes(octet for octet, flag in zip(own, gone, strict=True) if not flag)
        found.append((n, len(own), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return found


@pytest.mark.parametrize("length", [64, 200])
def test_repeats(docs, texts, length):
    found = repeat_bwt.remove_repeats(docs, length=length).collect()
    assert sorted(tuple(row)[:5] for row in found) == brute_repeats(texts, length)


def test_repeats_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(repeat_bwt, "SHARD_ANCHORS", 60)
    chance = random.Random(12)
    passage = words(chance, 90)
    own = [words(chance, chance.randint(30, 120)) for _ in range(60)]
    own += [f"{text[: chance.randint(0, 200)]} {passage[chance.randint(0, 40) :]} {text[-50:]}" for text in own[:20]] + [own[5], own[5] + "é"]
    found = repeat_bwt.remove_repeats(spark.createDataFrame(list(enumerate(own)), DOCS), length=64).collect()
    assert sorted(tuple(row)[:5] for row in found) == brute_repeats(own, 64)


def test_repeats_of_the_registered_length(spark):
    chance = random.Random(13)
    passage = words(chance, 200).encode()
    own = [words(chance, 150) for _ in range(12)]
    for n, size in enumerate((399, 400, 401, 399, 640)):
        start = 11 * n
        part = passage[start : start + size].decode()
        own += [f"{own[n][:90]}#{part}#{own[n][300:]}", f"{n}:{part}:{n}"]
    found = repeat_bwt.remove_repeats(spark.createDataFrame(list(enumerate(own)), DOCS)).collect()
    expected = brute_repeats(own, 400)
    assert sorted(tuple(row)[:5] for row in found) == expected and sum(row[2] > 0 for row in expected) > 5


def test_repeated_rows_and_nulls(spark, texts):
    rows = [(None, texts[44]), (1, texts[44]), (1, texts[44]), (2, None)]
    found = repeat_bwt.remove_repeats(spark.createDataFrame(rows, DOCS).withColumn("row", F.lit(0)), length=64).collect()
    assert sorted((r.doc_id or 0, r.n_removed == r.n_bytes) for r in found) == [(0, True), (1, True), (1, True), (2, True)]
    assert repeat_bwt.remove_repeats(spark.createDataFrame([], DOCS)).isEmpty()


def test_anchors_are_local_and_dense():
    cut = repeat_bwt.Cut(400)
    chance = random.Random(1)
    data = bytes(chance.choices(b"abcdefgh ", k=5000))
    inner = repeat_bwt.anchors(data[1000:1400], cut)
    inner = {1000 + x for x in inner.tolist() if cut.left <= x <= cut.last}
    whole = {x for x in repeat_bwt.anchors(data, cut).tolist() if 1000 + cut.left <= x <= 1000 + cut.last}
    assert inner == whole and inner
    parts = [at for _, at, _ in repeat_bwt._parsed([data], cut)]
    assert np.concatenate(parts).tolist() == [x for x in repeat_bwt.anchors(data, cut).tolist() if cut.left <= x <= len(data) - cut.right]


def test_long_text_in_pieces(monkeypatch):
    cut = repeat_bwt.Cut(400)
    data = bytes(random.Random(2).choices(b"abcdefgh ", k=9000))
    whole = [(at.tolist(), symbols) for _, at, symbols in repeat_bwt._parsed([data], cut)]
    monkeypatch.setattr(repeat_bwt, "PIECE", 1000)
    parts = list(repeat_bwt._parsed([data], cut))
    assert [x for _, at, _ in parts for x in at.tolist()] == whole[0][0] and [s for *_, symbols in parts for s in symbols] == whole[0][1]


def test_intervals_are_those_of_sorted_suffixes():
    chance = np.random.default_rng(1)
    symbols = chance.integers(0, 4, 200)
    rows, at = np.repeat([0, 1], 100), np.tile(np.arange(100), 2)
    before = np.where(at > 0, 1, 0)
    suffixes, first, longer = repeat_bwt.transform(rows, at, before, symbols)
    key, lo, hi = repeat_bwt.extend(first, longer, *repeat_bwt.first_intervals(first))
    found = Counter(tuple(symbols[suffixes[x]] for x in [a]) + (int(symbols[suffixes[a] + 1]),) for a, b in zip(lo, hi, strict=True) for _ in range(b - a))
    pairs = Counter((int(a), int(b)) for n in (0, 100) for a, b in zip(symbols[n : n + 99], symbols[n + 1 : n + 100], strict=True))
    assert {(int(a), b): n for (a, b), n in found.items()} == pairs and len(set(key)) == len(key)


# --- language model ------------------------------------------------------------------------------------


def test_scores(spark, docs, texts):
    tokens = [(text or "").encode().lower().split() + [b""] for text in texts]
    held = [zlib.crc32(str(n).encode()) % 7 == 2 for n in range(len(texts))]
    counts = Counter(token for own, out in zip(tokens, held, strict=True) if not out for token in own)
    total, kinds = sum(counts.values()), len(counts)
    for known in (log_bilinear.KNOWN, 5):  # counts from the broadcast, or from the join
        found = {r.doc_id: r for r in log_bilinear.score_texts(docs.withColumn("word", F.lit(1)), known=known).collect()}
        for n, own in enumerate(tokens):
            base = sum(math.log10((counts[token] + 1) / (total + kinds + 1)) for token in own)
            row = found[n]
            assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[n], len(own), sum(t in counts for t in own), total)
            assert math.isclose(row.base_score, base, abs_tol=1e-9) and row.score < 0
        if known > 5:
            assert sum(r.score for r in found.values()) > sum(r.base_score for r in found.values())
    twice = log_bilinear.score_texts(spark.createDataFrame([(3, "a b"), (3, "a b"), (None, None)], DOCS)).collect()
    assert len(twice) == 3 and twice[0].train_tokens == 7
    assert log_bilinear.score_texts(spark.createDataFrame([], DOCS)).isEmpty()


def test_frequent_words_are_bounded_in_bytes(spark):
    rows = [(b"a", 5), (b"b" * common.LONGEST_WORD, 9), (b"c" * (common.LONGEST_WORD + 1), 99), (b"", 1)]
    for kind, cast in (("binary", bytes), ("string", bytes.decode)):
        counted = spark.createDataFrame([(cast(word), n) for word, n in rows], f"word {kind}, n long")
        assert common.most_frequent(counted, "word", "n", 10) == [(cast(b"b" * common.LONGEST_WORD), 9), (cast(b"a"), 5), (cast(b""), 1)]
    accented = spark.createDataFrame([("é" * common.LONGEST_WORD, 3)], "word string, n long")
    assert common.most_frequent(accented, "word", "n", 10) == []


def test_shares_are_normalised_and_gradient_is_right():
    model = log_bilinear.initial_model(np.full(log_bilinear.CLASSES, 1 / log_bilinear.CLASSES))
    pairs = np.array([3, 777, (log_bilinear.START) * (log_bilinear.CLASSES + 1) + log_bilinear.START])
    assert np.allclose((10 ** model.log10_shares(pairs)).sum(1), 1)
    chance = np.random.default_rng(2)
    counts, noise = chance.integers(0, 5, (3, log_bilinear.CLASSES)).astype(float), np.full(log_bilinear.CLASSES, 1 / log_bilinear.CLASSES)

    def objective(own):
        odds = own.predicted(pairs) @ own.targets.T + own.bias - np.log(log_bilinear.NOISE * noise)
        gain = counts * -np.logaddexp(0, -odds) - counts.sum(1, keepdims=True) * log_bilinear.NOISE * noise * np.logaddexp(0, odds)
        return gain.sum() / counts.sum()

    slope = log_bilinear.nce_gradient(model, pairs, counts, noise)
    for part, place in ((0, (5, 2)), (1, (log_bilinear.START, 1)), (2, (0, 3)), (3, (9,))):
        step = [p.copy() for p in model]
        step[part][place] += 1e-5
        assert math.isclose((objective(log_bilinear.Model(*step)) - objective(model)) / 1e-5, slope[part][place], rel_tol=1e-2, abs_tol=1e-6)


# --- search --------------------------------------------------------------------------------------------


def test_search_is_exact(spark, docs, texts, settings):
    settings({"spark.sql.execution.arrow.maxRecordsPerBatch": "7"})
    found = bm25_wand.search(docs, docs.where("doc_id % 5 = 0"), terms=6).collect()
    tfs = [Counter((text or "").encode().lower().split()) for text in texts]
    df = Counter(term for own in tfs for term in own)
    mean = sum(sum(own.values()) for own in tfs) / len(tfs)
    idf = {term: math.log(1 + (len(tfs) - n + 0.5) / (n + 0.5)) for term, n in df.items()}
    expected = []
    for q in range(0, len(texts), 5):
        asked = sorted(tfs[q], key=lambda term: (-round(tfs[q][term] * idf[term], 9), term))[:6]
        scores = [(-round(sum(idf[t] * own[t] * 2.2 / (own[t] + 1.2 * (0.25 + 0.75 * sum(own.values()) / mean)) for t in asked), 9), n) for n, own in enumerate(tfs)]
        expected += [(q, rank, n) for rank, (s, n) in enumerate(sorted(x for x in scores if x[0] < 0)[:10], 1)]
    assert sorted((r.query_id, r.rank, r.doc_id) for r in found) == expected
    assert bm25_wand.search(docs.limit(0), docs).isEmpty() and bm25_wand.search(docs, docs.limit(0)).isEmpty()


def test_search_asks_with_the_whole_text(spark, settings):
    settings({"spark.sql.execution.arrow.maxRecordsPerBatch": "300"})
    chance = random.Random(5)
    frequent = [f"w{n}" for n in range(400)]
    texts = [" ".join(chance.choices(frequent, [1 / (n + 1) for n in range(400)], k=chance.randint(5, 160))) for _ in range(900)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    found = bm25_wand.search(docs, docs.where("doc_id % 60 = 0")).collect()
    tfs = [Counter(text.encode().split()) for text in texts]
    df = Counter(term for own in tfs for term in own)
    mean = sum(sum(own.values()) for own in tfs) / len(tfs)
    idf = {term: math.log(1 + (len(tfs) - n + 0.5) / (n + 0.5)) for term, n in df.items()}
    expected = []
    for q in range(0, len(texts), 60):
        scores = [(-round(sum(idf[t] * own[t] * 2.2 / (own[t] + 1.2 * (0.25 + 0.75 * sum(own.values()) / mean)) for t in tfs[q] if t in own), 9), n) for n, own in enumerate(tfs)]
        expected += [(q, rank, n) for rank, (s, n) in enumerate(sorted(x for x in scores if x[0] < 0)[:10], 1)]
    assert max(len(tfs[q]) for q in range(0, len(texts), 60)) > 40
    assert sorted((r.query_id, r.rank, r.doc_id) for r in found) == expected


# --- pipeline ------------------------------------------------------------------------------------------


def test_pipeline(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "decontamination", "pii", "bpe"]
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns == [*source.columns, "n_tokens", "ids_sha256", "decoded_sha256"]
    prints = {row.doc_id: brute_fingerprint(row.text) for row in source.collect() if row.text and re.search(r"[^\W\d_]", row.text)}
    label = {n: n for n in prints}
    for _ in range(6):
        for a in prints:
            label[a] = min(label[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2)
    kept = {n for n in prints if label[n] == n}
    dirty = {r[0] for r in duckdb.execute(ORACLE["op7_decontamination"].replace("FROM documents", f"FROM '{FOLDER}/documents.parquet'").replace("FROM benchmark", f"FROM '{FOLDER}/benchmark.parquet'")).fetchall() if r[5]}
    rows = found.collect()
    assert sorted(row.doc_id for row in rows) == sorted(kept - dirty)
    assert not any(re.search(r"\S+\.\d+@mail\d+\.example\.com", row.text) and row.text in {r.text for r in source.collect()} for row in rows)
