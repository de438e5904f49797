"""Conversation repair, embedding near-copies and ranked search, against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from depositlens.llm import ball_tree, pivot_join, role_glr

TURNS = "conv_id long, turn long, role string, text string"

# --- conversation repair -------------------------------------------------------------------------------


def grammatical(initials):
    return re.fullmatch(r"(s?(ua)+)?", initials) is not None


def cheapest(rows):
    """Of all edits with up to two insertions in a row the least (cost, audit)."""
    found = []
    for letters in itertools.product("DKR", repeat=len(rows)):
        if any(fault == role_glr.BAD and letter != "D" for (_, fault), letter in zip(rows, letters, strict=True)):
            continue
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            audit, cost, kept = "I" * inserts[0], 5 * sum(inserts), ["?"] * inserts[0]
            for (initial, fault), letter, n in zip(rows, letters, inserts[1:], strict=True):
                audit += letter + "I" * n
                cost += {"D": 2, "K": 0, "R": 1}[letter] + 5 * (letter != "D" and fault == role_glr.CUT)
                kept += [initial] * (letter == "K") + ["?"] * (letter == "R") + ["?"] * n
            rest = kept[len(kept) % 2 :]
            lone = len(kept) % 2 == 0 or (kept[0] == "s" and rest)
            if lone and all(held in ("?", "ua"[n % 2]) for n, held in enumerate(rest)):
                found.append((cost, audit))
    return min(found)


def parsed(rows):
    tops, cost, audit = role_glr.opening()
    for initial, fault in rows:
        tops, more, letters = role_glr.step(tops, initial, fault)
        cost, audit = cost + more, audit + letters
    more, letters = role_glr.finish(tops)
    return cost + more, audit + letters


def test_repair_is_the_cheapest_of_all():
    chance = random.Random(5)
    for _ in range(250):
        rows = [(chance.choice(["s", "u", "a", "u", "a", ""]), chance.choice(["", "", "t", "x"])) for _ in range(chance.randint(0, 4))]
        assert parsed(rows) == cheapest(rows), rows


def unpruned(rows):
    """The same by a table of the four ways to end, nothing dropped or settled."""
    ends = {"e": (0, ""), "u": (5, "I"), "p": (10, "II")}
    steps = {("e", "s"): "s", ("e", "u"): "u", ("s", "u"): "u", ("p", "u"): "u", ("u", "a"): "p"}
    for initial, fault in rows:
        new = {}
        extra = 5 * (fault == role_glr.CUT)
        for end, (cost, audit) in ends.items():
            ways = [(end, cost + 2, audit + "D")]
            if fault != role_glr.BAD:
                ways += [(steps.get((end, initial)), cost + extra, audit + "K")]
                ways += [(steps.get((end, role)), cost + 1 + extra, audit + "R") for role in "ua"]
            for reached, *best in ways:
                if reached:
                    new[reached] = min(new.get(reached, tuple(best)), tuple(best))
        for _ in range(2):
            for (end, role), reached in steps.items():
                if role != "s" and end in new:
                    way = (new[end][0] + 5, new[end][1] + "I")
                    new[reached] = min(new.get(reached, way), way)
        ends = new
    return min(ends[end] for end in ("e", "p") if end in ends)


def test_long_conversations_lose_nothing_by_pruning():
    chance = random.Random(6)
    for _ in range(200):
        weights = chance.choice([(1, 4, 4, 1), (6, 1, 1, 6), (1, 9, 1, 0)])
        rows = [(chance.choices(["s", "u", "a", ""], weights)[0], chance.choices(["", "t", "x"], (4, chance.randint(0, 6), chance.randint(0, 6)))[0]) for _ in range(chance.randint(5, 80))]
        assert parsed(rows) == unpruned(rows), rows


def test_rows_leave_the_stack_as_they_are_settled():
    written, held = [], None
    held = role_glr.Conversation(lambda *row: written.append(row))
    longest = 0
    for n in range(3000):
        held.add(n, b"user" if n % 2 == 0 else b"assistant", b"Yes, %d." % n, False, None)
        longest = max(longest, len(held.waiting))
    assert held.close() == (0, "K" * 3000)
    assert len(written) == 3000 and longest <= 4


def conversation_facts(spark, rows):
    found = role_glr.repair(spark.createDataFrame(rows, TURNS)).collect()
    return {row.conv_id: row for row in found}


def test_repair_in_spark(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Good day."),
        (2, 5, "user", "What now?"), (2, 5, "user", "What now?"), (2, 9, "assistant", "cut o"), (2, 7, "tool", "Done."),
        (3, None, None, None), (3, 0, "user", ""),
        (None, 1, "assistant", "Alone."),
        (4, 0, "user", "Long. " + "x" * 200_000 + "!"), (4, 1, "assistant", "Fine."),
    ]
    found = conversation_facts(spark, rows)
    text = "system:Be kind.\nuser:Hello?\nassistant:Good day."
    assert found[1][1:] == (0, 0, 0, 0, 0, 0, "KKK", hashlib.sha256(text.encode()).hexdigest())
    # user, user again (deleted), tool (rerole to assistant), assistant without an end (deleted)
    text = "user:What now?\nassistant:Done."
    assert found[2][1:] == (2, 0, 1, 1, 3, 5, "KDRD", hashlib.sha256(text.encode()).hexdigest())
    assert found[3][1:] == (0, 2, 0, 0, 1, 4, "DD", hashlib.sha256(b"").hexdigest())
    assert found[None][1:] == (0, 0, 0, 0, 0, 2, "D", hashlib.sha256(b"").hexdigest())
    assert found[4].audit == "KK"
    assert conversation_facts(spark, []) == {}


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Is it?"), (1, 1, "user", "Was it?"), (1, 2, "assistant", "It was.")]
    df = spark.createDataFrame(rows, TURNS).withColumn("Edit", F.lit("x")).withColumn("mark", F.lit(1))
    found = [tuple(row) for row in role_glr.repaired_turns(df).orderBy("place").collect()]
    assert [row[2:] for row in found] == [("user", "Was it?", "K", 1), ("assistant", "It was.", "K", 2)]
    assert role_glr.repair(df).first().audit == "DKK"


def test_absent_rows_keep_their_conversation(spark):
    df = spark.createDataFrame([(1, 0, "user", "A."), (2, 0, "user", "B."), (2, 1, "assistant", "C.")], TURNS)
    found = {row.conv_id: row for row in role_glr.repair(df, present=F.col("conv_id") == 2).collect()}
    assert found[1][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and found[2].audit == "KK"


def test_a_conversation_with_most_rows_and_one_text(spark, small_skew):
    rows = [(7, n, "user" if n % 2 == 0 else "assistant", "Same." if n % 3 == 0 else f"Turn {n}.") for n in range(6000)]
    rows += [(n, 0, "user", "Same.") for n in range(100, 160)]
    found = conversation_facts(spark, rows)
    assert found[7].duplicate == 1998  # of the turns with one text the first of each role stays
    seen, expected = set(), []
    for _, _, role, text in rows[:6000]:
        expected.append((role[0], role_glr.BAD if (role, text) in seen else ""))
        seen.add((role, text))
    assert (found[7].cost, found[7].audit) == unpruned(expected)


# --- embedding near-copies -----------------------------------------------------------------------------


def classes_by_hand(rows, threshold):
    """id -> (links, least id reachable) by comparing all with all."""
    usable = []
    for place, (_, vec, label) in enumerate(rows):
        if label is not None and vec and all(v is not None and math.isfinite(v) for v in vec) and any(vec):
            usable.append(place)
    links = {place: set() for place in range(len(rows))}
    for x, y in itertools.combinations(usable, 2):
        a, b = np.array(rows[x][1], float), np.array(rows[y][1], float)
        if rows[x][2] == rows[y][2] and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
            links[x].add(y)
            links[y].add(x)
    found = []
    for place in links:
        seen, open_ = {place}, [place]
        while open_:
            new = links[open_.pop()] - seen
            seen |= new
            open_ += new
        found.append((rows[place][0], len(links[place]), min(rows[n][0] for n in seen)))
    return sorted(found)


def cloud(chance, n, dense):
    """Vectors in eight dimensions: ``dense`` about one direction, the rest about twelve others or anywhere; copies; two labels."""
    centres = chance.normal(size=(12, 8))
    rows = [centres[0] + chance.normal(size=8) * 0.08 for _ in range(dense)]
    rows += [centres[k % 12] + chance.normal(size=8) * 0.3 for k in range(n - dense)]
    rows += [rows[3], rows[3] * 2, rows[-1], chance.normal(size=8)]
    return [(k, [float(v) for v in row], int(k % 7 == 0)) for k, row in enumerate(rows)]


@pytest.mark.parametrize(("cell", "chunk"), [(4096, 4096), (20, 4096), (20, 16)])
def test_links_and_classes_are_exact(spark, monkeypatch, cell, chunk):
    monkeypatch.setattr(pivot_join, "CELL", cell)
    monkeypatch.setattr(pivot_join, "CHUNK", chunk)
    rows = cloud(np.random.default_rng(8), 240, 90)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted(tuple(row)[:3] for row in pivot_join.near_copy_classes(df).collect())
    assert found == classes_by_hand(rows, 0.93)


def test_vectors_that_link_with_nothing(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
        (8, [1.0, None], 1), (9, [float("nan"), 1.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1e200, -0.0], 1), (None, [1.0, 0.0], 1), (2, [2.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("mark", F.lit(0)).withColumn("node", F.lit(0))
    found = sorted((tuple(row) for row in pivot_join.near_copy_classes(df).collect()), key=str)
    linked = [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (11, 4, 1, False), (None, 4, 1, False)]
    alone = [(n, 0, n, True) for n in (3, 4, 5, 6, 7, 8, 9, 10)]
    assert found == sorted(linked + alone, key=str)
    assert pivot_join.near_copy_classes(df.limit(0)).count() == 0


def test_cells_hold_all_that_may_be_linked(spark):
    """Every pair within reach meets in the home cell of either; every vector has one home."""
    rows = cloud(np.random.default_rng(9), 300, 60)
    reach = pivot_join.radius(0.93)
    df = spark.createDataFrame([(n, 1, "l", vec, bytes([n % 256, n // 256])) for n, (_, vec, _) in enumerate(rows)], "node long, weight long, label string, vec array<double>, mark binary")
    pivots = pivot_join.choose_pivots(df, 40 * pivot_join.CELL, reach)
    own = pivots["l", 8]
    assert len(own) > 5 and (pivot_join.distances(own, own) + 10 * np.eye(len(own))).min() > 2 * reach
    dealt = pivot_join.members(df, pivots, reach).collect()
    home = {row.node: row.cell for row in dealt if row.home}
    assert len(home) == sum(row.home for row in dealt) == len(rows)
    inside = {(row.node, row.cell) for row in dealt}
    unit = np.array([vec for _, vec, _ in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    for x, y in np.argwhere(unit @ unit.T >= 0.93):
        assert (x, home[y]) in inside
    assert len(dealt) < len(rows) * len(own) / 2
    cores = {}
    for row in dealt:
        if row.core:
            cores.setdefault(row.cell, []).append(row.vec)
    assert all((np.array(held) @ np.array(held).T >= 0.93).all() for held in cores.values()) and max(map(len, cores.values())) > 40


# --- ranked search -------------------------------------------------------------------------------------


def ranking_by_hand(docs, items, top):
    bags = [(doc, Counter(ball_tree.terms_of((text or "").encode()))) for doc, text in docs]
    sizes = [sum(bag.values()) for _, bag in bags]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(term for _, bag in bags for term in bag)
    found = []
    for item, text in items:
        asked = Counter(ball_tree.terms_of((text or "").encode()))
        scored = []
        for (doc, bag), n in zip(bags, sizes, strict=True):
            m = 100 - 25 + (25 * n * n_docs) // max(total, 1)
            score = sum(times * ball_tree.weight(n_docs, df[term]) * ((10**9 * bag[term]) // (1000 * bag[term] + 12 * m)) for term, times in asked.items() if term in bag)
            if score > 0:
                scored.append((-score, doc))
        found += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(found)


@pytest.fixture(scope="module")
def library():
    chance = random.Random(11)
    word = lambda: "".join(chance.choices("abcdé", k=chance.randint(1, 3)))
    docs = [(n, " ".join(word() for _ in range(chance.randint(0, 80)))) for n in range(180)]
    docs += [(180, None), (181, ""), (182, docs[5][1]), (183, docs[5][1].upper().replace("É", "é")), (184, "ab-" * 3000), (5000, "x_y z")]
    items = [(n, " ".join(word() for _ in range(chance.randint(0, 30)))) for n in range(25)] + [(25, None), (26, "nowhere"), (27, "Z y"), (28, "ab AB ab")]
    return docs, items


@pytest.mark.parametrize(("tree", "leaf", "terms"), [(2048, 32, 1 << 18), (32, 4, 40)])
def test_ranking_is_exact(spark, monkeypatch, library, tree, leaf, terms):
    docs, items = library
    monkeypatch.setattr(ball_tree, "TREE", tree)
    monkeypatch.setattr(ball_tree, "LEAF", leaf)
    monkeypatch.setattr(ball_tree, "QUERY_TERMS", terms)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("n", F.lit(1))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit("a"))
    found = sorted(tuple(row) for row in ball_tree.rank(df, asked, top=7).collect())
    assert found == ranking_by_hand(docs, items, 7)


def test_bounds_hold_and_close_nodes(library):
    docs, items = library
    bags = [Counter(ball_tree.terms_of((text or "").encode())) for _, text in docs]
    rows = [(item, term, n) for item, text in items for term, n in Counter(ball_tree.terms_of((text or "").encode())).items()]
    numbers = {term: n for n, term in enumerate(sorted({term for _, term, _ in rows}))}
    known = [sorted((numbers[term], n) for term, n in bag.items() if term in numbers) for bag in bags]
    lengths = np.array([sum(bag.values()) for bag in bags])
    starts = np.cumsum([0, *map(len, known)])
    flat = np.array([pair for own in known for pair in own])
    queries = ball_tree.Queries(rows, numbers, dict(Counter(flat[:, 0].tolist())), int((lengths > 0).sum()), int(lengths.sum()))
    old, ball_tree.LEAF = ball_tree.LEAF, 4
    try:
        tree = ball_tree.BallTree(queries, lengths, starts, flat[:, 0], flat[:, 1])
    finally:
        ball_tree.LEAF = old
    closed = 0
    for query in range(len(queries.items)):
        weights = np.zeros(queries.size, np.int64)
        weights[queries.terms[query]] = queries.weights[query]
        sums = np.concatenate([[0], np.cumsum(tree.scores * weights[tree.terms])])
        scores = np.diff(sums[tree.starts])
        bounds = tree.bounds(queries, query)
        for (low, high), bound in zip(tree.spans, bounds, strict=True):
            assert scores[low:high].max() <= bound
        closed += (bounds < np.sort(scores)[-7]).sum()
    assert closed > len(tree.spans)


def test_ranking_with_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, "c"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("x", "a"), (None, "a"), ("y", None)], "item_id string, text string")
    found = ball_tree.rank(docs, items).orderBy("rank").collect()
    assert [(row.item_id, row.rank, row.doc_id) for row in found] == [("x", 1, 1), ("x", 2, 1), ("x", 3, None)]
    assert ball_tree.rank(docs.limit(0), items).count() == ball_tree.rank(docs, items.limit(0)).count() == 0
