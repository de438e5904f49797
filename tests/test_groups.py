import os
import random

import pytest
from pyspark.sql import functions as F

from depositlens.operators import access, groups

NESTING = "member string, `group` string"
MEMBERS = "user string, `group` string"


def closure(spark, pairs):
    found = groups.group_closure(spark.createDataFrame(pairs, NESTING)).collect()
    assert len(found) == len(set(found))
    return {tuple(row) for row in found}


def test_depth_and_repeats(spark):
    chain = [(f"g{n}", f"g{n + 1}") for n in range(12)]
    found = closure(spark, [*chain, *chain[:3], ("g0", "g0"), (None, "g1"), ("g2", None)])
    assert found == {(f"g{n}", f"g{m}") for n in range(13) for m in range(n + 1, 13)}


def test_a_cycle_ends(spark):
    assert closure(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")]) == {
        (low, high) for low in "abc" for high in "abcd" if low != high
    }
    assert closure(spark, []) == set()


def test_a_diamond_counts_once(spark):
    found = closure(spark, [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e")])
    assert found == {("a", g) for g in "bcde"} | {("b", "d"), ("c", "d"), ("b", "e"), ("c", "e"), ("d", "e")}


def rounds(monkeypatch, tmp_path):
    """How far each round of the closure got, as a call that reads what the rounds wrote."""
    monkeypatch.setattr(groups, "fresh_path", lambda spark, name: f"{tmp_path}/{name}")
    return lambda: sorted(int(name.split("-")[-1]) for name in os.listdir(tmp_path / "groups"))


def test_a_round_goes_twice_as_far(spark, monkeypatch, tmp_path):
    reached = rounds(monkeypatch, tmp_path)
    tree = [(f"g{n}", f"g{n // 2}") for n in range(2, 64)]
    chain = [(f"c{n}", f"c{n + 1}") for n in range(40)]
    found = closure(spark, [*tree, *chain])
    assert found == {(f"g{n}", f"g{n >> up}") for n in range(2, 64) for up in range(1, 6) if n >> up} | {
        (f"c{n}", f"c{m}") for n in range(41) for m in range(n + 1, 41)
    }
    assert reached() == [1, 2, 4, 8, 16, 32, 40]


def test_many_ways_to_the_same_groups(spark, monkeypatch, tmp_path):
    reached = rounds(monkeypatch, tmp_path)
    layers = [[f"g{layer}_{n}" for n in range(24)] for layer in range(8)]
    found = closure(spark, [(low, high) for layer in range(7) for low in layers[layer] for high in layers[layer + 1]])
    assert found == {(a, b) for low in range(8) for high in range(low + 1, 8) for a in layers[low] for b in layers[high]}
    assert reached() == [1, 2, 3, 4, 5, 7]  # 24 ways to each pair: at first one step joins more than four rows for each known pair


def test_random_nestings(spark):
    for seed, (size, links) in enumerate([(30, 25), (25, 40), (12, 60)]):
        draw = random.Random(seed)
        pairs = {(f"g{draw.randrange(size)}", f"g{draw.randrange(size)}") for _ in range(links)}
        above = {(low, high) for low, high in pairs if low != high}
        while True:
            more = above | {(low, top) for low, high in above for mid, top in pairs if high == mid}
            if more == above:
                break
            above = more
        assert closure(spark, sorted(pairs)) == {(low, high) for low, high in above if low != high}


def test_few_memberships_leave_the_closure_where_it_is(spark, settings):
    settings({"spark.sql.autoBroadcastJoinThreshold": "20000"})
    number = lambda name, value: F.concat(F.lit(name), value)
    members = spark.range(300_000).select(number("user_", F.col("id") % 3).alias("user"), number("g", F.col("id") % 2 + 900).alias("group"))
    nesting = spark.range(2, 3000).select(number("g", F.col("id")).alias("member"), number("g", F.floor(F.col("id") / 2)).alias("group"))
    found = groups.all_memberships(members, nesting)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {tuple(row) for row in found.collect()} == {(f"user_{u}", f"g{g >> up}") for u in range(3) for g in (900, 901) for up in range(10)}


def test_memberships_through_groups(spark):
    members = spark.createDataFrame([("u", "team"), ("u", "team"), ("v", "club"), ("w", "staff"), (None, "club"), ("x", None)], MEMBERS)
    nesting = spark.createDataFrame([("team", "unit"), ("unit", "staff"), ("club", "staff"), ("staff", "unit")], NESTING)
    found = {tuple(row) for row in groups.all_memberships(members, nesting).collect()}
    assert found == {
        ("u", "team"), ("u", "unit"), ("u", "staff"), ("v", "club"), ("v", "staff"), ("v", "unit"), ("w", "staff"), ("w", "unit"),
        (None, "club"), (None, "staff"), (None, "unit"),
    }


def test_mask_opens_for_members_of_inner_groups(spark):
    members = spark.createDataFrame([("u", "team"), ("v", "club")], MEMBERS)
    nesting = spark.createDataFrame([("team", "unit"), ("unit", "advisers")], NESTING)
    phones = spark.createDataFrame([("090-1234",)], "phone_number string")
    seen = [access.gated_mask(phones, members, user, "advisers", nesting=nesting).first()[0] for user in ("u", "v")]
    assert seen == ["090-1234", "***-****"]
    assert access.gated_mask(phones, members, "u", "advisers").first()[0] == "***-****"


def test_a_group_of_a_third_of_all_members_is_split(spark, small_skew):
    members = spark.range(60_000).select(
        F.concat(F.lit("user_"), "id").alias("user"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 997)).alias("group"),
    )
    nesting = spark.createDataFrame([("hot", "all"), *((f"g{n}", f"h{n % 9}") for n in range(997))], NESTING)
    found = groups.all_memberships(members, nesting)
    assert found.count() == 120_000
    assert found.where("`group` = 'all'").count() == 20_000


@pytest.fixture(scope="module")
def branch(spark):
    rows = [("B1", "a", "north", "east"), ("B2", "b", "south", "east"), ("B3", "c", "north", "west"), ("B4", "d", None, None)]
    return spark.createDataFrame(rows, "branch_id string, branch_name string, area string, prefecture string")


def test_branches_by_area_and_prefecture(spark, branch):
    rows = [("u", "area", "east/north"), ("u", "branch", "B1"), ("v", "prefecture", "east"), ("w", "branch", "B4"), ("w", "area", "nowhere"), ("w", "prefecture", None)]
    grants = spark.createDataFrame(rows, "user string, level string, value string")
    found = groups.granted_branches(grants, branch)
    assert sorted(map(tuple, found.collect())) == [("u", "B1"), ("v", "B1"), ("v", "B2"), ("w", "B4")]
    customers = spark.createDataFrame([(n, f"B{n}") for n in range(1, 5)], "customer_id long, branch_id string")
    assert [row.customer_id for row in access.row_filter(customers, found, "v").orderBy("customer_id").collect()] == [1, 2]
