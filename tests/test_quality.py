import pytest
from pyspark.sql import functions as F

from depositlens.operators import quality
from tests import data

ROWS = "id long, name string, amount int"


def diff(spark, before, after, buckets=quality.DIFF_BUCKETS):
    frames = (spark.createDataFrame(rows, ROWS) for rows in (before, after))
    return sorted((tuple(row) for row in quality.row_diff(*frames, "id", buckets=buckets).collect()), key=str)


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_rows_that_went_came_and_changed(spark, buckets):
    before = [(1, "a", 1), (2, "b", None), (3, "c", 3), (3, "c", 3), (4, None, 4), (5, "e", 5), (None, "n", 1), (7, "x", 1), (7, "y", 2)]
    after = [(1, "a", 1), (2, "b", 0), (3, "c", 3), (4, "d", 9), (6, "f", 6), (6, "f", 6), (None, "n", 2), (7, "y", 2), (7, "z", 1)]
    assert diff(spark, before, after, buckets) == sorted(
        [
            (2, "changed", "amount", 1), (3, "removed", None, 1), (4, "changed", "name,amount", 1), (5, "removed", None, 1),
            (6, "added", None, 2), (7, "changed", "name", 1), (None, "changed", "amount", 1),
        ],
        key=str,
    )


def test_several_kinds_of_rows_of_a_key_are_not_paired(spark):
    found = diff(spark, [(1, "a", 1), (1, "b", 1)], [(1, "c", 1), (1, "d", 1), (2, "q", None)])
    assert found == [(1, "added", None, 2), (1, "removed", None, 2), (2, "added", None, 1)]
    assert diff(spark, [(1, "a", 1)] * 3, [(1, "b", 1)] * 2) == [(1, "added", None, 2), (1, "removed", None, 3)]
    assert diff(spark, [(1, "a", 1)] * 3, [(1, "b", 1)] * 3) == [(1, "changed", "name", 3)]


def test_order_and_empty_tables(spark):
    rows = [(n, None if n % 3 else "x", n) for n in range(50)]
    assert diff(spark, rows, rows[::-1]) == diff(spark, [], []) == []
    assert diff(spark, rows[:1], []) == [(0, "removed", None, 1)]
    with pytest.raises(ValueError, match="same columns"):
        quality.row_diff(spark.createDataFrame(rows, ROWS), spark.range(3), "id")


def test_equal_tables_are_read_for_their_sums_only(spark):
    df = data.customers(spark)
    text = data.plan(quality.row_diff(df, df.orderBy(F.rand()), "customer_id"))
    physical = text[text.index("== Physical Plan ==") :]
    assert "LocalTableScan <empty>" in physical or "LocalTableScan" in physical and "to_json" not in physical


def test_a_row_with_a_third_of_a_table_is_counted_before_it_moves(spark):
    hot = spark.range(30_000).select((F.col("id") % 3 * (F.col("id") % 900)).alias("id"), F.lit("x").alias("name"))
    found = quality.row_diff(hot, hot.where("id <> 16").unionByName(hot.where("id = 0").limit(5)), "id").collect()
    assert sorted(tuple(row)[:2] for row in found) == [(0, "added"), (16, "removed")]
    assert "partial_sum" in data.plan(quality.row_diff(hot, hot.where("id <> 16"), "id"))
