from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from depositlens.operators import usage
from depositlens.sources import tables
from tests import data

D = Decimal


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (date(2026, 8, 18), "A", D("1.5"), "SQL", {"cost_center": "x"}),
            (date(2026, 8, 18), "A", D("2"), "SQL", {"cost_center": "y"}),
            (date(2026, 8, 18), "B", D("0.000001"), "JOBS", None),
            (date(2026, 8, 11), "A", D("4"), "JOBS", {"other": "z"}),
            (date(2026, 8, 10), "A", D("8"), "JOBS", {"cost_center": "x"}),
            (date(2026, 8, 18), "unpriced", D("100"), "JOBS", {"cost_center": "x"}),
        ],
        "usage_date date, sku_name string, usage_quantity decimal(18,6), product string, tags map<string,string>",
    )


@pytest.fixture(scope="module")
def prices(spark):
    pairs = [("A", D("0.55")), ("B", D("3.33")), ("idle", D("1"))]
    return spark.createDataFrame(pairs, "sku_name string, price decimal(12,2)")


def test_window_includes_the_seventh_day_back(rows):
    shown = [tuple(row) for row in usage.usage_window(rows, "2026-08-18").collect()]
    assert shown == [
        (date(2026, 8, 18), "unpriced", D("100.000000")),
        (date(2026, 8, 18), "A", D("3.500000")),
        (date(2026, 8, 18), "B", D("0.000001")),
        (date(2026, 8, 11), "A", D("4.000000")),
    ]


def test_window_prunes_a_table_partitioned_by_day(spark, database, rows):
    tables.save_table(rows, database, "usage", partition_by="usage_date")
    text = data.plan(usage.usage_window(tables.load_table(spark, database, "usage"), "2026-08-18"), "formatted")
    assert "PartitionFilters: [isnotnull(usage_date" in text and "2026-08-11" in text


def test_window_ends_today_by_default(spark):
    rows = spark.range(12).select(
        F.date_sub(F.current_date(), F.col("id").cast("int")).alias("usage_date"),
        F.lit("A").alias("sku_name"),
        F.lit(D("1")).alias("usage_quantity"),
    )
    assert usage.usage_window(rows).count() == 8


def test_cost_is_exact_and_keeps_unpriced(rows, prices):
    shown = {row.sku_name: row.cost for row in usage.usage_cost(rows, prices).collect()}
    assert shown == {"A": D("8.525"), "B": D("0.00000333"), "unpriced": None}


def test_cost_by_tag(rows, prices):
    found = usage.cost_by_tag(rows, prices, "cost_center").collect()
    assert {row.cost_center: row.cost for row in found} == {"x": D("5.225"), "y": D("1.1"), "untagged": D("2.20000333")}
    assert {row.cost_center: row.unpriced_dbus for row in found} == {"x": D("100"), "y": D("0"), "untagged": D("0")}
    assert sum(row.total_dbus for row in found) == D("115.500001")  # what went in


def test_one_price_of_several_needs_a_rule(spark, rows):
    listed = spark.createDataFrame([("A", D("2")), ("A", D("1")), ("B", D("5"))], "sku_name string, price decimal(12,2)")
    assert {tuple(row) for row in usage.one_price(listed, "highest").collect()} == {("A", D("2.00")), ("B", D("5.00"))}
    assert {tuple(row) for row in usage.one_price(listed, "lowest").collect()} == {("A", D("1.00")), ("B", D("5.00"))}
    with pytest.raises(Exception, match="several prices for A"):
        usage.usage_cost(rows, listed).collect()
    with pytest.raises(ValueError, match="highest, lowest"):
        usage.one_price(listed, "dearest")


@pytest.fixture(scope="module")
def periods(spark):
    day = lambda n: date(2026, 8, n)
    return spark.createDataFrame(
        [
            ("A", D("1"), day(5), day(8)),  # then a gap
            ("A", D("2"), day(10), None),  # ended by the next
            ("A", D("3"), day(15), None),
            ("B", D("7"), None, day(10)),
            ("B", D("8"), day(12), day(20)),
            ("B", D("9"), day(12), day(13)),  # begins on the same day
            (None, D("4"), day(1), None),
        ],
        "sku_name string, price decimal(12,2), since date, until date",
    )


def test_price_of_the_day(spark, periods):
    days = spark.createDataFrame(
        [(sku, date(2026, 8, n)) for sku in ("A", "B", "C", None) for n in range(1, 22)] + [("A", date(2026, 8, 6)), ("A", None)],
        "sku_name string, usage_date date",
    )
    found = usage.price_on_days(days, periods, "since", "until", "lowest").collect()
    prices = {(row.sku_name, row.usage_date and row.usage_date.day): row.price for row in found}
    assert len(found) == len(prices) == 4 * 21 + 1
    assert [prices["A", n] for n in range(1, 22)] == [None] * 4 + [1] * 3 + [None] * 2 + [2] * 5 + [3] * 7
    assert [prices["B", n] for n in range(1, 22)] == [7] * 9 + [None] * 2 + [8] * 8 + [None] * 2
    assert all(prices[sku, n] is None for sku in ("C", None) for n in range(1, 22)) and prices["A", None] is None
    highest = {row.usage_date.day: row.price for row in usage.price_on_days(days, periods, "since", "until", "highest").where("sku_name = 'B'").collect()}
    assert (highest[12], highest[13]) == (9, None)
    with pytest.raises(Exception, match="several prices for B"):
        usage.price_on_days(days, periods, "since", "until").collect()


def test_cost_at_the_price_of_the_day(rows, periods):
    found = {row.sku_name: tuple(row)[1:] for row in usage.usage_cost_by_period(rows, periods, "since", "until", "highest").collect()}
    assert found["A"] == (D("15.5"), D("0"), D("34.5"))  # 8 + 4 at 2, 3.5 at 3
    assert found["B"] == (D("0.000001"), D("0.000001"), None)
    tags = {row.cost_center: row.cost for row in usage.cost_by_tag(rows, periods, "cost_center", "highest", "since", "until").collect()}
    assert tags == {"x": D("20.5"), "y": D("6"), "untagged": D("8")}


def test_one_period_for_all_time_changes_no_total(rows, prices):
    always = prices.withColumn("since", F.lit(None).cast("date"))
    for plain, dated in (
        (usage.cost_by_tag(rows, prices, "cost_center"), usage.cost_by_tag(rows, always, "cost_center", valid_from="since")),
        (usage.cost_by_product(rows, prices), usage.cost_by_product(rows, always, valid_from="since")),
        (usage.usage_cost(rows, prices), usage.usage_cost_by_period(rows, always, "since").drop("unpriced_dbus")),
    ):
        assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, dated.collect()), key=str)


def test_a_hot_product_is_a_row_a_day_before_prices_are_looked_up(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("S"), F.col("id") % 500)).alias("sku_name"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 60).cast("int")).alias("usage_date"),
        F.lit(D("1")).alias("usage_quantity"),
    )
    listed = spark.createDataFrame([("hot", D("2"), date(2026, 1, 31))], "sku_name string, price decimal(12,2), since date")
    found = usage.usage_cost_by_period(hot, listed, "since").where("sku_name = 'hot'").first()
    assert (found.total_dbus, found.unpriced_dbus, found.cost) == (10_000, 5_000, 10_000)
    text = data.plan(usage.usage_cost_by_period(hot, listed, "since"))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and text.count("partial_sum") >= 2


def test_usage_by_product(rows):
    shown = {row["product"]: row.total_dbus for row in usage.usage_by_product(rows).collect()}
    assert shown == {"SQL": D("3.5"), "JOBS": D("112.000001")}


def test_run_status(spark):
    start = datetime(2026, 8, 18, 7, 0, 0)
    runs = spark.createDataFrame(
        [
            (1, "prepare", "SUCCESS", start, datetime(2026, 8, 18, 7, 0, 1, 500000)),
            (2, "prepare", "SUCCESS", datetime(2026, 8, 19, 7, 0, 0), datetime(2026, 8, 19, 7, 0, 0, 500000)),
            (3, "prepare", "FAILED", start, None),
        ],
        "run_id long, task string, status string, started timestamp, ended timestamp",
    )
    shown = {row.status: row for row in usage.run_status(runs).collect()}
    assert (shown["SUCCESS"].runs, shown["SUCCESS"].avg_seconds) == (2, 1.0)
    assert shown["SUCCESS"].first_start == start
    assert (shown["FAILED"].runs, shown["FAILED"].avg_seconds, shown["FAILED"].last_end) == (1, None, None)


def test_audit_summary(spark):
    audit = spark.createDataFrame(
        [(datetime(2026, 8, day, hour), "u", "read") for day, hour in ((18, 1), (18, 23), (19, 0))],
        "ts timestamp, actor string, action string",
    )
    shown = sorted(tuple(row) for row in usage.audit_summary(audit).collect())
    assert shown == [(date(2026, 8, 18), "u", "read", 2), (date(2026, 8, 19), "u", "read", 1)]
