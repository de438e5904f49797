import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from depositlens import schemas
from depositlens.functions.dates import months_back
from depositlens.operators import silver, targets
from depositlens.sources.adapters import AS_OF, Tables
from tests import data


@pytest.fixture(scope="module")
def customers(spark):
    return silver.customers_silver(data.customers(spark), data.branch(spark), data.employee(spark))


@pytest.fixture(scope="module")
def contacts(spark):
    return data.contacts(spark)


@pytest.fixture(scope="module")
def found(customers, contacts):
    return targets.target_customers(customers, contacts, data.TODAY)


def test_threshold_is_inclusive(customers):
    assert data.ids(targets.high_deposit(customers)) == [2, 3, 4, 5, 7, 8, 9, 10]


def test_missing_asset_is_not_zero_unless_asked(customers):
    assert data.ids(targets.zero_asset(customers)) == [1, 2, 3, 7, 8, 9, 10]
    assert 4 in data.ids(targets.zero_asset(customers, null_is_zero=True))


def test_cutoff_is_six_months_back(spark):
    assert spark.range(1).select(months_back(data.TODAY, 6)).first()[0] == data.CUTOFF


def test_untouched(customers, contacts):
    # 2 on the cutoff day, 9 in the future: touched. 3 the day before, 7 undated, the rest never.
    assert data.ids(targets.untouched(customers, contacts, data.TODAY)) == [1, 3, 4, 5, 7, 8, 10]


def test_targets(found):
    assert data.ids(found) == [3, 7, 8, 10]


def test_anti_join_equals_last_contact_form(customers, contacts):
    last = targets.customer_last_contact(customers, contacts)
    by_date = last.filter(F.col("last_contact_date").isNull() | (F.col("last_contact_date") < data.CUTOFF))
    assert data.ids(by_date) == data.ids(targets.untouched(customers, contacts, data.TODAY))


def test_last_contact(contacts):
    rows = {row.customer_id: row for row in targets.last_contact(contacts).collect()}
    assert sorted(rows) == [2, 3, 7, 9]
    assert (rows[3].last_contact_date, rows[3].contact_count) == (date(2026, 2, 17), 2)
    assert (rows[7].last_contact_date, rows[7].contact_count) == (None, 1)


def test_customer_without_contact_has_zero(customers, contacts):
    row = targets.customer_last_contact(customers, contacts).filter("customer_id = 10").first()
    assert (row.last_contact_date, row.contact_count) == (None, 0)


def test_contacts_with_their_customers(customers, contacts):
    rows = targets.customer_contacts(customers, contacts).select("customer_id", "contact_id").collect()
    assert sorted(map(tuple, rows)) == [(2, 1), (3, 2), (3, 7), (7, 3), (9, 5), (9, 6)]


def test_contacts_of_a_hot_customer_are_split(spark, small_skew):
    keys = spark.range(0, 60_000, 1, 8)
    people = keys.select(F.col("id").alias("customer_id"), F.lit("someone").alias("name"))
    calls = keys.select(
        F.col("id").alias("contact_id"),
        F.when(F.col("id") % 3 != 0, 7).otherwise(F.col("id")).alias("customer_id"),
        F.xxhash64("id").alias("payload"),
    )
    joined = targets.customer_contacts(people, calls)
    assert len(joined.collect()) == 60_000
    assert "skew=true" in data.plan(joined)


def test_random_tables_against_direct_evaluation(spark):
    """All target conditions, evaluated row by row in plain Python."""
    chance = random.Random(11)
    deposits = [None, "999.99", "1000", "1500.5"]
    people = [
        data._customer(key, chance.choice(deposits), chance.choice([None, "0", "0.01"]),
                       branch=chance.choice(["B1", "B2", "B9", None]))
        for key in range(300)
    ]
    dates = [None, date(2026, 2, 17), data.CUTOFF, data.TODAY, date(2020, 1, 1)]
    calls = [
        (n, chance.choice([None, 7, *range(300)]) if n % 3 else 7, chance.choice(dates), "phone", "fund", "open")
        for n in range(400)
    ]  # a third of all contacts belong to customer 7
    touched = {call[1] for call in calls if call[2] is not None and call[2] >= data.CUTOFF}
    expected = sorted(
        person[0]
        for person in people
        if person[4] is not None and person[4] >= 1000 and person[5] == 0 and person[0] not in touched
    )
    found = targets.target_customers(
        silver.customers_silver(
            spark.createDataFrame(people, schemas.CUSTOMERS), data.branch(spark), data.employee(spark)
        ),
        spark.createDataFrame(calls, schemas.CONTACTS),
        data.TODAY,
    )
    assert data.ids(found) == expected and expected


def test_list_order(found):
    assert [row.customer_id for row in targets.target_list(found).collect()] == [10, 7, 8, 3]


def test_follow_up_is_the_list_with_the_last_contact(customers, contacts):
    rows = targets.target_follow_up(customers, contacts, data.TODAY).collect()
    assert [(row.customer_id, row.last_contact_date, row.contact_count) for row in rows] == [
        (10, None, 0),
        (7, None, 1),
        (8, None, 0),
        (3, date(2026, 2, 17), 2),
    ]


def test_filters(found):
    assert data.ids(targets.target_filter(found)) == [3, 7, 8, 10]
    assert data.ids(targets.target_filter(found, segments=["wealthy"])) == [3, 10]
    assert data.ids(targets.target_filter(found, segments=["wealthy", "mass"])) == [3, 7, 10]
    assert data.ids(targets.target_filter(found, ["west"], ["south"], ["wealthy"])) == [3]
    assert data.ids(targets.target_filter(found, branch_names=["nowhere"])) == []


def test_funnel(customers, contacts):
    rows = targets.target_funnel(customers, contacts, data.TODAY).orderBy("stage_no").collect()
    assert [(row.stage, row.customers) for row in rows] == [
        ("all_customers", 9),
        ("high_deposit", 8),
        ("zero_asset", 6),
        ("untouched", 4),
    ]


def test_kpis(found):
    assert tuple(targets.target_kpis(found).first()) == (4, Decimal("8000.01"))
    assert tuple(targets.target_kpis(found.limit(0)).first()) == (0, Decimal("0.00"))


def test_counts_by_branch_keep_the_unknown_branches(spark, found):
    rows = [tuple(row) for row in targets.count_by_branch(found, data.branch(spark)).collect()]
    assert rows == [(None, None, 1), ("B1", "north", 1), ("B2", "south", 1), ("B9", None, 1)]
    assert sum(row[1] for row in targets.count_by_prefecture(found, data.branch(spark)).collect()) == 4


def test_deposits_by_branch_are_exact_and_sorted(spark, found):
    rows = [tuple(row)[1:] for row in targets.deposits_by_branch(found, data.branch(spark)).collect()]
    assert rows[0] == ("north", Decimal("3000.00"))
    assert rows[-1] == ("south", Decimal("1000.01"))


def test_average_by_branch(spark, customers):
    rows = {row.branch_id: row.avg_deposit_manyen for row in targets.branch_avg_deposit(customers, data.branch(spark)).collect()}
    assert rows["B2"] == 1000.01
    assert rows["B1"] == pytest.approx((999.99 + 1000 + 5000 + 5000 + 3000 + 3000) / 6)


def test_heatmap_counts_every_target(spark, found):
    rows = targets.branch_segment_heatmap(found, data.branch(spark), ["wealthy"]).collect()
    assert sum(row.wealthy for row in rows) == 2
    assert sum(row.other_segments for row in rows) == 2  # another segment, and none


def test_hot_customer_leaves_the_map_side_as_one_row(spark, contacts):
    """A third of the contacts belong to one customer: duplicates go before the shuffle."""
    many = spark.range(0, 30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("customer_id"),
        F.lit(data.TODAY).alias("contact_date"),
    )
    recent = targets.recently_contacted(many, F.lit(data.CUTOFF))
    text = data.plan(recent)
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.count("HashAggregate") == 2  # one before, one after the exchange
    assert recent.count() == 20_000  # 1 is among the other ids


def test_invariants_on_whole_tables(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    full = silver.customers_silver(t.customers(), t.branch(), t.employee())
    assert full.count() == t.customers().count() - t.customers().filter("deposit_balance_manyen IS NULL").count()
    found = targets.target_customers(full, t.contacts(), AS_OF)
    stages = [
        row.customers
        for row in targets.target_funnel(full, t.contacts(), AS_OF).orderBy("stage_no").collect()
    ]
    assert stages == sorted(stages, reverse=True)
    by_branch = sum(row.targets for row in targets.count_by_branch(found, data.branch(spark)).collect())
    by_prefecture = sum(row.targets for row in targets.count_by_prefecture(found, data.branch(spark)).collect())
    assert by_branch == by_prefecture == targets.target_list(found).count() == stages[-1]


def test_another_column_called_contact_month_drops_nothing(spark):
    contacts = data.contacts(spark)
    foreign = contacts.withColumn("contact_month", F.lit("1999-01-01").cast("date"))
    cutoff = F.lit(data.CUTOFF)
    assert data.ids(targets.recently_contacted(foreign, cutoff)) == data.ids(targets.recently_contacted(contacts, cutoff))


def test_mean_deposits_are_sorted(spark):
    rows = targets.branch_avg_deposit(data.customers(spark), data.branch(spark)).collect()
    means = [row.avg_deposit_manyen for row in rows if row.avg_deposit_manyen is not None]
    assert len(means) > 1 and means == sorted(means, reverse=True)


def test_customers_of_a_hot_branch_are_not_shuffled_by_branch(spark, small_skew):
    """Partial aggregation lies below the first exchange, so a branch leaves a map task as one row."""
    rows = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") % 3 != 0, "B0").otherwise(F.concat(F.lit("B"), F.col("id") % 100)).alias("branch_id"),
        F.lit("BUILDING").alias("segment"),
        F.lit(1).cast("decimal(15,2)").alias(targets.DEPOSIT),
    )
    branch = spark.range(100).selectExpr("concat('B', id) AS branch_id", "concat('n', id) AS branch_name", "'p' AS prefecture")
    for result in (
        targets.branch_avg_deposit(rows, branch),
        targets.count_by_branch(rows, branch),
        targets.count_by_prefecture(rows, branch),
        targets.deposits_by_branch(rows, branch),
        targets.branch_segment_heatmap(rows, branch, ["BUILDING"]),
    ):
        text = data.plan(result, "simple")
        below = text[text.rindex("Exchange hashpartitioning(branch_id", 0, text.index("Range (")) :]
        assert "partial_" in below.split("Range (")[0]


def test_breakdown_under_every_filter(spark, found):
    breakdown = targets.target_breakdown(found, data.branch(spark))
    assert targets.breakdown_kpis(breakdown).collect() == targets.target_kpis(found).collect()
    segments = [row.segment for row in found.select("segment").distinct().collect() if row.segment]
    for segment in segments:
        part = targets.breakdown_kpis(targets.target_filter(breakdown, segments=[segment]))
        assert part.collect() == targets.target_kpis(targets.target_filter(found, segments=[segment])).collect()
    none = targets.breakdown_kpis(targets.target_filter(breakdown, segments=["nowhere"])).first()
    assert tuple(none) == (0, 0)
