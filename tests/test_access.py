from collections import Counter

import pytest
from pyspark.sql import functions as F

from depositlens.operators import access
from depositlens.sources import tables
from tests import data


@pytest.fixture(scope="module")
def entitlements(spark):
    rows = [("anna", "B1"), ("anna", "B1"), ("anna", "B2"), ("ben", "B2"), ("carl", "B9"), ("dora", None)]
    return spark.createDataFrame(rows, "user string, branch_id string")


@pytest.mark.parametrize(
    ("user", "seen"), [("anna", [1, 2, 3, 4, 5, 6, 9, 10]), ("ben", [3]), ("carl", [7]), ("dora", []), ("eve", [])]
)
def test_row_filter(spark, entitlements, user, seen):
    # carl's branch is known to the entitlements only, dora's entitlement names no branch
    rows = access.row_filter(data.customers(spark), entitlements, user)
    assert data.ids(rows) == seen
    assert rows.columns == data.customers(spark).columns


def test_hot_branch_is_spread(spark, small_skew):
    """Without a broadcast, the rows of a branch with two thirds of all customers reach many tasks."""
    rows = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") % 3 != 0, "B0").otherwise(F.concat(F.lit("B"), F.col("id") % 100)).alias("branch_id"),
        F.xxhash64("id").alias("payload"),
    )
    rights = spark.createDataFrame([("anna", "B0"), ("anna", "B0"), ("anna", "B3")], "user string, branch_id string")
    seen = access.row_filter(rows, rights, "anna").withColumn("task", F.spark_partition_id())
    found = seen.collect()
    assert len(found) == rows.filter("branch_id IN ('B0', 'B3')").count()
    hot = Counter(row.task for row in found if row.branch_id == "B0")
    assert len(hot) >= 4 and max(hot.values()) < 30_000
    assert "skew=true" in data.plan(seen)


def test_rights_partitioned_by_user_are_broadcast_however_many_users(spark, database, settings):
    customers = spark.range(20_000).selectExpr("id AS customer_id", "id % 9 AS branch_id")
    rights = spark.range(700).selectExpr("concat('user', id % 40) AS user", "id % 7 AS branch_id")
    tables.save_table(customers, database, "customers")
    tables.save_table(rights, database, "rights", partition_by="user")
    settings({"spark.sql.autoBroadcastJoinThreshold": "5000"})
    customers, rights = (tables.load_table(spark, database, name) for name in ("customers", "rights"))
    text = data.plan(access.row_filter(customers, rights, "user3"), "simple")
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_session_user_is_the_default(spark, entitlements):
    me = spark.sql("SELECT current_user()").first()[0]
    mine = entitlements.union(spark.createDataFrame([(me, "B2")], entitlements.schema))
    assert data.ids(access.row_filter(data.customers(spark), mine)) == [3]


def test_gated_mask(spark):
    pairs = [("anna", "advisers"), ("anna", "advisers"), ("ben", "other")]
    members = spark.createDataFrame(pairs, "user string, group string")
    customers = data.customers(spark)
    clear = access.gated_mask(customers, members, "anna", "advisers")
    assert clear.exceptAll(customers).isEmpty() and customers.exceptAll(clear).isEmpty()
    hidden = access.gated_mask(customers, members, "ben", "advisers")
    masked = {row.customer_id: row.phone_number for row in hidden.collect()}
    assert masked[1] == "***-****-****" and masked[9] is None and masked[10] == "none"


def test_governed_rows_and_phones(spark):
    customers = spark.createDataFrame(
        [(1, "b1", "03-1"), (2, "b2", "03-2"), (3, None, "03-3")], "customer_id long, branch_id string, phone_number string"
    )
    rights = spark.createDataFrame([("ann", "b1"), ("ann", "b1"), ("bob", "b2")], "user string, branch_id string")
    members = spark.createDataFrame([("bob", "advisers")], "user string, group string")
    seen = {
        user: [tuple(row) for row in access.governed(customers, rights, members, user, "advisers").collect()]
        for user in ("ann", "bob", "eve")
    }
    assert seen == {"ann": [(1, "b1", "**-*")], "bob": [(2, "b2", "03-2")], "eve": []}
