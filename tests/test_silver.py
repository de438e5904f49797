import pytest
from pyspark.sql import functions as F

from depositlens import schemas
from depositlens.operators import quality, silver
from tests import data


@pytest.fixture(scope="module")
def tables(spark):
    return data.customers(spark), data.branch(spark), data.employee(spark)


def test_silver_keeps_unmatched_rows_and_drops_missing_deposits(tables):
    rows = {row.customer_id: row for row in silver.customers_silver(*tables).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert (rows[1].branch_name, rows[1].employee_name) == ("north", "Sato")
    assert rows[1].branch_id == "B1"  # the customer's branch, not the employee's
    assert rows[3].employee_name is None and rows[3].prefecture == "west"
    assert rows[7].branch_name is None and rows[7].branch_id == "B9"
    assert rows[8].branch_name is None and rows[8].employee_name is None


def test_silver_columns(tables):
    assert silver.customers_silver(*tables).columns == [
        *schemas.CUSTOMERS.names,
        "branch_name",
        "area",
        "prefecture",
        "employee_name",
    ]


def test_silver_equals_its_sql_form(spark, tables):
    for name, df in zip(("customers", "branch", "employee"), tables, strict=True):
        df.createOrReplaceTempView(name)
    by_sql = spark.sql(
        """SELECT c.*, b.branch_name, b.area, b.prefecture, e.employee_name
           FROM customers c LEFT JOIN branch b ON c.branch_id = b.branch_id
                            LEFT JOIN employee e ON c.employee_id = e.employee_id
           WHERE c.deposit_balance_manyen IS NOT NULL"""
    )
    by_frame = silver.customers_silver(*tables)
    assert by_frame.exceptAll(by_sql).isEmpty() and by_sql.exceptAll(by_frame).isEmpty()
    for name in ("customers", "branch", "employee"):
        spark.catalog.dropTempView(name)


def test_display_columns(tables):
    full = silver.customers_silver(*tables)
    shown = silver.display_columns(full)
    assert shown.columns[0] == "顧客ID" and {"預金残高(万円)", "branch_name"} <= set(shown.columns)
    assert silver.english_columns(shown).columns == full.columns


def test_row_reconcile(tables):
    row = quality.row_reconcile(tables[0], silver.customers_silver(*tables)).first()
    assert tuple(row) == (10, 9, 1)


def test_null_profile(tables):
    rows = {row.column_name: row for row in quality.null_profile(tables[0]).collect()}
    assert list(rows) == schemas.CUSTOMERS.names
    assert rows["deposit_balance_manyen"].null_count == 1
    assert rows["deposit_balance_manyen"].data_type == "decimal(15,2)"
    assert rows["branch_id"].null_count == 1 and rows["name"].null_count == 0
    assert {row.row_count for row in rows.values()} == {10}


def test_null_profile_of_display_names(tables):
    shown = silver.display_columns(tables[0]).withColumnRenamed("phone_number", "phone.number")
    rows = {row.column_name: row.null_count for row in quality.null_profile(shown).collect()}
    assert rows["預金残高(万円)"] == 1 and rows["phone.number"] == 1


def test_null_profile_of_an_empty_table(tables):
    rows = quality.null_profile(tables[0].limit(0)).collect()
    assert {(row.null_count, row.row_count) for row in rows} == {(0, 0)}


def test_preview_is_the_first_rows_of_a_total_order(tables):
    shown = quality.preview(tables[0].orderBy(F.desc("customer_id")), "customer_id", rows=3)
    assert [row.customer_id for row in shown.collect()] == [1, 2, 3]


@pytest.mark.parametrize("hot", ["E1", None])
def test_hot_employee_is_split(spark, small_skew, hot):
    """Without a broadcast, the task of an employee (or none) with most customers is split at run time."""
    keys = spark.range(0, 60_000, 1, 8)
    facts = keys.select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") % 3 != 0, F.lit(hot).cast("string"))
        .otherwise(F.col("id").cast("string"))
        .alias("employee_id"),
        F.xxhash64("id").alias("payload"),
    )
    staff = keys.select(
        F.when(F.col("id") == 1, "E1").otherwise(F.col("id").cast("string")).alias("employee_id"),
        F.lit("someone").alias("employee_name"),
    )
    joined = silver.join_employee(facts, staff)
    rows = joined.collect()
    assert len(rows) == 60_000
    assert all((row.employee_name == "someone") == (row.employee_id is not None) for row in rows)
    assert "skew=true" in data.plan(joined)


def test_display_names_of_joined_columns(tables):
    full = silver.customers_silver(*tables)
    shown = silver.display_columns(full, schemas.SILVER_DISPLAY_NAMES)
    assert {"店舗名", "都道府県", "担当者名", "電話番号"} <= set(shown.columns)
    assert silver.english_columns(shown, schemas.SILVER_DISPLAY_NAMES).columns == full.columns
