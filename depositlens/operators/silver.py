"""Joined and cleansed customer table.

The lookup joins carry no broadcast hint: Spark broadcasts a lookup table whose size is below
``spark.sql.autoBroadcastJoinThreshold`` and sort-merges a larger one. In the sort-merge join the
customers are the outer side, which adaptive execution may split, so a branch or an employee that holds a
third of the customers is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depositlens.schemas import DISPLAY_NAMES

BRANCH_COLUMNS = ("branch_name", "area", "prefecture")


def drop_missing(df: DataFrame, column: str = "deposit_balance_manyen") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def join_branch(customers: DataFrame, branch: DataFrame) -> DataFrame:
    """Left join: customers of an unknown branch stay, with NULL branch columns."""
    joined = customers.join(branch.select("branch_id", *BRANCH_COLUMNS), "branch_id", "left")
    return joined.select(*customers.columns, *BRANCH_COLUMNS)


def join_employee(customers: DataFrame, employee: DataFrame) -> DataFrame:
    """Left join by employee only; the employee's own branch is left out, it may differ."""
    joined = customers.join(employee.select("employee_id", "employee_name"), "employee_id", "left")
    return joined.select(*customers.columns, "employee_name")


def customers_silver(customers: DataFrame, branch: DataFrame, employee: DataFrame) -> DataFrame:
    """All customer columns, the branch's name, area and prefecture, the employee's name.

    Rows without a deposit balance are dropped before the joins.
    """
    return join_employee(join_branch(drop_missing(customers), branch), employee)


def display_columns(df: DataFrame, names: Mapping[str, str] = DISPLAY_NAMES) -> DataFrame:
    """Japanese headings for the columns that have one; ``SILVER_DISPLAY_NAMES`` covers the joined columns too."""
    return df.withColumnsRenamed(dict(names))


def english_columns(df: DataFrame, names: Mapping[str, str] = DISPLAY_NAMES) -> DataFrame:
    """The way back: column names for the Japanese headings."""
    return df.withColumnsRenamed({shown: name for name, shown in names.items()})
