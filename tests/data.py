"""Small hand-made frames with the edge cases of each operator."""

import contextlib
import io
from datetime import date
from decimal import Decimal

from depositlens import schemas

D = Decimal
TODAY = date(2026, 8, 18)
CUTOFF = date(2026, 2, 18)


def _customer(key, deposit, asset, segment="wealthy", branch="B1", employee="E1", phone="090-1234-5678"):
    return (
        key, f"name {key}", 40, segment,
        None if deposit is None else D(deposit), None if asset is None else D(asset),
        date(1986, 1, 1), branch, employee, phone,
    )


CUSTOMER_ROWS = [
    _customer(1, "999.99", "0"),
    _customer(2, "1000", "0"),
    _customer(3, "1000.01", "0", branch="B2", employee="E9"),
    _customer(4, "5000", None),
    _customer(5, "5000", "0.01"),
    _customer(6, None, "0"),
    _customer(7, "2000", "0", segment="mass", branch="B9"),
    _customer(8, "2000", "0", segment=None, branch=None, employee=None),
    _customer(9, "3000", "0", phone=None),
    _customer(10, "3000", "0", phone="none"),
]

BRANCH_ROWS = [("B1", "north", "area 1", "east"), ("B2", "south", "area 1", "west")]
EMPLOYEE_ROWS = [("E1", "Sato", "B2", "sales"), ("E2", "Sato", "B1", "head")]

CONTACT_ROWS = [
    (1, 2, CUTOFF, "phone", "fund", "declined"),
    (2, 3, date(2026, 2, 17), "phone", "fund", "declined"),
    (3, 7, None, "visit", "fund", "open"),
    (4, None, TODAY, "visit", "fund", "open"),
    (5, 9, date(2027, 1, 1), "visit", "bond", "open"),
    (6, 9, date(2020, 1, 1), "visit", "bond", "open"),
    (7, 3, date(2025, 5, 5), "phone", "bond", "open"),
]


def customers(spark):
    return spark.createDataFrame(CUSTOMER_ROWS, schemas.CUSTOMERS)


def branch(spark):
    return spark.createDataFrame(BRANCH_ROWS, schemas.BRANCH)


def employee(spark):
    return spark.createDataFrame(EMPLOYEE_ROWS, schemas.EMPLOYEE)


def contacts(spark):
    return spark.createDataFrame(CONTACT_ROWS, schemas.CONTACTS)


def plan(df, mode="extended"):
    """The plans as text; ``formatted`` gives the physical plan with untruncated scan details."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def ids(df, column="customer_id"):
    return sorted(row[column] for row in df.select(column).collect())
