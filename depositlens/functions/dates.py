"""As-of dates and the cutoffs derived from them.

The as-of date is always an argument; ``None`` means today. A literal lets Spark fold the cutoff to a
constant and push the comparison down to the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | str | Column | None


def as_of_date(as_of: AsOf) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date")


def months_back(as_of: AsOf, months: int) -> Column:
    return F.add_months(as_of_date(as_of), -months)


def days_back(as_of: AsOf, days: int) -> Column:
    return F.date_sub(as_of_date(as_of), days)
