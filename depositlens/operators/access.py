"""Row-level access and column masking, as DataFrame operators.

The asking user is an argument; ``None`` means the user of the session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depositlens.functions.masking import mask_phone
from depositlens.operators.groups import all_memberships


def _asks(user: str | None) -> Column:
    return F.col("user") == (F.current_user() if user is None else F.lit(user))


def row_filter(df: DataFrame, entitlements: DataFrame, user: str | None = None, key: str = "branch_id") -> DataFrame:
    """Rows of the branches the user may see. Double entitlements do not double rows.

    A semi join straight to the user's entitlement rows. Spark broadcasts them while their estimated size is small: keep a
    long entitlement table partitioned by user, so that the estimate is that user's share. Beyond that both sides are plain
    exchanges by branch, and adaptive execution splits a branch with a third of the rows into as many tasks as its
    size asks for.
    """
    granted = entitlements.filter(_asks(user)).select(key)
    return df.join(granted, key, "left_semi").select(*df.columns)


def is_member(memberships: DataFrame, user: str | None, group: str, nesting: DataFrame | None = None) -> Column:
    """Whether the user belongs to the group, as a one-row subquery: no join, the rows stay where they are.

    With ``nesting`` (member, group) also through groups within the group.
    """
    own = memberships.filter(_asks(user))
    if nesting is not None:
        own = all_memberships(own, nesting)
    return own.filter(F.col("group") == group).agg(F.count("*") > 0).scalar()


def gated_mask(
    df: DataFrame,
    memberships: DataFrame,
    user: str | None,
    group: str,
    column: str = "phone_number",
    nesting: DataFrame | None = None,
) -> DataFrame:
    """The column in clear for members of the group, masked for everyone else."""
    clear = is_member(memberships, user, group, nesting)
    return df.withColumn(column, F.when(clear, F.col(column)).otherwise(mask_phone(F.col(column))))


def governed(
    df: DataFrame,
    entitlements: DataFrame,
    memberships: DataFrame,
    user: str | None,
    group: str,
    column: str = "phone_number",
    nesting: DataFrame | None = None,
) -> DataFrame:
    """What one user sees of ``df``: the rows of the user's branches, ``column`` masked unless the user is in the group.

    ``entitlements`` by area or prefecture go through :func:`depositlens.operators.groups.granted_branches` first.
    """
    return gated_mask(row_filter(df, entitlements, user), memberships, user, group, column, nesting)
