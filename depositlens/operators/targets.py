"""Who to call: large deposit, no managed assets, no recent contact.

Balances are in units of 10,000 yen, so "ten million yen or more" is ``>= 1000``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depositlens.functions.dates import AsOf, months_back

# The limits the business question names.
HIGH_DEPOSIT_MANYEN = 1000
UNTOUCHED_MONTHS = 6

DEPOSIT = "deposit_balance_manyen"
BRANCH_KEY = ("branch_id", "branch_name")


def is_high_deposit(threshold: int = HIGH_DEPOSIT_MANYEN) -> Column:
    return F.col(DEPOSIT) >= threshold


def is_zero_asset(null_is_zero: bool = False) -> Column:
    """Exactly zero. A missing amount is not zero unless asked for."""
    asset = F.col("managed_asset_manyen")
    return (asset == 0) | asset.isNull() if null_is_zero else asset == 0


def high_deposit(customers: DataFrame, threshold: int = HIGH_DEPOSIT_MANYEN) -> DataFrame:
    return customers.filter(is_high_deposit(threshold))


def zero_asset(customers: DataFrame, null_is_zero: bool = False) -> DataFrame:
    return customers.filter(is_zero_asset(null_is_zero))


# --- contacts -----------------------------------------------------------------------------------------


def recently_contacted(contacts: DataFrame, cutoff: Column, month_column: str | None = None) -> DataFrame:
    """Ids of customers with a contact on or after the cutoff, once each.

    Duplicates go before the shuffle (partial aggregation), so one customer with a third of all contacts
    costs one row per map task. ``month_column`` names the partition column of a table partitioned by the month
    of the contact date: only the months from the cutoff are then read.
    """
    recent = contacts.filter((F.col("contact_date") >= cutoff) & F.col("customer_id").isNotNull())
    if month_column:
        recent = recent.filter(F.col(month_column) >= F.trunc(cutoff, "month"))
    return recent.select("customer_id").distinct()


def untouched(
    customers: DataFrame,
    contacts: DataFrame,
    as_of: AsOf = None,
    months: int = UNTOUCHED_MONTHS,
    month_column: str | None = None,
) -> DataFrame:
    """Customers without a contact in the last months. Those never contacted are untouched too."""
    recent = recently_contacted(contacts, months_back(as_of, months), month_column)
    return customers.join(recent, "customer_id", "left_anti")


def last_contact(contacts: DataFrame) -> DataFrame:
    """Date of the last contact and number of contacts per customer; contacts of nobody are left out."""
    return (
        contacts.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.max("contact_date").alias("last_contact_date"), F.count("*").alias("contact_count"))
    )


def customer_last_contact(customers: DataFrame, contacts: DataFrame) -> DataFrame:
    """Every customer with the last contact, NULL and 0 where there was none."""
    joined = customers.join(last_contact(contacts), "customer_id", "left")
    return joined.withColumn("contact_count", F.coalesce("contact_count", F.lit(0)))


def customer_contacts(customers: DataFrame, contacts: DataFrame) -> DataFrame:
    """Every contact with its customer, by customer id; contacts of nobody are left out.

    An inner join, so that adaptive execution may split the contacts of a customer who holds very many.
    """
    return customers.join(contacts.filter(F.col("customer_id").isNotNull()), "customer_id")


# --- targets ------------------------------------------------------------------------------------------


def target_customers(
    customers: DataFrame,
    contacts: DataFrame,
    as_of: AsOf = None,
    threshold: int = HIGH_DEPOSIT_MANYEN,
    months: int = UNTOUCHED_MONTHS,
    null_is_zero: bool = False,
    month_column: str | None = None,
) -> DataFrame:
    """All three conditions. The two cheap ones come first and shrink the input of the join."""
    candidates = zero_asset(high_deposit(customers, threshold), null_is_zero)
    return untouched(candidates, contacts, as_of, months, month_column)


def target_list(targets: DataFrame) -> DataFrame:
    """Largest deposit first; the id breaks ties."""
    return targets.orderBy(F.desc(DEPOSIT), "customer_id")


def target_follow_up(
    customers: DataFrame,
    contacts: DataFrame,
    as_of: AsOf = None,
    threshold: int = HIGH_DEPOSIT_MANYEN,
    months: int = UNTOUCHED_MONTHS,
    null_is_zero: bool = False,
) -> DataFrame:
    """The target list with each customer's last contact.

    The date of the last contact also tells who is untouched, so contacts are read and shuffled once.
    """
    candidates = zero_asset(high_deposit(customers, threshold), null_is_zero)
    last = F.col("last_contact_date")
    untouched_ones = last.isNull() | (last < months_back(as_of, months))
    return target_list(customer_last_contact(candidates, contacts).filter(untouched_ones))


def target_filter(
    targets: DataFrame,
    prefectures: Sequence[str] = (),
    branch_names: Sequence[str] = (),
    segments: Sequence[str] = (),
) -> DataFrame:
    """Dashboard filters. Values of one filter are alternatives, filters combine, an empty one is off."""
    chosen = {"prefecture": prefectures, "branch_name": branch_names, "segment": segments}
    conditions = [F.col(column).isin(*values) for column, values in chosen.items() if values]
    return targets.filter(reduce(lambda left, right: left & right, conditions)) if conditions else targets


def target_funnel(
    customers: DataFrame,
    contacts: DataFrame,
    as_of: AsOf = None,
    threshold: int = HIGH_DEPOSIT_MANYEN,
    months: int = UNTOUCHED_MONTHS,
) -> DataFrame:
    """Customers left after each condition, one row per stage.

    The stages on the customer table are counted in one pass without a shuffle. Only the last stage needs
    the contacts, and it joins the customers that are left by then.
    """
    high, zero = is_high_deposit(threshold), is_zero_asset()
    targets = target_customers(customers, contacts, as_of, threshold, months)
    counts = customers.agg(
        F.count("*").alias("all_customers"),
        F.count_if(high).alias("high_deposit"),
        F.count_if(high & zero).alias("zero_asset"),
    ).withColumn("untouched", targets.agg(F.count("*")).scalar())
    stages = ["all_customers", "high_deposit", "zero_asset", "untouched"]
    position = F.create_map(*(F.lit(part) for n, name in enumerate(stages, 1) for part in (name, n)))
    return counts.unpivot([], stages, "stage", "customers").select(
        position[F.col("stage")].alias("stage_no"), "stage", "customers"
    )


def target_kpis(targets: DataFrame) -> DataFrame:
    """One row: number of targets and their deposits."""
    return targets.agg(
        F.count("*").alias("target_count"),
        F.coalesce(F.sum(DEPOSIT), F.lit(0)).alias("total_deposit_manyen"),
    )


# --- counts and sums ----------------------------------------------------------------------------------


def customer_count(customers: DataFrame) -> DataFrame:
    return customers.agg(F.count("*").alias("customers"))


def segment_counts(customers: DataFrame) -> DataFrame:
    return customers.groupBy("segment").agg(F.count("*").alias("customers"))


def _by_branch(rows: DataFrame, branch: DataFrame, *columns: Column) -> DataFrame:
    """Aggregates per branch with its name. Aggregated by id before the join: a branch with a third of the rows leaves
    each map task as one row, and only one row per branch meets the branch table. An unknown branch has no name."""
    totals = rows.groupBy("branch_id").agg(*columns)
    named = totals.join(branch.select(*BRANCH_KEY), "branch_id", "left")
    return named.select(*BRANCH_KEY, *(c for c in totals.columns if c != "branch_id"))


def branch_avg_deposit(customers: DataFrame, branch: DataFrame) -> DataFrame:
    """Mean deposit per branch, largest first; summed exactly, divided once."""
    total = F.sum(DEPOSIT).cast("double") / F.count(DEPOSIT)
    means = _by_branch(customers, branch, F.count("*").alias("customers"), total.alias("avg_deposit_manyen"))
    return means.orderBy(F.desc("avg_deposit_manyen"), *BRANCH_KEY)


def count_by_branch(targets: DataFrame, branch: DataFrame) -> DataFrame:
    return _by_branch(targets, branch, F.count("*").alias("targets")).orderBy(F.desc("targets"), *BRANCH_KEY)


def count_by_prefecture(targets: DataFrame, branch: DataFrame) -> DataFrame:
    """Counted per branch first, so one row per branch is joined and counted again."""
    counts = targets.groupBy("branch_id").agg(F.count("*").alias("targets"))
    return (
        counts.join(branch.select("branch_id", "prefecture"), "branch_id", "left")
        .groupBy("prefecture")
        .agg(F.sum("targets").alias("targets"))
        .orderBy(F.desc("targets"), "prefecture")
    )


def deposits_by_branch(targets: DataFrame, branch: DataFrame) -> DataFrame:
    total = F.sum(DEPOSIT).alias("total_deposit_manyen")
    return _by_branch(targets, branch, total).orderBy(F.desc("total_deposit_manyen"), *BRANCH_KEY)


def branch_segment_heatmap(targets: DataFrame, branch: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Targets per branch (rows) and segment (columns).

    One conditional count per segment needs a single aggregation. Segments not asked for, and NULL, are
    counted under ``other_segments`` so that every target is in the map.
    """
    segment = F.coalesce("segment", F.lit(""))
    return _by_branch(
        targets,
        branch,
        *(F.count_if(segment == name).alias(name) for name in segments),
        F.count_if(~segment.isin(*segments)).alias("other_segments"),
    )


def target_breakdown(targets: DataFrame, branch: DataFrame) -> DataFrame:
    """Targets and their deposits by prefecture, branch and segment: small, and open to every dashboard filter.

    Counted per branch and segment before the branch table is joined; an unknown branch has no name.
    """
    totals = targets.groupBy("branch_id", "segment").agg(
        F.count("*").alias("targets"), F.sum(DEPOSIT).alias("total_deposit_manyen")
    )
    named = totals.join(branch.select(*BRANCH_KEY, "prefecture"), "branch_id", "left")
    return named.select("prefecture", *BRANCH_KEY, "segment", "targets", "total_deposit_manyen")


def breakdown_kpis(breakdown: DataFrame) -> DataFrame:
    """The KPIs of a breakdown, whole or filtered by :func:`target_filter`."""
    return breakdown.agg(
        F.coalesce(F.sum("targets"), F.lit(0)).alias("target_count"),
        F.coalesce(F.sum("total_deposit_manyen"), F.lit(0)).alias("total_deposit_manyen"),
    )
