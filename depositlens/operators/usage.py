"""Resource usage, cost, job runs and the audit log.

Every query aggregates before it joins, so a product that holds a third of all usage rows leaves each map
task as a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depositlens.functions.dates import AsOf, days_back

# The reporting window and the label for usage without a tag.
USAGE_WINDOW_DAYS = 7
UNTAGGED = "untagged"
PICKS = ("highest", "lowest")

# Wide enough for any total, narrow enough that total * price keeps all decimals.
_TOTAL = "decimal(24,6)"


def usage_window(usage: DataFrame, as_of: AsOf = None, days: int = USAGE_WINDOW_DAYS) -> DataFrame:
    """Usage per day and product since ``days`` days before the as-of date, that day included."""
    return (
        usage.filter(F.col("usage_date") >= days_back(as_of, days))
        .groupBy("usage_date", "sku_name")
        .agg(F.sum("usage_quantity").alias("total_dbus"))
        .orderBy(F.desc("usage_date"), F.desc("total_dbus"), "sku_name")
    )


def one_price(prices: DataFrame, pick: str | None = None) -> DataFrame:
    """One list price per product, for all time. ``pick`` is the rule for a product with several.

    ``highest`` or ``lowest``; without a rule a product with several prices is an error when the query runs.
    """
    return prices.groupBy("sku_name").agg(_picked(pick, F.col("price"), F.col("sku_name")).alias("price"))


def _picked(pick: str | None, value: Column, product: Column) -> Column:
    """An aggregate: the value of one row, or of several by the rule."""
    if pick in PICKS:
        return F.max(value) if pick == "highest" else F.min(value)
    if pick is not None:
        raise ValueError(f"pick is one of {', '.join(PICKS)}")
    several = F.raise_error(F.concat(F.lit("several prices for "), F.coalesce(F.first(product), F.lit("NULL")), F.lit(", and no rule to pick one")))
    return F.when(F.count(F.lit(1)) > 1, several.cast("void")).otherwise(F.max(value))


def price_on_days(
    days: DataFrame, prices: DataFrame, valid_from: str, valid_to: str | None = None, pick: str | None = None
) -> DataFrame:
    """``price`` of each (sku_name, usage_date) of ``days``: that of the latest period begun by then; NULL if it has ended or none has begun.

    A period without a start has begun with the first day; one without an end, or no column for it, lasts until the next begins. Of
    periods of a product that begin on one day ``pick`` chooses as in :func:`one_price`, by price.

    An as-of join as one running value: the starts are laid among the days and each day takes the last one before it, so no day
    meets more than one period. ``days`` has a row per product and day, so a product with a third of all usage is some thousand rows here.
    """
    ends = F.col(valid_to).cast("date") if valid_to else F.lit(None).cast("date")
    starts = prices.where("sku_name IS NOT NULL").select(
        "sku_name",
        F.coalesce(F.col(valid_from).cast("date"), F.lit("0001-01-01").cast("date")).alias("usage_date"),
        F.struct("price", ends.alias("until")).alias("period"),
    )
    periods = starts.groupBy("sku_name", "usage_date").agg(_picked(pick, F.col("period"), F.col("sku_name")).alias("period"))
    laid = days.select("sku_name", "usage_date").distinct().withColumn("begins", F.lit(False)).unionByName(
        periods.withColumn("begins", F.lit(True)), allowMissingColumns=True
    )
    so_far = Window.partitionBy("sku_name").orderBy("usage_date", F.desc("begins")).rowsBetween(Window.unboundedPreceding, 0)
    valid = F.col("period.until").isNull() | (F.col("usage_date") < F.col("period.until"))
    return (
        laid.withColumn("period", F.last("period", ignorenulls=True).over(so_far))
        .where(~F.col("begins"))
        .select("sku_name", "usage_date", F.when(valid, F.col("period.price")).alias("price"))
    )


def usage_cost(usage: DataFrame, prices: DataFrame, pick: str | None = None) -> DataFrame:
    """Usage times list price per product; products without a price stay, with NULL cost."""
    totals = usage.groupBy("sku_name").agg(F.sum("usage_quantity").cast(_TOTAL).alias("total_dbus"))
    return totals.join(one_price(prices, pick), "sku_name", "left").select(
        "sku_name", "total_dbus", (F.col("total_dbus") * F.col("price")).alias("cost")
    )


def usage_cost_by_period(
    usage: DataFrame, prices: DataFrame, valid_from: str, valid_to: str | None = None, pick: str | None = None
) -> DataFrame:
    """The same with the price of the day of use, and ``unpriced_dbus``: usage on days without a price."""
    return _cost_by(usage, prices, "sku_name", pick, valid_from, valid_to)


def usage_by_product(usage: DataFrame) -> DataFrame:
    return usage.groupBy("product").agg(F.sum("usage_quantity").alias("total_dbus"))


def cost_by_tag(
    usage: DataFrame,
    prices: DataFrame,
    tag: str,
    pick: str | None = None,
    valid_from: str | None = None,
    valid_to: str | None = None,
) -> DataFrame:
    """Cost per value of a tag; usage without the tag is gathered under one label.

    Usage without a price counts in the total and, by itself, as ``unpriced_dbus``. With a column ``valid_from`` the price is that of the
    day of use, as in :func:`price_on_days`, else the product's one price.
    """
    label = F.coalesce(F.element_at("tags", tag), F.lit(UNTAGGED))
    labelled = usage.select(label.alias(tag), "sku_name", "usage_date", "usage_quantity")
    return _cost_by(labelled, prices, tag, pick, valid_from, valid_to)


def cost_by_product(
    usage: DataFrame,
    prices: DataFrame,
    pick: str | None = None,
    valid_from: str | None = None,
    valid_to: str | None = None,
) -> DataFrame:
    """Usage and cost per kind of product; prices and usage without a price as in :func:`cost_by_tag`."""
    return _cost_by(usage, prices, "product", pick, valid_from, valid_to)


def _cost_by(
    usage: DataFrame, prices: DataFrame, label: str, pick: str | None, valid_from: str | None, valid_to: str | None
) -> DataFrame:
    keys = ["sku_name", "usage_date"] if valid_from else ["sku_name"]
    totals = usage.groupBy(*dict.fromkeys([*keys, label])).agg(F.sum("usage_quantity").cast(_TOTAL).alias("total_dbus"))
    priced = price_on_days(totals, prices, valid_from, valid_to, pick) if valid_from else one_price(prices, pick)
    unpriced = F.when(F.col("price").isNull(), F.col("total_dbus"))
    return totals.join(priced, keys, "left").groupBy(label).agg(
        F.sum("total_dbus").cast(_TOTAL).alias("total_dbus"),
        F.coalesce(F.sum(unpriced), F.lit(0)).cast(_TOTAL).alias("unpriced_dbus"),
        F.sum(F.col("total_dbus") * F.col("price")).alias("cost"),
    )


def run_status(runs: DataFrame) -> DataFrame:
    """Runs per task and status: how many, how long, first start, last end."""
    micros = F.timestamp_diff("MICROSECOND", F.col("started"), F.col("ended"))
    return runs.groupBy("task", "status").agg(
        F.count("*").alias("runs"),
        (F.sum(micros) / F.count(micros) / 1_000_000).alias("avg_seconds"),
        F.min("started").alias("first_start"),
        F.max("ended").alias("last_end"),
    )


def audit_summary(audit: DataFrame) -> DataFrame:
    """Actions per day, actor and kind."""
    return audit.groupBy(F.to_date("ts").alias("day"), "actor", "action").agg(F.count("*").alias("actions"))
