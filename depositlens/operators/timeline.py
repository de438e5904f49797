"""Runs over time: how many at once, how long busy, how the last attempt ended.

The number of runs at a moment is a running sum of starts and ends. It is taken on three levels, minutes within a day, days, and moments
within a minute, so no task gets the timeline of a key whole; a day with a third of all runs is 1440 groups. A minute gets what was
running before it as one more row, so nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Microseconds of the slices.
MINUTE, DAY, SECOND = 60_000_000, 86_400_000_000, 1_000_000
SUCCESS = "SUCCESS"

_EXACT = "decimal(38,0)"


def level_changes(runs: DataFrame, *keys: str, started: str = "started", ended: str = "ended") -> DataFrame:
    """(key, moment, micros, before, after, begun, run_micros): a row for each moment at which runs of the key start or end.

    ``before`` and ``after`` are how many run; a run is there from its start until right before its end. ``begun`` runs start at the moment,
    ``run_micros`` is how long they take in all. Runs without a start, without an end, or that do not end after they start are left out.
    A missing key is a key of its own; without ``keys`` all runs are taken together.
    """
    begin, end = F.col(f"`{started}`"), F.col(f"`{ended}`")
    key = F.struct(*(F.col(f"`{name}`") for name in keys)) if keys else F.struct(F.lit(True).alias("all"))
    step = lambda moment, delta, begun, micros: F.struct(
        moment.alias("moment"), F.lit(delta).cast("long").alias("delta"), F.lit(begun).cast("long").alias("begun"), micros.alias("run_micros")
    )
    length = F.timestamp_diff("MICROSECOND", begin, end)
    steps = F.array(step(begin, 1, 1, length), step(end, -1, 0, F.lit(0).cast("long")))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros_of = lambda moment: F.timestamp_diff("MICROSECOND", epoch, moment)
    slice_of = lambda width: F.col("micros") - F.pmod("micros", F.lit(width))
    changed = (
        runs.where(begin < end)
        .select(key.alias("key"), F.explode(steps).alias("step"))
        .select("key", "step.*", micros_of(F.col("step.moment")).alias("micros"))
        .withColumns({"minute": slice_of(MINUTE), "day": slice_of(DAY)})
    )
    moments = changed.groupBy("key", "moment", "micros", "minute").agg(
        F.sum("delta").alias("delta"), F.sum("begun").alias("begun"), F.sum("run_micros").alias("run_micros")
    )
    # Minutes straight from the runs: each task sends one row per key and minute, read twice from one exchange.
    minutes = changed.groupBy("key", "day", "minute").agg(F.sum("delta").alias("delta"))
    days = minutes.groupBy("key", "day").agg(F.sum("delta").alias("delta"))
    none = F.lit(None).cast("long")
    into_day = days.select("key", "day", none.alias("minute"), _sum_before("day", "key").alias("delta"))
    into_minute = minutes.unionByName(into_day).withColumn("delta", _sum_before("minute", "key", "day")).where("minute IS NOT NULL")
    running = Window.partitionBy("key", "minute").orderBy(F.col("micros").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    return (
        moments.unionByName(into_minute.drop("day"), allowMissingColumns=True)
        .withColumn("after", F.sum("delta").over(running))
        .where("micros IS NOT NULL")
        .select("key", "moment", "micros", (F.col("after") - F.col("delta")).alias("before"), "after", "begun", "run_micros")
    )


def _sum_before(column: str, *by: str) -> Column:
    """The sum of ``delta`` in all rows ahead by ``column``, a missing value first."""
    ahead = Window.partitionBy(*by).orderBy(F.col(column).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("delta").over(ahead), F.lit(0))


def _named(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return df.select("key.*", *(name for name in df.columns if name != "key")) if keys else df.drop("key")


def run_overlap(runs: DataFrame, *keys: str, started: str = "started", ended: str = "ended") -> DataFrame:
    """Per key: timed runs, their seconds in all, seconds with any of them running, the most at once and when that first began.

    Runs count as in :func:`level_changes`. Busy time is the sum of the moments at which the last one ends less those at which a first one
    starts, so no moment has to know the next.
    """
    at = F.col("micros").cast(_EXACT)
    begins, ends = (F.col("before") == 0) & (F.col("after") > 0), (F.col("before") > 0) & (F.col("after") == 0)
    changes = level_changes(runs, *keys, started=started, ended=ended)
    peak = F.min(F.struct((-F.col("after")).alias("level"), "moment"))
    totals = changes.groupBy("key").agg(
        F.sum("begun").alias("timed_runs"),
        (F.sum("run_micros") / SECOND).alias("run_seconds"),
        (F.sum(F.when(ends, at).when(begins, -at).otherwise(0)).cast("long") / SECOND).alias("busy_seconds"),
        peak.alias("peak"),
    )
    return _named(
        totals.select("key", "timed_runs", "run_seconds", "busy_seconds", (-F.col("peak.level")).alias("most_at_once"), F.col("peak.moment").alias("peak_from")),
        keys,
    )


def level_seconds(runs: DataFrame, *keys: str, started: str = "started", ended: str = "ended") -> DataFrame:
    """Per key and number of runs at once, from one on: for how many seconds just so many ran. Runs count as in :func:`level_changes`."""
    at = F.col("micros").cast(_EXACT)
    side = lambda level, micros: F.struct(F.col(level).alias("at_once"), micros.alias("micros"))
    changed = level_changes(runs, *keys, started=started, ended=ended).where("before <> after")
    sides = changed.select("key", F.explode(F.array(side("before", at), side("after", -at))).alias("side")).select("key", "side.*")
    levels = sides.where("at_once > 0").groupBy("key", "at_once").agg((F.sum("micros").cast("long") / SECOND).alias("seconds"))
    return _named(levels, keys)


def last_attempts(runs: DataFrame, *keys: str, run: str = "run_id", started: str = "started", status: str = "status") -> DataFrame:
    """Per key and day of the start: attempts, how many did not succeed, the last one and how it ended, and whether it made good earlier failures.

    Of runs that start together the one with the greatest id is the last. Runs without a start have a missing day. A missing status is no success.
    """
    succeeded = F.coalesce(F.col(f"`{status}`") == SUCCESS, F.lit(False))
    last = F.max(F.struct(F.col(f"`{started}`").alias("at"), F.col(f"`{run}`").alias("run"), F.col(f"`{status}`").alias("status")))
    by_day = runs.groupBy(*(F.col(f"`{name}`") for name in keys), F.to_date(F.col(f"`{started}`")).alias("day")).agg(
        F.count("*").alias("attempts"), F.count_if(~succeeded).alias("unsuccessful"), last.alias("last")
    )
    good = F.coalesce(F.col("last.status") == SUCCESS, F.lit(False))
    return by_day.select(
        *(f"`{name}`" for name in keys), "day", "attempts", "unsuccessful", F.col("last.run").alias("last_run"), F.col("last.status").alias("last_status"),
        (good & (F.col("unsuccessful") > 0)).alias("recovered"),
    )
