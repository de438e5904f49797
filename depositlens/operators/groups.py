"""Membership through groups within groups, and branches granted by area or prefecture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depositlens.sources.shared import fresh_path, remove_path

# What a grant may name.
LEVELS = ("branch", "area", "prefecture")
# Rows that a round of the closure may join for each pair known so far.
MOST_WAYS = 4


def group_closure(nesting: DataFrame) -> DataFrame:
    """(member, group): every group a group lies in, directly or through others, from the direct pairs ``nesting`` (member, group).

    A group is not listed as lying in itself; missing names are no groups; a cycle ends by itself. All pairs up to some number of steps are
    known with their fewest steps, and a round extends the farthest of them by the known ones: twice as far, or less far where many
    ways lead to the same groups, so that no round joins more than ``MOST_WAYS`` rows for each known pair unless a single step does. Only groups in which a
    farthest pair ends are extended; where these are few, Spark broadcasts them and the known pairs stay where they are.
    The rounds, about the logarithm of the depth, are written below the shared folder: a lost executor repeats a task, not the rounds before.
    """
    spark = nesting.sparkSession
    path, reach, rounds = fresh_path(spark, "groups"), 1, []

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{path}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}")

    direct = nesting.select("member", "group").where("member <> `group`").distinct()
    newest = written(direct.withColumn("steps", F.lit(1)), "pairs-1")
    while True:
        rounds.append(f"{path}/pairs-{reach}")
        known = spark.read.schema(newest.schema).parquet(*rounds)
        farthest = newest.where(F.col("steps") == reach)
        ends = written(farthest.groupBy(F.col("group").alias("member")).agg(F.count("*").alias("ways")), f"ends-{reach}")
        onward = known.join(ends, "member")
        stride = _stride(onward, MOST_WAYS * known.count())
        if stride == 0:
            remove_path(spark, f"{path}/ends-{reach}")
            return known.select("member", "group")
        longer = farthest.alias("low").join(
            onward.where(F.col("steps") <= stride).alias("high"), F.col("low.group") == F.col("high.member")
        )
        pairs = longer.select("low.member", "high.group", (F.col("high.steps") + reach).alias("steps")).where("member <> `group`")
        fewest = pairs.groupBy("member", "group").agg(F.min("steps").alias("steps"))
        newest = written(fewest.join(known, ["member", "group"], "left_anti"), f"pairs-{reach + stride}")
        remove_path(spark, f"{path}/ends-{reach}")
        reach += stride


def _stride(onward: DataFrame, most: int) -> int:
    """The most steps by which a round may go on without joining more than ``most`` rows, one at least; 0 if nothing goes on.

    The driver gets a row for each number of steps.
    """
    sizes = sorted(onward.groupBy("steps").agg(F.sum("ways").alias("ways")).collect())
    stride, total = min(len(sizes), 1), 0
    for row in sizes:
        total += row.ways
        if total <= most:
            stride = row.steps
    return stride


def all_memberships(memberships: DataFrame, nesting: DataFrame) -> DataFrame:
    """(user, group) with the groups a user belongs to through others; each pair once.

    The different memberships are written below the shared folder first, so Spark knows their size: it broadcasts few of them, and the closure stays
    where it is. More meet the closure by one join, in which adaptive execution splits a group that a third of all users are in.
    """
    spark = memberships.sparkSession
    path = fresh_path(spark, "memberships")
    different = memberships.select("user", "group").where("`group` IS NOT NULL").distinct()
    different.write.parquet(path)
    own = spark.read.schema(different.schema).parquet(path)
    closure = group_closure(nesting)
    through = own.alias("own").join(closure.alias("all"), F.col("own.group") == F.col("all.member"))
    return own.unionByName(through.select("own.user", "all.group")).distinct()


def granted_branches(grants: DataFrame, branch: DataFrame) -> DataFrame:
    """(user, branch_id) from ``grants`` (user, level, value): a branch by its id, an area as ``prefecture/area``, or a prefecture by name.

    Area names repeat across prefectures, so an area is named with its own. A grant of something unknown gives nothing; double grants count once.
    """
    value = {"branch": F.col("branch_id"), "area": F.concat_ws("/", "prefecture", "area"), "prefecture": F.col("prefecture")}
    named = F.explode(F.array(*(F.struct(F.lit(level).alias("level"), value[level].alias("value")) for level in LEVELS)))
    places = branch.select("branch_id", named.alias("place")).select("branch_id", "place.level", "place.value")
    return grants.join(places, ["level", "value"]).select("user", "branch_id").distinct()
