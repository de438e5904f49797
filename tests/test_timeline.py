import random
from datetime import datetime, timedelta

import pytest

from depositlens.operators import timeline
from tests import data

BASE = datetime(2026, 8, 18, 23, 50)
SCHEMA = "run_id long, task string, status string, started timestamp_ntz, ended timestamp_ntz"


def at(seconds):
    return None if seconds is None else BASE + timedelta(seconds=seconds)


def frame(spark, rows):
    return spark.createDataFrame([(i, task, status, at(a), at(b)) for i, (task, status, a, b) in enumerate(rows)], SCHEMA)


def expected(spans):
    """(busy, most, from, {level: seconds}) by looking at every moment."""
    moments = sorted({m for span in spans for m in span})
    levels = {}
    for a, b in zip(moments, moments[1:], strict=False):
        n = sum(s <= a < e for s, e in spans)
        levels[n] = levels.get(n, 0) + b - a
    levels.pop(0, None)
    most = max(sum(s <= m < e for s, e in spans) for m in moments)
    first = next(m for m in moments if sum(s <= m < e for s, e in spans) == most)
    return sum(levels.values()), most, first, levels


def test_overlap_against_every_moment(spark):
    draw = random.Random(5)
    rows = []
    for task, days, longest in (("short", 1, 90), ("long", 3, 200_000), ("hot", 1, 3_000), (None, 2, 40_000)):
        for _ in range(60):
            start = draw.randrange(0, days * 86_400)
            rows.append((task, "SUCCESS", start, start + draw.randrange(1, longest)))
    rows += [("hot", "SUCCESS", 1_200, 1_260)] * 40  # the same run again and again
    found = {row.task: row for row in timeline.run_overlap(frame(spark, rows), "task").collect()}
    levels = {}
    for row in timeline.level_seconds(frame(spark, rows), "task").collect():
        levels.setdefault(row.task, {})[row.at_once] = row.seconds
    assert len(found) == 4
    for task, row in found.items():
        spans = [(a, b) for name, _, a, b in rows if name == task]
        busy, most, first, by_level = expected(spans)
        assert (row.timed_runs, row.run_seconds) == (len(spans), sum(b - a for a, b in spans))
        assert (row.busy_seconds, row.most_at_once, row.peak_from) == (busy, most, at(first))
        assert levels[task] == by_level
    everything = timeline.run_overlap(frame(spark, rows)).collect()
    busy, most, first, by_level = expected([(a, b) for _, _, a, b in rows])
    assert [tuple(row) for row in everything] == [(len(rows), sum(b - a for _, _, a, b in rows), busy, most, at(first))]
    assert {row.at_once: row.seconds for row in timeline.level_seconds(frame(spark, rows)).collect()} == by_level


def test_runs_that_touch_do_not_overlap_and_open_ones_do_not_count(spark):
    rows = [("t", "SUCCESS", 0, 10), ("t", "SUCCESS", 10, 20), ("t", "SUCCESS", 5, None), ("t", "SUCCESS", None, 7), ("t", "SUCCESS", 8, 8), ("t", "FAILED", 9, 1)]
    assert [tuple(row) for row in timeline.run_overlap(frame(spark, rows), "task").collect()] == [("t", 2, 20.0, 20.0, 1, at(0))]
    assert timeline.run_overlap(frame(spark, rows[2:]), "task").collect() == []
    assert timeline.level_seconds(frame(spark, []), "task").collect() == []


def test_days_before_the_epoch_and_clashing_names(spark):
    runs = spark.createDataFrame(
        [("a", "b", datetime(1969, 12, 31, 23, 59, 59, 500_000), datetime(1970, 1, 1, 0, 0, 1)), ("a", "b", datetime(1960, 1, 1), datetime(1960, 1, 3))],
        "key string, `delta.x` string, moment timestamp_ntz, micros timestamp_ntz",
    )
    found = timeline.run_overlap(runs, "key", "delta.x", started="moment", ended="micros").collect()
    assert [tuple(row) for row in found] == [("a", "b", 2, 172_801.5, 172_801.5, 1, datetime(1960, 1, 1))]


def test_no_group_is_a_whole_timeline(spark):
    text = data.plan(timeline.run_overlap(frame(spark, [("t", "SUCCESS", 0, 10)]), "task"))
    assert "Join" not in text and "minute" in text and "day" in text


@pytest.mark.parametrize("order", [1, -1])
def test_last_attempts(spark, order):
    rows = [
        ("a", "FAILED", 0, 10), ("a", "FAILED", 20, 30), ("a", "SUCCESS", 40, None), ("a", "SUCCESS", 3_600, 3_700),
        ("b", "SUCCESS", 0, 10), ("b", "FAILED", 20, 30), ("b", None, 3_600, 3_700), ("c", "FAILED", None, 5),
    ][::order]
    found = {(row.task, row.day and row.day.day): tuple(row)[2:] for row in timeline.last_attempts(frame(spark, rows), "task").collect()}
    ids = {row[:3]: i for i, row in enumerate(rows)}
    assert found == {
        ("a", 18): (3, 2, ids["a", "SUCCESS", 40], "SUCCESS", True),
        ("a", 19): (1, 0, ids["a", "SUCCESS", 3_600], "SUCCESS", False),
        ("b", 18): (2, 1, ids["b", "FAILED", 20], "FAILED", False),
        ("b", 19): (1, 1, ids["b", None, 3_600], None, False),
        ("c", None): (1, 1, ids["c", "FAILED", None], "FAILED", False),
    }
