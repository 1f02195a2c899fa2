"""Many snapshots folded at once, against one after the other."""

import random

import pytest
from conftest import plan_of, rows_of

from tallymart.operators import star

HISTORY = ("id int, a string, b int, note string, extra int, effective_start_date date, effective_end_date date, "
           "is_current boolean")
ROWS = "id int, a string, b int, note string, seen int, day date"


def day(k):
    return f"2024-{1 + k // 28:02d}-{1 + k % 28:02d}"


def snapshot_rows(draw, days):
    rows = []
    for k in range(days):
        for key in range(12):
            for _ in range(draw.choice([0, 1, 1, 1, 2, 3])):  # absent, once, or repeated
                rows.append((key, draw.choice(["x", "y", None]), draw.choice([1, None]), f"n{draw.randrange(3)}",
                             draw.randrange(3), day(k)))
        rows.append((None, "x", 1, "no key", 0, day(k)))
    return rows


@pytest.mark.parametrize(("seed", "with_history"), [(1, False), (2, True), (3, True)])
def test_twenty_snapshots_at_once(spark, seed, with_history):
    draw = random.Random(seed)
    held = []
    if with_history:  # versions begun before, on and after the days of the snapshots
        for key in range(0, 16, 2):
            since = draw.randrange(25)
            held.append((key, "x", 1, "old", key, day(since), None, True))
            held.append((key, "w", 1, "older", key, "2023-01-01", day(since), False))
    as_rows = lambda rows, ddl: spark.createDataFrame(rows, ddl.replace(" date", " string")).selectExpr(
        *[f"cast({c.split()[0]} as {c.split()[1]}) {c.split()[0]}" for c in ddl.split(", ")])
    history = as_rows(held, HISTORY)
    snapshots = as_rows(snapshot_rows(draw, 20), ROWS).repartition(5)
    folded = star.scd2_fold(history, snapshots, "id", ["a", "b"], "day", ["seen"])
    expected = history
    for k in range(20):
        one = snapshots.filter(f"day = date'{day(k)}'").drop("day")
        newest = [one["seen"].desc_nulls_last()]
        expected = star.scd2_apply(expected, one, "id", ["a", "b"], day(k), newest)
        expected = spark.createDataFrame(expected.collect(), history.schema)  # plans stay short
    assert rows_of(folded) == rows_of(expected)
    starts = folded.groupBy("id").agg({"is_current": "count"}).count()
    assert folded.filter("is_current").count() == starts


def test_one_shuffle(no_broadcast):
    rows = no_broadcast.createDataFrame([(1, "x", "2024-01-01")], "id int, a string, day string")
    plan = plan_of(star.scd2_fold(star.no_history(rows, "id", ["a"]), rows, "id", ["a"], "day"))
    assert plan.count("Exchange hashpartitioning") == 1
