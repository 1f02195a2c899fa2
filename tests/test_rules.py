"""Declared rules in one pass per table, and increments at a shared border time."""

import itertools

import pytest
from conftest import DATA, plan_of, rows_of

from tallymart.operators import incremental, rules
from tallymart.plans.catalog import declared_tables, lake_for


def test_every_declaration_is_there():
    declared = rules.DECLARED.values()
    assert sum(len(r.not_null) for r in declared) == 203
    single = [k for r in declared for k in r.unique if len(k) == 1]
    assert len(single) == 24 and sum(len(r.accepted) for r in declared) == 9
    assert rules.DECLARED["campaign"].unique == [("customer_id", "campaign_date")]


def test_each_table_is_read_once(spark):
    tables = declared_tables(lake_for(spark, str(DATA)))
    assert tables.keys() == rules.DECLARED.keys()
    for name, df in tables.items():
        checked = plan_of(rules.check(df, rules.DECLARED[name], name))
        assert checked.count("FileScan") == plan_of(df).count("FileScan"), name


def test_violations_are_counted(spark):
    rows = [(1, "a", 1), (1, "b", 1), (1, None, 2), (None, "x", 2), (None, None, None), (2, "a", 3)]
    df = spark.createDataFrame(rows * 3, "k int, v string, w int").repartition(4)
    found = rules.check(df, rules.Rules(["k", "v"], [("k",), ("k", "v")], {"v": ["a", "b"], "w": [1, 2]}), "t")
    assert {tuple(r)[1:] for r in found.collect()} == {
        ("not_null", "k", 18, 6), ("not_null", "v", 18, 6), ("unique", "k", 18, 12 - 2),
        ("unique", "k+v", 18, 9 - 3), ("accepted_values", "v", 18, 3), ("accepted_values", "w", 18, 3)}
    empty = rules.check(df.limit(0), rules.Rules(["k"], [("k",)]), "t")
    assert {tuple(r)[3:] for r in empty.collect()} == {(0, 0)}


def test_rows_of_the_border_time_are_loaded_once(spark):
    schema = "id int, at int, other string"
    rows = [(k, k // 4, "x") for k in range(20)] + [(20, None, "x"), (21, None, "x")]
    source = spark.createDataFrame(rows, schema)
    for held in ([], [(1, 0), (0, 0)], [(0, 0), (6, 1), (21, None)], [(19, 4)], [(3, 4)]):
        target = spark.createDataFrame([(*h, "y") for h in held], schema)
        top = max((a for _, a in held if a is not None), default=None)
        due = [r for r in rows if (r[1] is None or top is None or r[1] >= top) and (r[0], r[1]) not in held]
        assert rows_of(incremental.rows_after(source, target, "at", ["id"])) == sorted(due, key=repr)


@pytest.mark.parametrize("steps", [[5, 5, 12], [1, 2, 3, 4]])
def test_repeated_increments_load_every_row_once(spark, steps):
    """Rows arrive in order of time, equal times spread over several increments."""
    schema = "id int, at int"
    rows = [(k * 7 % 22, k // 6) for k in range(22)]
    loaded = spark.createDataFrame([], schema)
    for upto in itertools.accumulate([*steps, 22]):
        source = spark.createDataFrame(rows[:upto], schema)
        loaded = spark.createDataFrame(
            loaded.collect() + incremental.rows_after(source, loaded, "at", ["id"]).collect(), schema)
        assert rows_of(loaded) == sorted(rows[:upto], key=repr)
