"""The stored tables and the jobs on top of them."""

import json
from pathlib import Path

import pytest
from conftest import DATA, rows_of
from pyspark.sql import functions as F

from tallymart.operators import kpis
from tallymart.plans import jobs
from tallymart.plans.catalog import lake_for


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    return jobs.build_tables(spark, str(DATA), str(root)), root


def test_stored_tables_equal_the_lazy_ones(spark, built):
    lake, root = built
    lazy = lake_for(spark, str(DATA))
    for name in [*jobs.SILVER, *jobs.GOLD]:
        stored, fresh = getattr(lake, name), getattr(lazy, name)
        assert rows_of(stored) == rows_of(fresh.select(stored.columns)), name
    assert "_created_at" in spark.read.parquet(str(root / "fact_order")).columns
    assert list((root / "sessions").glob("year=2024/month=1/day=*"))


def test_reports_read_the_stored_facts(built):
    lake, root = built
    report = kpis.kpi(lake.fact_order, lake.dim_date)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert f"{root}/fact_order" in plan and "WindowGroupLimit" not in plan


def test_stored_tables_pass_their_checks(built):
    lake, _ = built
    assert jobs.check_tables(lake).filter("not passed").count() == 0


def test_train_then_score_twice(spark, built, tmp_path):
    lake, _ = built
    metrics = jobs.train_model(lake.behaviour, str(tmp_path / "model")).first()
    written = json.loads(next(Path(tmp_path / "model" / "metrics").glob("*.json")).read_text())
    assert written == metrics.asDict()
    day = str(lake.behaviour.agg(F.max("prediction_date")).first()[0])
    table = str(tmp_path / "campaign")
    args = (lake.behaviour, lake.customers, str(tmp_path / "model"), table, day)
    once = rows_of(jobs.score_campaign(*args))
    again = rows_of(jobs.score_campaign(*args))
    assert once == again and len(once) == lake.behaviour.filter(
        F.col("prediction_date") == day).count()
    everything = jobs.score_campaign(*args[:4])
    assert everything.count() == lake.behaviour.count()


def test_random_split_covers_all_rows(built):
    from tallymart.operators import propensity

    lake, _ = built
    a, b = propensity.random_split(lake.behaviour)
    assert a.count() + b.count() == lake.behaviour.count()
