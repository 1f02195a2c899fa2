"""The plans we count on: early per-key limits, pruned scans, no Python workers."""

import re

import pytest
from conftest import DATA, plan_of, rows_of
from pyspark.sql import functions as F

from tallymart.operators import kpis, star
from tallymart.plans.catalog import QUERIES, bucketed_orders, lake_for, surface
from tallymart.plans.lakehouse import Lakehouse

WRITES = {  # run jobs while the frame is built
    "src_csv_roundtrip", "src_ndjson_scan", "sink_partitioned_sessions", "compact_partition",
    "zorder_cluster", "campaign_upsert", "ml_scaled_features", "ml_train_lr", "ml_metrics",
    "ml_importance", "ml_batch_score", "ml_model_roundtrip", "ml_rule_auc", "ml_describe",
    "table_fact_order", "table_fact_order_items", "compact_small_files",
}
LAZY = sorted(n for n in QUERIES if n not in WRITES and not n.startswith(("stream_", "ingest_")))


@pytest.fixture(scope="module")
def lake(spark):
    return lake_for(spark, str(DATA))


@pytest.mark.parametrize("name", LAZY)
def test_no_python_workers_and_no_cartesian_product(lake, name):
    plan = plan_of(surface(QUERIES[name](lake)))
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "MapInPandas"):
        assert node not in plan


def test_dedup_limits_each_key_before_the_shuffle(lake):
    plan = plan_of(lake.order_items)
    limit, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert limit > exchange, "the partial limit sits below the exchange"
    assert "Partial" in plan


def test_scans_are_pruned_and_filters_pushed(lake):
    plan = plan_of(lake.order_items)
    assert "l_shipdate" not in plan and "l_tax" not in plan and "l_suppkey" not in plan
    assert "IsNotNull(l_orderkey)" in plan
    kpi = plan_of(kpis.kpi(lake.fact_order, lake.dim_date))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", kpi)
    assert scans and not any(c in s for s in scans for c in ("o_clerk", "o_shippriority", "l_shipdate"))
    kept = set(re.findall(r"\b([lo]_[a-z]+):", " ".join(scans)))
    assert "o_orderdate" in kept and "l_partkey" not in kept


def test_order_fact_shares_one_partitioning(no_broadcast):
    lake = Lakehouse(no_broadcast, str(DATA))
    plan = plan_of(lake.fact_order)
    # orders by order, lines by line id, line sums by order; the join adds none
    assert plan.count("Exchange hashpartitioning") == 3


def test_activity_reads_the_log_once(lake):
    assert plan_of(lake.activity).count("FileScan parquet") == 1


def test_rolling_features_have_no_self_join(lake):
    assert "Join" not in plan_of(lake.behaviour)


def test_bucketed_tables_join_without_an_exchange(no_broadcast):
    lake = Lakehouse(no_broadcast, str(DATA))
    orders, items = bucketed_orders(lake, buckets=4)
    by_order = plan_of(star.fact_order(orders, items))
    by_line = plan_of(star.fact_order_items(items, orders, colocated=True))
    for plan in (by_order, by_line):
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    name = no_broadcast.catalog.listTables()[0].name
    assert no_broadcast.table(name).count() in (orders.count(), items.count())  # read by name
    assert rows_of(star.fact_order(orders, items)) == rows_of(lake.fact_order)
    lines = star.fact_order_items(items, orders, colocated=True)
    assert rows_of(lines) == rows_of(lake.fact_order_items)
    files = items.select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 8, "about a file per bucket"
