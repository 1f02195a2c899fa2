"""Cases that once lost or changed data."""

from conftest import DATA, rows_of
from pyspark.sql import functions as F

from tallymart.operators import kpis, quality, star
from tallymart.plans.catalog import lake_for
from tallymart.plans.lakehouse import Lakehouse
from tallymart.sources import files, sinks


def test_text_and_times_survive_the_snapshot(spark, tmp_path):
    rows = [(1, 'say "hi", a\nb', " outer ", 2), (2, "", None, 3), (3, "back\\slash", ",", 4)]
    df = spark.createDataFrame(rows, "product_id long, product_name string, product_description string, n int")
    stamp = F.timestamp_micros(F.lit(1_700_000_000_123_456)).alias("created_at")
    df = df.select("product_id", "product_name", "product_description", F.lit(1.5).cast("decimal(12,2)").alias("price"),
                   F.col("n").alias("category_id"), F.lit("b").alias("brand_id"), stamp, stamp.alias("updated_at"))
    path = str(tmp_path / "p")
    files.write_snapshot(df, path, "products")
    assert rows_of(files.read_snapshot(spark, path, "products")) == rows_of(df)


def test_event_times_keep_their_microseconds(spark, tmp_path):
    raw = Lakehouse(spark, str(DATA)).raw("clickstream").withColumn("ingest_date", F.to_date("timestamp"))
    path = str(tmp_path / "days")
    sinks.write_json_days(raw, path)
    back = files.read_clickstream(spark, path)
    assert rows_of(back.select("event_id", "timestamp")) == rows_of(raw.select("event_id", "timestamp"))


def test_orders_of_any_year_are_reported(spark):
    lake = Lakehouse(spark, str(DATA))
    moved = F.when(F.col("order_id") % 3 == 0, F.lit("2031-05-01")).when(F.col("order_id") % 3 == 1, F.lit("1985-05-01"))
    lake.orders = lake.orders.withColumn("order_date", F.coalesce(moved.cast("timestamp"), F.col("order_date")))
    report = kpis.kpi(lake.fact_order, lake.order_days).first()
    assert report["total_orders"] == lake.fact_order.count()


def test_files_that_arrive_are_seen(spark, tmp_path):
    for name in ("orders", "lineitem", "customer", "part", "events", "nation"):
        spark.read.parquet(str(DATA / f"{name}.parquet")).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = lake_for(spark, str(tmp_path)).orders.count()
    more = spark.read.parquet(str(DATA / "orders.parquet")).limit(5).withColumn("o_orderkey", F.col("o_orderkey") + 10**7)
    more.write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    assert lake_for(spark, str(tmp_path)).orders.count() == before + 5


HISTORY = "id int, v string, note string, effective_start_date date, effective_end_date date, is_current boolean"


def history(spark, *rows):
    return spark.createDataFrame([(i, v, n, s, None, True) for i, v, n, s in rows], "id int, v string, note string, s string, e string, c boolean").selectExpr(
        "id", "v", "note", "date(s) effective_start_date", "date(e) effective_end_date", "c is_current")


def test_versions_keep_untracked_columns_and_single_current_rows(spark):
    start = history(spark, (1, "a", "x", "2024-01-01"), (2, "b", "y", "2024-01-01"))
    snap = spark.createDataFrame([(1, "A"), (1, "B"), (None, "q"), (3, "c")], "id int, v string")
    out = star.scd2_apply(start, snap, "id", ["v"], "2024-02-01", [F.col("v").desc()])
    got = sorted((r.id, r.v, r.note, r.is_current) for r in out.filter("is_current").collect() if r.id != 3)
    assert got == [(1, "B", "x", True), (2, "b", "y", True)]
    assert out.filter("id = 3").count() == 1 and out.filter("id = 1").count() == 2
    assert out.filter("id is null").count() == 0


def test_a_backdated_snapshot_changes_nothing(spark):
    start = history(spark, (1, "a", "x", "2024-03-01"))
    snap = spark.createDataFrame([(1, "z")], "id int, v string")
    assert rows_of(star.scd2_apply(start, snap, "id", ["v"], "2024-02-01")) == rows_of(start)


def test_zorder_takes_any_orderable_column_and_frame(spark):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("name"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"), "id")
    joined = df.join(df.select("id"), "id")
    out = sinks.zorder_cluster(joined, ["name", "at"])
    assert rows_of(out.select(*df.columns)) == rows_of(df)


def test_compaction_honours_its_target(spark, tmp_path):
    loose, tidy = str(tmp_path / "loose"), str(tmp_path / "tidy")
    spark.range(400_000).select("id", F.xxhash64("id").alias("h")).repartition(9).write.parquet(loose)
    sinks.compact(spark, loose, tidy, target_mb=512)
    assert sinks.table_size(spark.read.parquet(tidy)).first()["files"] == 1
    small = str(tmp_path / "small")
    sinks.compact(spark, loose, small, target_mb=1)
    assert sinks.table_size(spark.read.parquet(small)).first()["files"] >= 4


def test_keys_of_different_number_types_are_compared_by_value(spark):
    child = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 9.0), (None, None)], "i bigint, d double")
    parent = spark.sql("select cast(id as decimal(10,2)) as p, cast(id as int) as q from range(1, 3)")
    found = quality.relationship_counts([("by decimal", child, "i", parent, "p"), ("by double", child, "d", parent, "q"),
                                         ("same", child, "i", parent, "q")])
    assert rows_of(found) == [("by decimal", 3, 1), ("by double", 3, 1), ("same", 3, 1)]
