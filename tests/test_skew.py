"""Hot keys: same results, work spread over tasks."""

from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from tallymart.operators import kpis, skew, star


def hot_lines(spark, n=6000):
    """A third of all lines belong to order 1."""
    order = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997)
    return spark.range(n).select(F.col("id").alias("line"), order.alias("k"))


def test_salted_join_equals_plain_join(no_broadcast):
    spark = no_broadcast
    left = hot_lines(spark).unionByName(
        spark.createDataFrame([(-1, None), (-2, None), (-3, 5000)], "line long, k long"))
    right = spark.range(990).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        ours = skew.salted_join(left, right, ["k"], how, ["line"])
        assert rows_of(ours.select("line", "k", "v")) == rows_of(
            left.join(right, "k", how).select("line", "k", "v"))


def test_salted_join_with_repeated_right_keys(no_broadcast):
    left = hot_lines(no_broadcast, 600)
    right = no_broadcast.createDataFrame([(1, "a"), (1, "b"), (4, "c")], "k long, v string")
    ours = skew.salted_join(left, right, ["k"], "left", ["line"]).select("line", "k", "v")
    assert rows_of(ours) == rows_of(left.join(right, "k", "left").select("line", "k", "v"))


def test_hot_buckets_are_few_and_found(spark):
    hot = skew.hot_buckets(hot_lines(spark).select("k"), ["k"], 1024).collect()
    assert len(hot) == 1 and hot[0]["_salts"] >= 2
    even = spark.range(100_000).select(F.col("id").alias("k"))
    assert skew.hot_buckets(even, ["k"], 1024).count() == 0


def test_hot_key_is_split_over_several_salts(no_broadcast):
    left = hot_lines(no_broadcast)
    right = no_broadcast.range(997).select(F.col("id").alias("k"))
    plan = plan_of(skew.salted_join(left, right, ["k"], "inner", ["line"]))
    assert "_salt" in plan and "SortMergeJoin" in plan


def test_small_right_side_is_joined_plainly(spark, tmp_path):
    spark.range(10).selectExpr("id as k").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    assert skew.broadcastable(dim)
    plan = plan_of(skew.salted_join(hot_lines(spark), dim, ["k"], "inner", ["line"]))
    assert "_salt" not in plan and "BroadcastHashJoin" in plan


def test_item_reports_survive_a_hot_product(no_broadcast):
    spark = no_broadcast
    sold = hot_lines(spark).select(
        F.col("line").alias("order_id"), F.col("k").alias("product_key"), F.lit(1).alias("quantity"),
        F.lit(2).cast("decimal(12,2)").alias("price"),
        F.lit(2).cast("decimal(18,2)").alias("sub_total"))
    products = spark.range(997).select(
        F.col("id").alias("product_id"),
        F.when(F.col("id") == 1, "hot").otherwise("rest").alias("category"))
    out = {r.category: r.category_orders for r in kpis.category_share(sold, products).collect()}
    expected = sold.join(products, F.col("product_key") == F.col("product_id")).groupBy(
        "category").agg(F.countDistinct("order_id").alias("n"))
    assert out == {r.category: r.n for r in expected.collect()}


def test_fact_order_items_with_a_giant_order(no_broadcast):
    spark = no_broadcast
    money = "decimal(12,2)"
    lines = hot_lines(spark).select(
        F.col("line").alias("order_item_id"), F.col("k").alias("order_id"),
        F.lit(1).cast("long").alias("product_id"), F.lit(1).alias("quantity"),
        F.lit(1).cast(money).alias("price"), F.lit(0).cast(money).alias("discount"),
        F.lit(1).cast("decimal(18,2)").alias("line_total_amount"))
    orders = spark.range(997).select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"),
        F.lit(1).alias("payment_method_id"), F.lit("2024-01-01").cast("date").alias("order_date"))
    out = star.fact_order_items(lines, orders)
    assert out.count() == lines.count()
    assert out.filter("order_id = 1").count() == lines.filter("order_id = 1").count()
