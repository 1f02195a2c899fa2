"""Named queries: every operator applied to the tables of one folder.

``surface`` is the only place where types change for output: exact decimals become
doubles and zoned timestamps become plain ones, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.columns import with_audit
from ..operators import (
    campaign, features, incremental, kpis, masking, propensity, quality, ranks, rules, silver,
    staging, star,
)
from ..session import materialise, workspace
from ..sources import compaction, files, sinks, tables, warehouse
from ..streaming import ingest
from ..streaming.sessions import SessionLog
from .lakehouse import Lakehouse

QUERIES: dict[str, Callable[[Lakehouse], DataFrame]] = {}


def query(name: str):
    def register(build: Callable[[Lakehouse], DataFrame]):
        QUERIES[name] = build
        return build

    return register


def surface(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz").alias(f.name)
        out.append(col)
    return df.select(*out)


def lake_for(spark: SparkSession, folder: str) -> Lakehouse:
    """The table graph over the folder's files as they are now."""
    return Lakehouse(spark, folder)


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return surface(QUERIES[name](lake_for(spark, folder)))


# --- sources and sinks ---------------------------------------------------------------
@query("src_csv_roundtrip")
def _(lake):
    path = workspace(lake.spark, "orders-csv")
    files.write_snapshot(lake.raw("orders"), path, "orders")
    return files.read_snapshot(lake.spark, path, "orders")


@query("src_ndjson_scan")
def _(lake):
    path = workspace(lake.spark, "clickstream")
    raw = lake.raw("clickstream").withColumn("ingest_date", F.to_date("timestamp"))
    sinks.write_json_days(raw, path)
    staged = staging.stage_clickstream(files.read_clickstream(lake.spark, path))
    return staged.withColumn("n_actions", F.size("actions")).drop("actions")


@query("sink_partitioned_sessions")
def _(lake):
    path = workspace(lake.spark, "sessions")
    sinks.write_partitioned(lake.sessions, path)
    return lake.spark.read.schema(lake.sessions.schema).parquet(path)


@query("compact_partition")
def _(lake):
    loose, tidy = workspace(lake.spark, "loose"), workspace(lake.spark, "tidy")
    lake.sessions.write.partitionBy(*sinks.YMD).parquet(loose)
    sinks.compact(lake.spark, loose, tidy, by=sinks.YMD)
    return lake.spark.read.schema(lake.sessions.schema).parquet(tidy)


@query("compact_small_files")
def _(lake):
    """Sessions that came in several loads, their small files merged in place."""
    path = workspace(lake.spark, "loads")
    loads = lake.sessions.withColumn("_load", F.pmod(F.xxhash64("session_id"), F.lit(3)))
    loads = materialise(lake.spark, loads, "loads")
    for load in range(3):
        part = loads.filter(F.col("_load") == load).drop("_load")
        sinks.write_partitioned(part, path, sinks.YMD[:2], mode="append")
    compaction.compact_small_files(lake.spark, path, sinks.YMD[:2])
    return lake.spark.read.schema(lake.sessions.schema).parquet(path)


@query("zorder_cluster")
def _(lake):
    fact = materialise(lake.spark, lake.fact_order, "fact-order")
    path = workspace(lake.spark, "zorder")
    sinks.zorder_cluster(fact, ["date_key", "customer_key"]).write.parquet(path)
    return lake.spark.read.schema(fact.schema).parquet(path)


def bucketed_orders(lake, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Orders and lines as catalog tables bucketed by order, each with a name of its own."""
    out = []
    for name in ("orders", "order_items"):
        at = workspace(lake.spark, f"bucketed-{name}")
        table = f"{name}_{at.rsplit('-', 1)[1]}"
        out.append(tables.save_bucketed(getattr(lake, name), table, "order_id", at, buckets))
    return out[0], out[1]


@query("table_fact_order")
def _(lake):
    return star.fact_order(*bucketed_orders(lake))


@query("table_fact_order_items")
def _(lake):
    orders, items = bucketed_orders(lake)
    return star.fact_order_items(items, orders, colocated=True)


# --- staging -------------------------------------------------------------------------
for _key, _table in {
    "stg_brands": "brands",
    "stg_categories": "category",
    "stg_payment_methods": "payment_method",
    "stg_customers": "customers",
    "stg_products": "products",
    "stg_orders": "orders",
    "stg_order_items": "order_items",
}.items():
    QUERIES[_key] = lambda lake, t=_table: lake.staged(t)


@query("stg_clickstream")
def _(lake):
    staged = lake.staged("clickstream")
    return staged.withColumn("n_actions", F.size("actions")).drop("actions")


# --- silver and gold tables ----------------------------------------------------------
for _key, _name in {
    "silver_brands": "brands",
    "silver_categories": "categories",
    "silver_payment_methods": "payment_methods",
    "silver_customers": "customers",
    "silver_products": "products",
    "silver_orders": "orders",
    "silver_order_items": "order_items",
    "silver_user_sessions": "sessions",
    "silver_session_actions": "actions",
    "dim_customer": "dim_customer",
    "dim_payment_method": "dim_payment_method",
    "dim_product": "dim_product",
    "fact_order": "fact_order",
    "fact_order_items": "fact_order_items",
    "feat_rolling_3d": "rolling",
    "feat_user_behavior_3d": "behaviour",
}.items():
    QUERIES[_key] = lambda lake, n=_name: getattr(lake, n)


@query("dim_date")
def _(lake):
    return star.calendar_covering(lake.staged("orders"), "order_date")


@query("scd2_payment_method")
def _(lake):
    """Second snapshot: methods with more than an average number of orders are preferred."""
    history = star.dim_payment_method(lake.payment_methods)
    counts = lake.orders.groupBy("payment_method_id").agg(F.count("order_id").alias("n"))
    mean = counts.agg(F.avg("n").alias("m")).select("m").scalar()
    later = (
        lake.payment_methods.join(counts, "payment_method_id", "left")
        .withColumn(
            "provider",
            F.when(F.col("n") > mean, F.concat(F.lit("Preferred "), "provider")).otherwise(
                F.col("provider")
            ),
        )
        .drop("n")
    )
    return star.scd2_apply(
        history, later, "payment_method_id", ["display_name", "provider", "type"], "2025-07-01"
    )


@query("scd2_customer_tier")
def _(lake):
    """Tier history: first by balance, later raised to platinum by order value.

    Customers with an unknown balance tier were not in the first snapshot.
    """
    first = lake.staged("customers").filter("tire is not null").select("customer_id")
    known = lake.customers.join(first, "customer_id", "left_semi")
    history = known.select(
        "customer_id", "tire", "address",
        F.lit("2000-01-01").cast("date").alias("effective_start_date"),
        F.lit(None).cast("date").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )
    spend = lake.orders.groupBy("customer_id").agg(F.sum("total_amount").alias("spend"))
    later = lake.customers.join(spend, "customer_id", "left").select(
        "customer_id",
        F.when(F.col("spend") >= 3_000_000, "platinum").otherwise(F.col("tire")).alias("tire"),
        "address",
    )
    return star.scd2_apply(history, later, "customer_id", ["tire", "address"], "2002-01-01")


@query("scd2_monthly_tier")
def _(lake):
    """Tier by all that a customer has spent, from a snapshot on the first of every month with orders."""
    month = F.add_months(F.trunc("order_date", "month"), 1)
    monthly = lake.orders.groupBy("customer_id", month.alias("day")).agg(F.sum("total_amount").alias("spent"))
    so_far = F.sum("spent").over(Window.partitionBy("customer_id").orderBy("day"))
    tier = (
        F.when(so_far >= 2_000_000, "platinum").when(so_far >= 1_000_000, "gold")
        .when(so_far >= 500_000, "silver").otherwise("bronze")
    )
    snapshots = monthly.select("customer_id", "day", tier.alias("tire"))
    return star.scd2_fold(star.no_history(snapshots, "customer_id", ["tire"]), snapshots, "customer_id", ["tire"], "day")


# --- features ------------------------------------------------------------------------
@query("feat_daily_sessions")
def _(lake):
    return features.daily_sessions(lake.sessions)


@query("feat_daily_actions")
def _(lake):
    return features.daily_actions(lake.actions)


@query("feat_daily_activity")
def _(lake):
    """From the two daily tables, as when those are at hand."""
    return features.daily_activity(
        features.daily_sessions(lake.sessions), features.daily_actions(lake.actions)
    )


@query("feat_activity_from_log")
def _(lake):
    return lake.activity


@query("feat_label")
def _(lake):
    return features.label_anchor(lake.activity)


@query("feat_top_spenders")
def _(lake):
    return features.top_spenders(lake.behaviour)


# --- reports -------------------------------------------------------------------------
for _key, _report in {
    "bi_kpi": kpis.kpi,
    "bi_monthly_mom": kpis.monthly_mom,
    "bi_quarterly_yoy": kpis.quarterly_yoy,
    "bi_daily_ma7": kpis.daily_moving_avg,
    "bi_dow_profile": kpis.weekday_profile,
    "bi_monthly_purchasers": kpis.monthly_purchasers,
}.items():
    QUERIES[_key] = lambda lake, f=_report: f(lake.fact_order, lake.order_days)

for _key, _report in {
    "bi_payment_share": kpis.payment_share,
    "bi_payment_type": kpis.payment_types,
    "bi_aov_by_payment": kpis.aov_by_payment,
}.items():
    QUERIES[_key] = lambda lake, f=_report: f(lake.fact_order, lake.dim_payment_method)

for _key, _report in {
    "bi_province_heatmap": kpis.province_heatmap,
    "bi_top_provinces": kpis.top_provinces,
    "bi_macro_region": kpis.macro_region,
    "bi_region_tier": kpis.region_tier,
    "bi_delivery_sla": kpis.delivery_sla,
    "bi_aov_by_region": kpis.aov_by_region,
}.items():
    QUERIES[_key] = lambda lake, f=_report: f(lake.fact_order, lake.dim_customer)


@query("bi_payment_type_by_orders")
def _(lake):
    return kpis.payment_types(lake.fact_order, lake.dim_payment_method, "total_orders")


@query("bi_payment_monthly")
def _(lake):
    return kpis.payment_monthly(lake.fact_order, lake.dim_payment_method, lake.order_days)


@query("bi_top_products")
def _(lake):
    return kpis.top_products(lake.fact_order_items, lake.dim_product)


@query("bi_top_products_filtered")
def _(lake):
    lines = kpis.filter_items(lake.fact_order_items, "1997-01-01", "1998-12-31")
    return kpis.top_products(lines, lake.dim_product.filter("category = 'SMALL'"))


@query("bi_top_product_names")
def _(lake):
    return kpis.top_product_names(lake.fact_order_items, lake.dim_product)


@query("bi_category_share")
def _(lake):
    return kpis.category_share(
        lake.fact_order_items, lake.dim_product, raw_keys=lake.item_product_keys
    )


@query("bi_category_filtered")
def _(lake):
    return kpis.category_share(
        lake.fact_order_items, lake.dim_product, "PROMO", raw_keys=lake.item_product_keys
    )


def _live_brands(lake) -> DataFrame:
    """The brand master as a second source: its CSV snapshot, not the mart's own table."""
    path = workspace(lake.spark, "brands-csv")
    files.write_snapshot(lake.raw("brands"), path, "brands")
    snapshot = files.read_snapshot(lake.spark, path, "brands")
    return staging.stage(snapshot, staging.STAGING["brands"])


@query("bi_brand_origin")
def _(lake):
    return kpis.brand_origin(lake.fact_order_items, lake.dim_product, _live_brands(lake))


@query("bi_origin_share")
def _(lake):
    return kpis.origin_share(
        lake.fact_order_items, lake.dim_product, _live_brands(lake),
        raw_keys=lake.item_product_keys,
    )


@query("bi_kpi_filtered")
def _(lake):
    fact = kpis.filter_orders(
        lake.fact_order, "1996-01-01", "1999-12-31", "Hà Nội", lake.dim_customer
    )
    return kpis.kpi(fact, lake.order_days)


@query("bi_reconciliation")
def _(lake):
    return kpis.reconcile(
        {
            "Source orders": (lake.staged("orders"), "total_amount"),
            "Order mart": (lake.fact_order, "sub_total"),
        }
    )


# --- campaign ------------------------------------------------------------------------
def _rule_campaign(lake, intercept: float = schemas.RULE_INTERCEPT) -> DataFrame:
    scored = campaign.score_rule(lake.behaviour, intercept=intercept)
    return campaign.campaign(scored, lake.customers)


@query("campaign_rule_scored")
def _(lake):
    return _rule_campaign(lake)


@query("campaign_segments")
def _(lake):
    scored = campaign.score_rule(lake.behaviour)
    return campaign.segment(scored.select("user_id", "prediction_date", "purchase_probability"))


@query("campaign_enrich")
def _(lake):
    """Without a contact table every lead keeps the neutral names."""
    return campaign.campaign(campaign.score_rule(lake.behaviour))


@query("campaign_metrics")
def _(lake):
    return campaign.campaign_metrics(_rule_campaign(lake))


@query("campaign_upsert")
def _(lake):
    """An earlier, colder score is on file up to ten days before the end; the current
    score is merged from the table's last day on."""
    feats = materialise(lake.spark, lake.behaviour, "features")
    end = feats.agg(F.max("prediction_date")).scalar()
    contacts = lake.customers
    old = campaign.campaign(campaign.score_rule(feats, intercept=-2.5), contacts)
    path = workspace(lake.spark, "campaign")
    sinks.write_partitioned(old.filter(F.col("campaign_date") <= F.date_sub(end, 10)), path)
    table = lake.spark.read.schema(old.schema).parquet(path)
    new = campaign.campaign(campaign.score_rule(feats), contacts)
    fresh = incremental.high_water_mark(new, table, "campaign_date", inclusive=True)
    sinks.upsert_partitioned(lake.spark, path, fresh, campaign.CAMPAIGN_KEY)
    return lake.spark.read.schema(old.schema).parquet(path)


@query("inc_high_water_mark")
def _(lake):
    staged = lake.staged("orders")
    loaded = staged.filter("order_date < date'2000-01-01'")
    return incremental.high_water_mark(staged, loaded, "updated_at")


@query("inc_order_items")
def _(lake):
    """Lines above the largest line id on file."""
    staged = lake.staged("order_items")
    loaded = staged.filter("order_id < 1000")
    return incremental.rows_after(staged, loaded, "order_item_id", ["order_item_id"])


@query("inc_click_events")
def _(lake):
    """Events after the newest on file, and those of the same instant that are not on file."""
    staged = lake.staged("clickstream").drop("actions")
    days = F.to_date("event_timestamp")
    half = F.date_add(staged.agg(F.min(days)).scalar(), 10)
    loaded = staged.filter((days < half) | ((days == half) & (F.col("user_id") % 2 == 0)))
    return incremental.rows_after(staged, loaded, "event_timestamp", ["event_id"])


# --- machine learning ----------------------------------------------------------------
@query("ml_impute")
def _(lake):
    """The three-day price mean is unknown, not zero, for users without history."""
    gaps = lake.behaviour.withColumn(
        "total_revenue_3d", F.when(F.col("sessions_3d") > 0, F.col("total_revenue_3d"))
    )
    return propensity.impute(gaps).select(*propensity.KEYS, *schemas.FEATURES)


@query("ml_scaled_features")
def _(lake):
    feats = materialise(lake.spark, lake.behaviour, "features")
    scaled, _model = propensity.prepare(feats)
    values = vector_to_array("features")
    return scaled.select(
        *propensity.KEYS,
        *[F.round(values[i], 6).alias(c) for i, c in enumerate(schemas.FEATURES)],
    )


def _trained(lake):
    """(model, scaler, features, test split); the scaler sees only the training rows."""
    feats = materialise(lake.spark, lake.behaviour, "features")
    train, test = propensity.split(feats)
    vectors, scaler = propensity.prepare(train)
    return propensity.train(vectors), scaler, feats, test


@query("ml_split")
def _(lake):
    train, test = propensity.split(lake.behaviour.select(*propensity.KEYS, schemas.LABEL))
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


@query("ml_train_lr")
def _(lake):
    """The weights, and whether the slope of the loss certifies them as the optimum."""
    feats = materialise(lake.spark, lake.behaviour, "features")
    vectors, _scaler = propensity.prepare(propensity.split(feats)[0])
    model = propensity.train(vectors)
    slopes = propensity.gradient(vectors, model)
    worst = slopes.agg(F.max(F.abs("gradient"))).first()[0]
    weights = propensity.importance(lake.spark, model)
    return weights.withColumn("intercept", F.lit(round(model.intercept, 4))).withColumn(
        "optimal", F.lit(worst is not None and worst < propensity.OPTIMAL)
    )


@query("ml_rule_auc")
def _(lake):
    """Exact ranking metrics of the rule scores."""
    return ranks.ranking_metrics(campaign.score_rule(lake.behaviour), "purchase_probability", schemas.LABEL)


@query("ml_metrics")
def _(lake):
    model, scaler, _feats, test = _trained(lake)
    scored = materialise(lake.spark, propensity.score(test, scaler, model), "scored")
    return propensity.evaluate(scored)


@query("ml_importance")
def _(lake):
    model, *_ = _trained(lake)
    return propensity.importance(lake.spark, model)


@query("ml_batch_score")
def _(lake):
    """Score the last prediction day with a model trained on the training split."""
    model, scaler, feats, _test = _trained(lake)
    last = feats.agg(F.max("prediction_date")).scalar()
    today = feats.filter(F.col("prediction_date") == last)
    scored = propensity.score(today, scaler, model)
    return campaign.campaign(scored, lake.customers)


@query("ml_model_roundtrip")
def _(lake):
    """Save and load both models; scores before and after must agree."""
    model, scaler, _feats, test = _trained(lake)
    at = workspace(lake.spark, "model")
    propensity.save(scaler, model, at)
    scaler2, model2 = propensity.load(at)
    before = propensity.score(test, scaler, model)
    after = propensity.score(test, scaler2, model2)
    columns = [*propensity.KEYS, "purchase_probability"]
    both = before.select(*columns).join(
        after.select(*propensity.KEYS, F.col("purchase_probability").alias("reloaded")),
        propensity.KEYS,
    )
    return both.agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.count_if(F.col("purchase_probability") == F.col("reloaded")).alias("same_rows"),
    )


def _rule_predictions(lake) -> DataFrame:
    scored = campaign.score_rule(lake.behaviour)
    likely = (F.col("purchase_probability") >= 0.5).cast("double")
    return scored.withColumn("prediction", likely)


@query("ml_confusion")
def _(lake):
    return propensity.confusion(_rule_predictions(lake))


@query("ml_class_metrics")
def _(lake):
    return propensity.class_metrics(propensity.confusion(_rule_predictions(lake)))


@query("ml_label_balance")
def _(lake):
    return propensity.label_balance(lake.behaviour)


@query("ml_describe")
def _(lake):
    return propensity.describe(lake.behaviour)


# --- data quality --------------------------------------------------------------------
@query("dq_not_null")
def _(lake):
    return quality.not_null(
        lake.staged("customers"),
        ["customer_id", "email", "gender", "tire", "address", "created_at"],
        "customers",
    )


@query("dq_unique")
def _(lake):
    return quality.unique(lake.staged("order_items"), ["order_item_id"])


@query("dq_unique_composite")
def _(lake):
    return quality.unique(lake.staged("order_items"), ["order_id", "product_id"])


@query("dq_accepted_values")
def _(lake):
    return quality.accepted_values(lake.staged("customers"), "tire", schemas.TIERS)


def _relations(lake):
    return [
        ("fact_order.customer", lake.fact_order, "customer_key", lake.customers, "customer_id"),
        ("fact_order.payment", lake.fact_order, "payment_method_key",
         lake.payment_methods, "payment_method_id"),
        ("fact_order.date", lake.fact_order, "date_key", lake.order_days, "date_key"),
        ("fact_items.order", lake.fact_order_items, "order_id", lake.fact_order, "order_id"),
        ("fact_items.customer", lake.fact_order_items, "customer_key",
         lake.customers, "customer_id"),
        ("fact_items.product", lake.fact_order_items, "product_key",
         lake.dim_product, "product_id"),
        ("fact_items.payment", lake.fact_order_items, "payment_method_key",
         lake.payment_methods, "payment_method_id"),
        ("fact_items.date", lake.fact_order_items, "order_date_key", lake.order_days, "date_key"),
        ("orders.customer", lake.orders, "customer_id", lake.customers, "customer_id"),
        ("orders.payment", lake.orders, "payment_method_id",
         lake.payment_methods, "payment_method_id"),
        ("items.order", lake.order_items, "order_id", lake.orders, "order_id"),
        ("items.product", lake.order_items, "product_id", lake.products, "product_id"),
        ("products.category", lake.products, "category_id", lake.categories, "category_id"),
        ("products.brand", lake.products, "brand_id", lake.brands, "brand_id"),
        ("actions.session", lake.actions, "session_id", lake.sessions, "session_id"),
    ]


@query("dq_relationships")
def _(lake):
    return quality.relationship_counts(_relations(lake))


@query("dq_orphans")
def _(lake):
    """Customers that never visited the web shop, seen as a foreign key without a match."""
    return quality.relationships(lake.customers, "customer_id", lake.sessions, "user_id")


@query("dq_positive_revenue")
def _(lake):
    tables = {
        "fact_order": (lake.fact_order, "order_id"),
        "fact_order_items": (lake.fact_order_items, "order_item_id"),
    }
    return quality.non_negative(tables, ["sub_total", "price", "discount_amt"])


@query("dq_order_total_reconcile")
def _(lake):
    return quality.order_total_reconcile(lake.orders, lake.order_items)


@query("dq_temporal_range")
def _(lake):
    return quality.temporal_range(
        lake.orders, "order_id", "order_date", "1996-01-01", "2000-12-31"
    )


@query("dq_domain")
def _(lake):
    regions = kpis.region_map(lake.spark)
    return quality.domain(lake.customers, "address", regions, "address")


@query("dq_session_coherence")
def _(lake):
    return quality.session_coherence(lake.staged("clickstream"))


@query("dq_landing_counts")
def _(lake):
    """Sessions kept after dedup against records delivered, per day."""
    staged = lake.staged("clickstream")
    delivered = staged.groupBy("ingest_date").agg(F.count("event_id").alias("expected_rows"))
    return quality.landing_counts(silver.latest_sessions(staged.drop("actions")), delivered)


def declared_tables(lake) -> dict[str, DataFrame]:
    """Every table with declared rules, with the times that a job stores with it."""
    found = {
        "stg_brands": lake.staged("brands"), "stg_categories": lake.staged("category"),
        "stg_payment_methods": lake.staged("payment_method"), "stg_customers": lake.staged("customers"),
        "stg_products": lake.staged("products"), "stg_orders": lake.staged("orders"),
        "stg_order_items": lake.staged("order_items"), "stg_clickstream_events": lake.staged("clickstream"),
        "silver_brands": lake.brands, "silver_categories": lake.categories,
        "silver_payment_methods": lake.payment_methods, "silver_customers": lake.customers,
        "silver_products": lake.products, "silver_orders": lake.orders, "silver_order_items": lake.order_items,
        "silver_user_sessions": lake.sessions, "silver_session_actions": lake.actions,
        "dim_customer": lake.dim_customer, "dim_date": lake.order_days,
        "dim_payment_method": lake.dim_payment_method, "dim_product": lake.dim_product,
        "fact_order": lake.fact_order, "fact_order_items": lake.fact_order_items,
        "user_behavior_3d": lake.behaviour, "campaign": _rule_campaign(lake),
    }
    for name, df in found.items():
        for c in rules.DECLARED[name].not_null:
            if c in rules.AUDIT and c not in df.columns:
                found[name] = with_audit(found[name], c)
    return found


@query("dq_declared_rules")
def _(lake):
    return rules.check_all(declared_tables(lake))


@query("dq_report")
def _(lake):
    staged = lake.staged("customers")
    return quality.report(
        {
            "order_item_id unique": quality.unique(
                lake.staged("order_items"), ["order_item_id"]
            ),
            "clean order_item_id unique": quality.unique(lake.order_items, ["order_item_id"]),
            "one feature row per user and day": quality.unique(
                lake.behaviour, ["user_id", "prediction_date"]
            ),
            "tier known": quality.accepted_values(staged, "tire", schemas.TIERS),
            "clean tier known": quality.accepted_values(lake.customers, "tire", schemas.TIERS),
            "device known": quality.accepted_values(
                lake.staged("clickstream"), "device_type", schemas.DEVICE_TYPES
            ),
            "segment known": quality.accepted_values(
                lake.staged("clickstream"), "user_segment", schemas.USER_SEGMENTS
            ),
            "order total matches lines": quality.order_total_reconcile(
                lake.orders, lake.order_items
            ),
            "sessions coherent": quality.session_coherence(lake.staged("clickstream")),
        }
    )


# --- masking -------------------------------------------------------------------------
_CONTACT = ["customer_id", "first_name", "last_name", "email", "phone_number", "tire", "address"]


@query("mask_email")
def _(lake):
    return masking.mask(lake.customers.select("customer_id", "email"), {"email": masking.HASH})


@query("mask_phone")
def _(lake):
    people = lake.staged("customers").select("customer_id", "phone_number")
    return masking.mask(people, {"phone_number": masking.SHOW_LAST_4})


@query("mask_generic")
def _(lake):
    return masking.mask(
        lake.customers.select(*_CONTACT),
        {"email": masking.REDACT, "address": masking.REDACT, "phone_number": masking.NULLIFY},
    )


PRIVILEGED = masking.Subjects.of(["admin", "compliance_officer"], ["admins", "compliance_team"])
RESTRICTED = masking.Subjects.of(groups=["analysts", "general_users"])
CONTACT_POLICIES = [
    masking.MaskPolicy("email", [(RESTRICTED, masking.HASH)], PRIVILEGED),
    masking.MaskPolicy("phone_number", [(RESTRICTED, masking.SHOW_LAST_4)], PRIVILEGED),
]


@query("mask_persona_view")
def _(lake):
    """The same table as an analyst and as an administrator see it."""
    people = lake.customers.select(*_CONTACT)
    analyst = masking.masked_view(people, CONTACT_POLICIES, "lan", ["analysts"])
    admin = masking.masked_view(people, CONTACT_POLICIES, "admin", ["analysts"])
    return analyst.withColumn("persona", F.lit("analyst")).unionByName(
        admin.withColumn("persona", F.lit("admin"))
    )


# --- streaming -----------------------------------------------------------------------
def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@query("ingest_clickstream_stream")
def _(lake):
    path = workspace(lake.spark, "landing")
    raw = warehouse.stream_raw(lake.spark, lake.folder)
    _run(ingest.land_clickstream(raw, path, workspace(lake.spark, "checkpoint")))
    landed = files.read_clickstream(lake.spark, path)
    return landed.groupBy("ingest_date").agg(
        F.count("event_id").alias("records"), F.sum(F.size("actions")).alias("actions")
    )


def _session_log(lake) -> SessionLog:
    raw = warehouse.stream_raw(lake.spark, lake.folder)
    return SessionLog(lake.spark, raw, workspace(lake.spark, "session-log"))


@query("stream_dedup_sessions")
def _(lake):
    log = _session_log(lake)
    _run(log.land())
    _run(log.close())
    return silver.silver_user_sessions(log.sessions())


@query("stream_daily_activity")
def _(lake):
    log = _session_log(lake)
    log.run()
    return log.days()


@query("stream_campaign_upsert")
def _(lake):
    """Feature rows arrive as files; each batch is scored and merged into the campaign."""
    feats = workspace(lake.spark, "feature-files")
    lake.behaviour.write.parquet(feats)
    arriving = lake.spark.readStream.schema(lake.behaviour.schema).parquet(feats)
    path = workspace(lake.spark, "campaign")

    def score(batch: DataFrame) -> DataFrame:
        return campaign.campaign(campaign.score_rule(batch), lake.customers)

    _run(
        ingest.upsert_stream(
            arriving, score, path, workspace(lake.spark, "checkpoint"),
            campaign.CAMPAIGN_KEY, sinks.YMD,
        )
    )
    schema = _rule_campaign(lake).schema
    return lake.spark.read.schema(schema).parquet(path)
