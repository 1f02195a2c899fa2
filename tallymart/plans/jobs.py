"""End-to-end jobs: build and store the tables, train the model, score the campaign."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import with_audit
from ..operators import campaign, propensity, quality
from ..session import materialise
from ..sources import sinks
from .lakehouse import Lakehouse

SILVER = [
    "brands", "categories", "payment_methods", "customers", "products", "orders",
    "order_items", "sessions", "actions",
]
GOLD = [
    "dim_customer", "dim_date", "dim_payment_method", "dim_product", "fact_order",
    "fact_order_items", "behaviour",
]
PARTITIONED = {"sessions", "actions"}


def store(lake: Lakehouse, name: str, root: str) -> DataFrame:
    """Write one table below ``root`` with its load time and put the stored copy in its place.

    Tables built afterwards read the files, so no step is computed twice and the
    lineage of each job stays short.
    """
    df = getattr(lake, name)
    path = f"{root.rstrip('/')}/{name}"
    audited = with_audit(df, "_transformed_at" if name in SILVER else "_created_at")
    if name in PARTITIONED:
        sinks.write_partitioned(audited, path)
    else:
        audited.write.mode("overwrite").parquet(path)
    stored = lake.spark.read.schema(df.schema).parquet(path)
    lake.__dict__[name] = stored
    return stored


def build_tables(spark: SparkSession, folder: str, root: str) -> Lakehouse:
    """Build all silver and gold tables from the raw folder and store them below ``root``."""
    lake = Lakehouse(spark, folder)
    for name in [*SILVER, *GOLD]:
        store(lake, name, root)
    return lake


def check_tables(lake: Lakehouse) -> DataFrame:
    """Violation counts of the stored tables' main assertions."""
    return quality.report(
        {
            "orders unique": quality.unique(lake.orders, ["order_id"]),
            "lines unique": quality.unique(lake.order_items, ["order_item_id"]),
            "sessions unique": quality.unique(lake.sessions, ["session_id"]),
            "actions unique": quality.unique(lake.actions, ["action_id"]),
            "lines have orders": quality.relationships(
                lake.order_items, "order_id", lake.orders, "order_id"
            ),
            "actions have sessions": quality.relationships(
                lake.actions, "session_id", lake.sessions, "session_id"
            ),
            "money not negative": quality.non_negative(
                {
                    "fact_order": (lake.fact_order, "order_id"),
                    "fact_order_items": (lake.fact_order_items, "order_item_id"),
                },
                ["sub_total", "price", "discount_amt"],
            ),
        }
    )


def train_model(features: DataFrame, path: str) -> DataFrame:
    """Split, scale, train, evaluate; models and metrics are stored below ``path``."""
    spark = features.sparkSession
    feats = materialise(spark, features, "features")
    train, test = propensity.split(feats)
    vectors, scaler = propensity.prepare(train)
    model = propensity.train(vectors)
    scored = materialise(spark, propensity.score(test, scaler, model), "scored")
    metrics = propensity.evaluate(scored)
    propensity.save(scaler, model, path)
    sinks.write_metrics(metrics, f"{path}/metrics")
    return metrics


def score_campaign(
    features: DataFrame,
    customers: DataFrame | None,
    model_path: str,
    table: str,
    prediction_date: str | None = None,
) -> DataFrame:
    """Score one day (or all), add contacts and merge the leads into the campaign table."""
    spark = features.sparkSession
    if prediction_date:
        features = features.filter(F.col("prediction_date") == F.lit(prediction_date).cast("date"))
    scaler, model = propensity.load(model_path)
    leads = campaign.campaign(propensity.score(features, scaler, model), customers)
    sinks.upsert_partitioned(spark, table, leads, campaign.CAMPAIGN_KEY)
    return spark.read.schema(leads.schema).parquet(table)
