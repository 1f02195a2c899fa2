"""Lead scoring, segmentation and the campaign table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import half_up, ratio, with_ymd
from ..schemas import LEAD_TIERS, RULE_INTERCEPT, RULE_WEIGHTS

CAMPAIGN_KEY = ["customer_id", "campaign_date"]


def score_rule(
    features: DataFrame,
    weights: Mapping[str, float] = RULE_WEIGHTS,
    intercept: float = RULE_INTERCEPT,
) -> DataFrame:
    """Purchase probability from fixed log-odds weights, four decimals."""
    logit = F.lit(intercept)
    for name, weight in weights.items():
        logit = logit + F.lit(weight) * F.coalesce(F.col(name).cast("double"), F.lit(0.0))
    probability = half_up(F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)), 4)
    return features.withColumn("purchase_probability", probability)


def _tier_value(probability: Column, tiers: Sequence[tuple], field: int) -> Column:
    *bounded, last = tiers
    out = F
    for tier in bounded:
        out = out.when(probability >= tier[0], tier[field])
    return out.otherwise(last[field])


def segment(df: DataFrame, tiers: Sequence[tuple] = LEAD_TIERS) -> DataFrame:
    """Segment, action and channel by the tier the probability falls in."""
    p = F.col("purchase_probability")
    names = ["customer_segment", "campaign_action", "campaign_channel"]
    return df.withColumns({n: _tier_value(p, tiers, i) for i, n in enumerate(names, start=1)})


def campaign(scored: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Segmented leads with contact data; unknown customers keep neutral names."""
    leads = segment(
        scored.select(
            F.col("user_id").cast("bigint").alias("customer_id"),
            F.col("prediction_date").alias("campaign_date"),
            half_up(F.col("purchase_probability"), 4).alias("purchase_probability"),
        )
    )
    if customers is None:
        nothing = F.lit(None).cast("string")
        contacts = leads.withColumns(
            {"first_name": nothing, "last_name": nothing, "email": nothing, "phone": nothing}
        )
    else:
        people = customers.select(
            "customer_id", "first_name", "last_name", "email", F.col("phone_number").alias("phone")
        )
        # one lead per customer and day: a customer adds at most one row per day here
        contacts = leads.join(people, "customer_id", "left")
    named = contacts.withColumns(
        {
            "first_name": F.coalesce("first_name", F.lit("Unknown")),
            "last_name": F.coalesce("last_name", F.lit("Customer")),
        }
    )
    return with_ymd(named, "campaign_date")


def campaign_metrics(campaigns: DataFrame) -> DataFrame:
    """Leads, share and mean probability per segment."""
    report = campaigns.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("lead_count"),
        F.sum(F.col("purchase_probability").cast("decimal(9,4)")).alias("_sum"),
    )
    # a handful of segments: the window over the report is a total of a few rows
    total = F.sum("lead_count").over(Window.partitionBy())
    return report.select(
        "customer_segment",
        "lead_count",
        half_up(F.col("lead_count") / total * 100, 2).alias("percentage"),
        ratio(F.col("_sum"), F.col("lead_count"), 4).alias("avg_probability"),
    )
