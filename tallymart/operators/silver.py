"""Deduplicated, sanitised tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import digits_only, pick, with_ymd
from ..schemas import FLAGGED_ACTIONS, GENDER_SYNONYMS, MONEY, TIERS, TOTAL
from .dedup import dedup_latest
from .staging import line_total


def _newest() -> list[Column]:
    return [F.col("updated_at").desc_nulls_last(), F.col("created_at").desc_nulls_last()]


def silver_brands(staged: DataFrame) -> DataFrame:
    present = staged.filter(F.length("brand_id") > 0)
    return dedup_latest(present, ["brand_id"]).withColumn(
        "brand_origin", F.coalesce("brand_origin", F.lit("Unknown"))
    )


def silver_categories(staged: DataFrame) -> DataFrame:
    return dedup_latest(staged.filter("category_id is not null"), ["category_id"])


def silver_payment_methods(staged: DataFrame) -> DataFrame:
    return dedup_latest(staged.filter("payment_method_id is not null"), ["payment_method_id"])


def silver_customers(staged: DataFrame, genders: dict[str, list[str]] | None = None) -> DataFrame:
    """Latest row per customer with normalised phone, gender and loyalty tier."""
    tier = F.lower("tire")
    return dedup_latest(staged, ["customer_id"], _newest()).withColumns(
        {
            "email": F.lower("email"),
            "phone_number": digits_only(F.col("phone_number"), 9),
            "gender": pick(F.col("gender"), genders or GENDER_SYNONYMS, "Other"),
            "tire": F.when(tier.isin(TIERS), tier).otherwise("bronze"),
        }
    )


def silver_products(staged: DataFrame) -> DataFrame:
    return dedup_latest(staged, ["product_id"], _newest()).filter("price > 0")


def silver_orders(staged: DataFrame) -> DataFrame:
    known = staged.filter("order_id is not null").drop("order_timestamp")
    return dedup_latest(known, ["order_id"], _newest()).filter("total_amount >= 0")


def silver_order_items(staged: DataFrame) -> DataFrame:
    """One row per line, valid lines only, line total floored at zero."""
    known = staged.filter("order_item_id is not null").drop("line_total_amount")
    floored = F.greatest(line_total(), F.lit(0).cast(TOTAL))
    return (
        dedup_latest(known, ["order_item_id"])
        .filter("quantity > 0 and price >= 0")
        .withColumn("line_total_amount", floored)
    )


def latest_sessions(staged: DataFrame) -> DataFrame:
    """The newest record of every session, still carrying its action array."""
    known = staged.filter("session_id is not null")
    return dedup_latest(known, ["session_id"], [F.col("event_timestamp").desc_nulls_last()])


def silver_user_sessions(staged: DataFrame) -> DataFrame:
    slim = staged.drop("actions", "event_date", "device_version", "ingest_date")
    latest = latest_sessions(slim).withColumnsRenamed(
        {"event_timestamp": "timestamp", "device_browser": "browser"}
    )
    return with_ymd(latest, "timestamp").drop("event_id")


def silver_session_actions(staged: DataFrame) -> DataFrame:
    """One row per action of every deduplicated session.

    All actions of a session sit in one record's array, so ordering and numbering
    them is done inside the row: no shuffle beyond the session dedup. ``user_id`` is
    carried along, which spares later steps the join back to the sessions.
    """
    sessions = latest_sessions(
        staged.select("session_id", "event_timestamp", "event_id", "user_id", "actions")
    ).filter(F.size("actions") > 0)
    # an entry without content is no action, as in the daily totals
    ordered = F.array_sort(
        F.transform(
            F.filter("actions", lambda a: a.isNotNull()),
            lambda a, i: F.struct(
                F.coalesce(a["time_offset"], F.lit(0)).alias("offset"),
                F.trim(a["type"]).alias("kind"),
                i.alias("position"),
                a.alias("act"),
            ),
        )
    )
    rows = sessions.select(
        "session_id", "user_id", "event_timestamp", F.posexplode(ordered).alias("pos", "item")
    )
    kind = F.col("item.act.type")
    price = F.col("item.act.price").try_cast(MONEY)
    # whole seconds, as the action offset is a whole number of seconds
    happened = F.timestamp_seconds(F.unix_timestamp("event_timestamp") + F.col("item.offset"))
    flags = [
        F.when(kind == a, 1).otherwise(0).cast("int").alias(f"is_{a}") for a in FLAGGED_ACTIONS
    ]
    return rows.select(
        F.concat("session_id", F.lit("-act-"), (F.col("pos") + 1).cast("string")).alias("action_id"),
        "session_id",
        "user_id",
        happened.alias("action_timestamp"),
        F.col("item.kind").alias("action_type"),
        F.col("item.act.product_id").alias("product_id"),
        F.trim("item.act.search_term").alias("search_term"),
        F.trim("item.act.order_id").alias("order_id"),
        F.when(kind == "purchase", F.coalesce(price, F.lit(0).cast(MONEY)))
        .otherwise(F.lit(0).cast(MONEY))
        .alias("revenue"),
        price.alias("product_price"),
        F.trim("item.act.category").alias("product_category"),
        *flags,
        F.year("event_timestamp").alias("year"),
        F.month("event_timestamp").alias("month"),
        F.dayofmonth("event_timestamp").alias("day"),
    )
