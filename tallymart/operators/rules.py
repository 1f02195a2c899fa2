"""Declared column rules of all tables, compiled into one aggregate per table.

A table's rules - columns that must not be null, keys that must be unique, columns with a
vocabulary - become one ``agg``: counts of nulls and of strange values, and for each key the rows with it
less its distinct values. The table is read once. Keys are counted distinct with partial
aggregation before the shuffle, so a key that repeats a million times moves as a few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DEVICE_TYPES, LEAD_TIERS, TIERS, USER_SEGMENTS

RESULT = "table_name string, rule string, column_name string, rows_checked bigint, violations bigint"


@dataclass(frozen=True)
class Rules:
    """not_null: columns; unique: keys, each a tuple of columns; accepted: column to its values."""

    not_null: Sequence[str] = ()
    unique: Sequence[tuple[str, ...]] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)

    def count(self) -> int:
        return len(self.not_null) + len(self.unique) + len(self.accepted)


def _rules(not_null: str, unique: str = "", accepted: Mapping[str, Sequence] | None = None) -> Rules:
    keys = [tuple(k.split("+")) for k in unique.split()]
    return Rules(not_null.split(), keys, accepted or {})


# The rules declared for each table, columns in the order of the table. Keys of
# several columns are written with a plus; those two are documented, not declared.
DECLARED: dict[str, Rules] = {
    "stg_brands": _rules("brand_id brand_name _ingested_at", "brand_id"),
    "stg_categories": _rules("category_id category_display_name _ingested_at", "category_id"),
    "stg_payment_methods": _rules("payment_method_id display_name type _ingested_at", "payment_method_id"),
    "stg_customers": _rules("customer_id first_name last_name tire created_at _ingested_at", "customer_id"),
    "stg_products": _rules(
        "product_id product_name price category_id brand_id created_at _ingested_at", "product_id"
    ),
    "stg_orders": _rules(
        "order_id customer_id order_timestamp order_date total_amount payment_method_id created_at _ingested_at",
        "order_id",
    ),
    "stg_order_items": _rules(
        "order_item_id order_id product_id quantity price discount line_total_amount _ingested_at", "order_item_id"
    ),
    "stg_clickstream_events": _rules(
        "event_id session_id event_timestamp event_date device_os device_browser city country latitude longitude"
        " duration_seconds page_views actions_count has_purchase revenue actions _ingested_at",
        "event_id",
        {"user_segment": USER_SEGMENTS, "device_type": DEVICE_TYPES},
    ),
    "silver_brands": _rules("brand_id brand_name brand_origin _transformed_at", "brand_id"),
    "silver_categories": _rules("category_id category_display_name _transformed_at", "category_id"),
    "silver_payment_methods": _rules("payment_method_id display_name type _transformed_at", "payment_method_id"),
    "silver_customers": _rules(
        "customer_id first_name last_name tire created_at _transformed_at", "customer_id",
        {"gender": ["Nam", "Nu", "Other"], "tire": TIERS},
    ),
    "silver_products": _rules(
        "product_id product_name price category_id brand_id created_at _transformed_at", "product_id"
    ),
    "silver_orders": _rules(
        "order_id customer_id order_date total_amount payment_method_id created_at _transformed_at", "order_id"
    ),
    "silver_order_items": _rules(
        "order_item_id order_id product_id quantity price discount line_total_amount _transformed_at",
        "order_item_id",
    ),
    "silver_user_sessions": _rules(
        "session_id timestamp duration_seconds page_views actions_count has_purchase revenue year month day"
        " _transformed_at",
        "session_id",
    ),
    "silver_session_actions": _rules(
        "action_id session_id action_timestamp action_type is_view is_add_to_cart is_purchase is_search is_wishlist"
        " is_review is_remove_from_cart is_checkout_view year month day _transformed_at",
        "action_id",
    ),
    "dim_customer": _rules("customer_id first_name last_name tire _created_at", "customer_id"),
    "dim_date": _rules(
        "date_key calendar_date year month month_year quarter quarter_name quarter_year month_name day_name"
        " is_weekend is_weekday _created_at",
        "date_key calendar_date",
        {"is_weekend": [0, 1], "is_weekday": [0, 1]},
    ),
    "dim_payment_method": _rules(
        "payment_method_id display_name type effective_start_date is_current _created_at", "payment_method_id"
    ),
    "dim_product": _rules("product_id product_name unit_price category brand_name _created_at", "product_id"),
    "fact_order": _rules(
        "order_id customer_key payment_method_key date_key quantity price discount_amt sub_total _created_at",
        "order_id",
    ),
    "fact_order_items": _rules(
        "order_item_id order_id customer_key product_key payment_method_key order_date_key quantity price"
        " discount_amt sub_total _created_at",
        "order_item_id",
    ),
    "user_behavior_3d": _rules(
        "user_id prediction_date label_purchase_tomorrow sessions_3d total_duration_3d avg_session_duration_3d"
        " total_page_views_3d total_actions_3d purchase_sessions_3d total_revenue_3d view_count_3d"
        " add_to_cart_count_3d purchase_count_3d search_count_3d wishlist_count_3d checkout_view_count_3d"
        " distinct_products_3d avg_product_price_3d cart_conversion_rate_3d purchase_conversion_rate_3d"
        " actions_per_session_3d purchase_session_rate_3d _created_at",
        "user_id+prediction_date",
        {"label_purchase_tomorrow": [0, 1]},
    ),
    "campaign": _rules(
        "customer_id campaign_date purchase_probability customer_segment campaign_action campaign_channel"
        " predicted_at created_at",
        "customer_id+campaign_date",
        {"customer_segment": [t[1] for t in LEAD_TIERS], "campaign_channel": [t[3] for t in LEAD_TIERS]},
    ),
}
#: Columns that a job adds when it stores a table.
AUDIT = ("_ingested_at", "_transformed_at", "_created_at", "predicted_at", "created_at")


def _surplus(key: Sequence[str]) -> Column:
    """Rows with the key less its distinct values; a key with a null part does not count."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    value = F.col(key[0]) if len(key) == 1 else F.when(known, F.struct(*key))
    return F.count(value) - F.count_distinct(value)


def check(df: DataFrame, rules: Rules, table: str) -> DataFrame:
    """One row per rule: rows checked and violations. Null passes a vocabulary."""
    wanted = [("not_null", c, F.count_if(F.col(c).isNull())) for c in rules.not_null]
    wanted += [("unique", "+".join(key), _surplus(key)) for key in rules.unique]
    wanted += [
        ("accepted_values", c, F.count_if(~F.col(c).isin(list(values)))) for c, values in rules.accepted.items()
    ]
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_checked"), *[count.alias(f"v{k}") for k, (_, _, count) in enumerate(wanted)]
    )
    entries = [
        F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("column_name"), F.col(f"v{k}").alias("violations"))
        for k, (rule, name, _) in enumerate(wanted)
    ]
    rows = counted.select("rows_checked", F.inline(F.array(*entries)))
    return rows.select(F.lit(table).alias("table_name"), "rule", "column_name", "rows_checked", "violations")


def check_all(tables: Mapping[str, DataFrame], declared: Mapping[str, Rules] = DECLARED) -> DataFrame:
    """The rules of all ``tables``; each is read once."""
    parts = [check(df, declared[name], name) for name, df in tables.items() if declared[name].count()]
    return reduce(DataFrame.unionByName, parts)
