"""Typed, trimmed projections of the raw tables. Bad values become null, never an error."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ACTIONS, DEVICE, LOCATION, MONEY, PROPERTIES, SESSION_METRICS, TOTAL


@dataclass(frozen=True)
class Field:
    """One staged column: source column, target type and text clean-up."""

    name: str
    type: str = "string"
    trim: bool = False
    lower: bool = False
    source: str | None = None

    def column(self) -> Column:
        value = F.col(self.source or self.name).try_cast(self.type)
        if self.trim:
            value = F.trim(value)
        if self.lower:
            value = F.lower(value)
        return value.alias(self.name)


def _text(*names: str) -> list[Field]:
    return [Field(n, trim=True) for n in names]


_TIMES = [Field("created_at", "timestamp"), Field("updated_at", "timestamp")]

STAGING: dict[str, list[Field]] = {
    "brands": _text("brand_id", "brand_name", "brand_origin"),
    "category": [
        Field("category_id", "int"), *_text("category_display_name", "category_description"),
    ],
    "payment_method": [
        Field("payment_method_id", "int"), *_text("display_name", "type", "provider"),
    ],
    "customers": [
        Field("customer_id", "bigint"),
        *_text("first_name", "last_name"),
        Field("email", trim=True, lower=True),
        *_text("phone_number", "gender"),
        Field("tire", trim=True, lower=True),
        *_text("address"),
        *_TIMES,
    ],
    "products": [
        Field("product_id", "bigint"),
        *_text("product_name", "product_description"),
        Field("price", MONEY),
        Field("category_id", "int"),
        *_text("brand_id"),
        *_TIMES,
    ],
    "orders": [
        Field("order_id", "bigint"),
        Field("customer_id", "bigint"),
        Field("order_timestamp", "timestamp", source="order_date"),
        Field("order_date", "date"),
        Field("total_amount", MONEY),
        Field("payment_method_id", "int"),
        *_TIMES,
    ],
    "order_items": [
        Field("order_item_id", "bigint"),
        Field("order_id", "bigint"),
        Field("product_id", "bigint"),
        Field("quantity", "int"),
        Field("price", MONEY),
        Field("discount", MONEY),
    ],
}


def stage(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    return df.select(*[f.column() for f in fields])


def line_total() -> Column:
    """Quantity times price less discount. It may be negative; silver floors it at zero."""
    gross = F.col("quantity") * F.col("price")
    return (gross - F.coalesce("discount", F.lit(0))).cast(TOTAL)


def stage_order_items(df: DataFrame) -> DataFrame:
    staged = stage(df, STAGING["order_items"])
    return staged.withColumns(
        {
            "discount": F.coalesce("discount", F.lit(0).cast(MONEY)),
            "line_total_amount": line_total(),
        }
    )


def _parsed(df: DataFrame, name: str, ddl: str) -> Column:
    """A nested column: as it is, or parsed once with its declared schema if it is JSON text."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.from_json(name, ddl)
    return F.col(name)


def stage_clickstream(df: DataFrame) -> DataFrame:
    """Flatten raw clickstream records; ``actions`` stays an array for the explode step."""
    nested = {
        "device": DEVICE,
        "location": LOCATION,
        "session_metrics": SESSION_METRICS,
        "properties": PROPERTIES,
        "actions": ACTIONS,
    }
    parsed = df.withColumns({c: _parsed(df, c, ddl) for c, ddl in nested.items()})
    when = F.col("timestamp").try_cast("timestamp")
    landed = F.col("ingest_date").try_cast("date") if "ingest_date" in df.columns else F.lit(None)
    return parsed.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("session_id").cast("string").alias("session_id"),
        when.alias("event_timestamp"),
        when.cast("date").alias("event_date"),
        F.col("user_id").try_cast("bigint").alias("user_id"),
        F.col("user_segment"),
        F.col("device.type").alias("device_type"),
        F.col("device.os").alias("device_os"),
        F.col("device.browser").alias("device_browser"),
        F.col("device.version").alias("device_version"),
        F.col("location.city").alias("city"),
        F.col("location.country").alias("country"),
        F.col("location.coordinates.lat").alias("latitude"),
        F.col("location.coordinates.lon").alias("longitude"),
        F.col("referrer"),
        F.col("referrer_type"),
        F.col("source").alias("utm_source"),
        F.col("campaign").alias("utm_campaign"),
        F.col("session_metrics.duration_seconds").alias("duration_seconds"),
        F.col("session_metrics.page_views").alias("page_views"),
        F.col("session_metrics.actions_count").alias("actions_count"),
        F.coalesce("session_metrics.has_purchase", F.lit(False)).alias("has_purchase"),
        F.coalesce(
            F.col("session_metrics.revenue").try_cast(MONEY), F.lit(0).cast(MONEY)
        ).alias("revenue"),
        F.coalesce("properties.is_mobile", F.col("device.type") == "mobile").alias("is_mobile"),
        F.col("properties.language").alias("language"),
        F.col("properties.ab_test").alias("ab_test"),
        F.col("actions"),
        F.coalesce(landed.cast("date"), when.cast("date")).alias("ingest_date"),
    )
