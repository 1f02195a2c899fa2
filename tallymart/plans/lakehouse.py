"""The table graph raw -> staging -> silver -> gold as lazy DataFrames.

Every property is a plan, nothing runs until a sink or an action asks. Column
pruning and filters reach the parquet scans through the whole chain.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, silver, staging, star
from ..sources import warehouse

CALENDAR = ("1990-01-01", "2030-12-31")


class Lakehouse:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._raw = warehouse.read_raw(spark, folder)

    def raw(self, name: str) -> DataFrame:
        return self._raw[name]()

    def staged(self, name: str) -> DataFrame:
        if name == "order_items":
            return staging.stage_order_items(self.raw(name))
        if name == "clickstream":
            return staging.stage_clickstream(self.raw(name))
        return staging.stage(self.raw(name), staging.STAGING[name])

    # --- silver
    @cached_property
    def brands(self) -> DataFrame:
        return silver.silver_brands(self.staged("brands"))

    @cached_property
    def categories(self) -> DataFrame:
        return silver.silver_categories(self.staged("category"))

    @cached_property
    def payment_methods(self) -> DataFrame:
        return silver.silver_payment_methods(self.staged("payment_method"))

    @cached_property
    def customers(self) -> DataFrame:
        return silver.silver_customers(self.staged("customers"))

    @cached_property
    def products(self) -> DataFrame:
        return silver.silver_products(self.staged("products"))

    @cached_property
    def orders(self) -> DataFrame:
        return silver.silver_orders(self.staged("orders"))

    @cached_property
    def order_items(self) -> DataFrame:
        return silver.silver_order_items(self.staged("order_items"))

    @cached_property
    def sessions(self) -> DataFrame:
        return silver.silver_user_sessions(self.staged("clickstream"))

    @cached_property
    def actions(self) -> DataFrame:
        return silver.silver_session_actions(self.staged("clickstream"))

    # --- gold
    @cached_property
    def dim_customer(self) -> DataFrame:
        return star.dim_customer(self.customers)

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.calendar(self.spark, *CALENDAR)

    @cached_property
    def order_days(self) -> DataFrame:
        """The calendar of the reports: from the first to the last day with an order."""
        days = self.orders.select(F.to_date("order_date").alias("day"))
        return star.calendar_covering(days, "day")

    @cached_property
    def dim_payment_method(self) -> DataFrame:
        return star.dim_payment_method(self.payment_methods)

    @cached_property
    def dim_product(self) -> DataFrame:
        return star.dim_product(
            self.products, self.categories, self.brands, raw_keys=self.raw("products")
        )

    @cached_property
    def fact_order(self) -> DataFrame:
        return star.fact_order(self.orders, self.order_items)

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return star.fact_order_items(
            self.order_items, self.orders, raw_keys=self.raw("order_items")
        )

    @cached_property
    def item_product_keys(self) -> DataFrame:
        """Product key of every raw line: the cheap input of hot-product detection."""
        return self.raw("order_items").selectExpr("product_id as product_key")

    @cached_property
    def _slim_log(self) -> DataFrame:
        """The columns of the staged log that daily activity needs."""
        return self.staged("clickstream").select(
            "session_id", "event_timestamp", "event_id", "user_id", "duration_seconds",
            "page_views", "actions_count", "has_purchase", "revenue", "actions",
        )

    # --- features
    @cached_property
    def activity(self) -> DataFrame:
        return features.activity_from_log(silver.latest_sessions(self._slim_log))

    @cached_property
    def rolling(self) -> DataFrame:
        return features.rolling_3d(self.activity)

    @cached_property
    def behaviour(self) -> DataFrame:
        return features.behaviour_features(self.rolling)
