"""Business metrics over the star schema.

The common shape: combine the fact per dimension key first (map-side, so a hot key
costs nothing extra), then join the small dimension, then roll up to the reporting
grain. Order counts stay additive because the order fact has one row per order and
every order has one date, customer and payment method.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import percent, ratio
from ..schemas import (
    DELIVERY_DEFAULT, DELIVERY_TIERS, REGION_PROVINCES, SOUTH, TOTAL,
)
from .skew import salted_join

UNKNOWN_PROVINCE = "Unknown Province"


# --- reusable steps ------------------------------------------------------------------
def order_totals(fact: DataFrame, *keys: str) -> DataFrame:
    """Additive measures of the order fact per key."""
    return fact.groupBy(*keys).agg(
        F.count("order_id").alias("orders"),
        F.sum("quantity").alias("units"),
        F.sum("price").cast(TOTAL).alias("gross"),
        F.sum("discount_amt").cast(TOTAL).alias("discount"),
        F.sum("sub_total").cast(TOTAL).alias("net"),
    )


def roll_up(totals: DataFrame, *keys: str, **more: Column) -> DataFrame:
    """Add up measures made by ``order_totals`` to a coarser grain."""
    sums = [F.sum(c).alias(c) for c in ("orders", "units")]
    money = [F.sum(c).cast(TOTAL).alias(c) for c in ("gross", "discount", "net")]
    return totals.groupBy(*keys).agg(*sums, *money, *[v.alias(k) for k, v in more.items()])


def aov() -> Column:
    return ratio(F.col("net"), F.col("orders"))


def growth(value: str, order: Sequence[str], lag: int = 1) -> Column:
    """Percent change of ``value`` against the row ``lag`` steps before.

    For reports already aggregated to calendar periods: the window is unpartitioned.
    """
    prev = F.lag(value, lag).over(Window.orderBy(*order))
    return percent(F.col(value) - prev, prev)


def moving_avg(value: str, order: Sequence[str], rows: int = 7) -> Column:
    """Mean over the current and the preceding ``rows - 1`` rows of a calendar report."""
    frame = Window.orderBy(*order).rowsBetween(1 - rows, 0)
    return ratio(F.sum(value).over(frame), F.count(value).over(frame))


def share(value: str, within: Sequence[str] = ()) -> Column:
    """Percent of the total (or of the total within a group) of an aggregated report."""
    return percent(F.col(value), F.sum(value).over(Window.partitionBy(*within)))


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def dated(fact: DataFrame, days: DataFrame, *keys: str) -> DataFrame:
    """Order totals per day (and ``keys``) with the calendar columns."""
    return order_totals(fact, "date_key", *keys).join(days, "date_key")


def filter_orders(
    fact: DataFrame,
    start: str | None = None,
    end: str | None = None,
    province: str | None = None,
    customers: DataFrame | None = None,
) -> DataFrame:
    """Dashboard filters on the order fact: date range and customer province."""
    out = fact
    if start:
        out = out.filter(F.col("date_key") >= int(start.replace("-", "")))
    if end:
        out = out.filter(F.col("date_key") <= int(end.replace("-", "")))
    if province:
        ids = customers.filter(F.col("address") == province)
        ids = ids.select(F.col("customer_id").alias("customer_key"))
        out = salted_join(out, ids, ["customer_key"], "inner", ["order_id"])
    return out


def filter_items(
    items: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Date filter on order lines. For a category, hand the report filtered products."""
    out = items
    if start:
        out = out.filter(F.col("order_date_key") >= int(start.replace("-", "")))
    if end:
        out = out.filter(F.col("order_date_key") <= int(end.replace("-", "")))
    return out


# --- executive revenue ---------------------------------------------------------------
def kpi(fact: DataFrame, days: DataFrame) -> DataFrame:
    totals = roll_up(dated(fact, days))
    return totals.select(
        F.col("gross").alias("gross_revenue"),
        F.col("discount").alias("total_discount"),
        F.col("net").alias("net_revenue"),
        percent(F.col("discount"), F.col("gross")).alias("discount_rate_pct"),
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.col("units").alias("total_units_sold"),
        aov().alias("average_order_value"),
        ratio(F.col("units"), F.col("orders")).alias("units_per_transaction"),
    )


def _period(fact: DataFrame, days: DataFrame, *keys: str) -> DataFrame:
    return roll_up(dated(fact, days), *keys).select(
        *keys,
        F.col("net").alias("net_revenue"),
        F.col("orders").alias("order_count"),
        F.col("units").alias("units_sold"),
        aov().alias("aov"),
    )


def monthly_mom(fact: DataFrame, days: DataFrame) -> DataFrame:
    months = _period(fact, days, "year", "month", "month_year", "month_name")
    order = ["year", "month"]
    return months.withColumns(
        {
            "prev_month_revenue": F.lag("net_revenue").over(Window.orderBy(*order)),
            "mom_revenue_growth_pct": growth("net_revenue", order),
            "mom_order_growth_pct": growth("order_count", order),
        }
    ).orderBy(*order)


def quarterly_yoy(fact: DataFrame, days: DataFrame) -> DataFrame:
    quarters = _period(fact, days, "year", "quarter", "quarter_name", "quarter_year")
    order = ["year", "quarter"]
    return quarters.withColumns(
        {
            "prev_year_same_quarter_revenue": F.lag("net_revenue", 4).over(
                Window.orderBy(*order)
            ),
            "yoy_revenue_growth_pct": growth("net_revenue", order, lag=4),
        }
    ).orderBy(*order)


def daily_moving_avg(fact: DataFrame, days: DataFrame) -> DataFrame:
    daily = roll_up(dated(fact, days), "calendar_date").select(
        "calendar_date",
        F.col("net").alias("daily_net_revenue"),
        F.col("orders").alias("daily_orders"),
        F.col("units").alias("daily_units"),
    )
    order = ["calendar_date"]
    return daily.withColumns(
        {
            "moving_avg_7d_net_revenue": moving_avg("daily_net_revenue", order),
            "moving_avg_7d_orders": moving_avg("daily_orders", order),
        }
    ).orderBy(*order)


def weekday_profile(fact: DataFrame, days: DataFrame) -> DataFrame:
    profile = _period(fact, days, "day_name", "is_weekend", "is_weekday")
    return (
        profile.withColumn("revenue_share_pct", share("net_revenue"))
        .withColumn("day_type", F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday"))
        .drop("is_weekend", "is_weekday")
        .orderBy(F.desc("net_revenue"))
    )


def monthly_purchasers(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Monthly summary with distinct buyers; one distinct count, spread by (month, buyer)."""
    months = days.select("date_key", "year", "month", "month_name")
    per_buyer = (
        order_totals(fact, "date_key", "customer_key")
        .join(months, "date_key")
        .groupBy("year", "month", "month_name", "customer_key")
        .agg(F.sum("orders").alias("orders"), F.sum("net").alias("net"))
    )
    return (
        per_buyer.groupBy("year", "month", "month_name")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("net").cast(TOTAL).alias("revenue"),
            ratio(F.sum("net"), F.sum("orders")).alias("average_order_value"),
            F.count("customer_key").alias("unique_purchasers"),
        )
        .orderBy(F.desc("year"), F.desc("month"))
    )


# --- products and brands -------------------------------------------------------------
def _item_totals(items: DataFrame, *keys: str) -> DataFrame:
    return items.groupBy(*keys).agg(
        F.sum("quantity").alias("units"),
        F.sum("sub_total").cast(TOTAL).alias("net"),
        F.sum("price").cast(TOTAL).alias("price_sum"),
        F.count("price").alias("lines"),
    )


def product_totals(items: DataFrame) -> DataFrame:
    """Totals and order appearances per product: first per (product, order), then up."""
    return (
        _item_totals(items, "product_key", "order_id")
        .groupBy("product_key")
        .agg(
            *[F.sum(c).alias(c) for c in ("units", "net", "price_sum", "lines")],
            F.count("order_id").alias("appearances"),
        )
    )


def top_products(items: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    joined = product_totals(items).join(
        products, F.col("product_key") == F.col("product_id")
    )
    report = joined.select(
        "product_id",
        "product_name",
        "category",
        "brand_name",
        "brand_origin",
        F.col("units").alias("total_units_sold"),
        F.col("net").cast(TOTAL).alias("total_net_revenue"),
        ratio(F.col("price_sum"), F.col("lines")).alias("avg_unit_selling_price"),
        F.col("appearances").alias("total_order_appearances"),
    )
    return top_k(report, "total_net_revenue", k, "product_id")


def top_product_names(items: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    names = products.select(F.col("product_id").alias("product_key"), "product_name")
    report = (
        _item_totals(items, "product_key")
        .join(names, "product_key")
        .groupBy("product_name")
        .agg(
            F.sum("net").cast(TOTAL).alias("total_net_revenue"),
            F.sum("units").alias("units_sold"),
        )
    )
    return top_k(report, "total_net_revenue", k, "product_name")


def _by_product_attribute(
    items: DataFrame, attributes: DataFrame, name: str, raw_keys: DataFrame | None
) -> DataFrame:
    """Totals and distinct orders per product attribute.

    The distinct order count needs (order, attribute) pairs, so the attribute is
    looked up at (product, order) grain, with hot products spread over tasks.
    """
    pairs = _item_totals(items, "product_key", "order_id")
    tagged = salted_join(pairs, attributes, ["product_key"], "inner", ["order_id"], keys=raw_keys)
    per_order = tagged.groupBy(name, "order_id").agg(
        F.sum("units").alias("units"), F.sum("net").alias("net")
    )
    return per_order.groupBy(name).agg(
        F.sum("net").cast(TOTAL).alias("net"),
        F.sum("units").alias("units"),
        F.count("order_id").alias("orders"),
    )


def category_share(
    items: DataFrame,
    products: DataFrame,
    category: str | None = None,
    raw_keys: DataFrame | None = None,
) -> DataFrame:
    names = products.select(F.col("product_id").alias("product_key"), "category")
    if category:
        names = names.filter(F.col("category") == category)
    report = _by_product_attribute(items, names, "category", raw_keys).select(
        "category",
        F.col("net").alias("category_net_revenue"),
        F.col("units").alias("category_units_sold"),
        F.col("orders").alias("category_orders"),
        ratio(F.col("net"), F.col("units")).alias("revenue_per_unit"),
    )
    return report.withColumn(
        "category_revenue_share_pct", share("category_net_revenue")
    ).orderBy(F.desc("category_net_revenue"))


def _brand_master(brands: DataFrame) -> DataFrame:
    """Brand rows of the live source per (name, origin); repeats are kept as a weight."""
    return (
        brands.filter("brand_name is not null")
        .groupBy("brand_name", F.col("brand_origin").alias("live_origin"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def brand_origin(items: DataFrame, products: DataFrame, live_brands: DataFrame) -> DataFrame:
    """Revenue per brand and origin, the live brand table taking precedence over the mart."""
    per_brand = (
        _item_totals(items, "product_key")
        .join(products, F.col("product_key") == F.col("product_id"))
        .groupBy("brand_name", "brand_origin")
        .agg(
            F.sum("units").alias("units"),
            F.sum("net").alias("net"),
            F.count("product_id").alias("skus"),
        )
    )
    origin = F.coalesce("live_origin", "brand_origin", F.lit("Unknown Origin"))
    copies = F.coalesce("copies", F.lit(1))
    return (
        per_brand.join(_brand_master(live_brands), "brand_name", "left")
        .groupBy(
            F.coalesce("brand_name", F.lit("Unknown Brand")).alias("brand_name"),
            origin.alias("country_of_origin"),
        )
        .agg(
            F.sum(F.col("units") * copies).alias("total_units_sold"),
            F.sum(F.col("net") * copies).cast(TOTAL).alias("total_net_revenue"),
            F.sum("skus").alias("distinct_skus_sold"),
        )
        .withColumn(
            "avg_revenue_per_unit",
            ratio(F.col("total_net_revenue"), F.col("total_units_sold")),
        )
        .orderBy(F.desc("total_net_revenue"))
    )


def origin_share(
    items: DataFrame,
    products: DataFrame,
    live_brands: DataFrame,
    raw_keys: DataFrame | None = None,
) -> DataFrame:
    """Revenue and distinct orders per country of origin, live brand table first."""
    names = live_brands.filter("brand_name is not null").select(
        "brand_name", F.col("brand_origin").alias("live_origin")
    )
    origins = salted_join(
        products.select("product_id", "brand_name", "brand_origin"),
        names, ["brand_name"], "left", ["product_id"],
    ).select(
        F.col("product_id").alias("product_key"),
        F.coalesce("live_origin", "brand_origin", F.lit("Unknown Origin")).alias(
            "country_of_origin"
        ),
    )
    report = _by_product_attribute(items, origins, "country_of_origin", raw_keys).select(
        "country_of_origin",
        F.col("net").alias("origin_net_revenue"),
        F.col("units").alias("origin_units_sold"),
        F.col("orders").alias("origin_orders"),
    )
    return report.withColumn("origin_revenue_share_pct", share("origin_net_revenue")).orderBy(
        F.desc("origin_net_revenue")
    )


# --- payments ------------------------------------------------------------------------
def _paid(fact: DataFrame, methods: DataFrame, *keys: str) -> DataFrame:
    """Order totals per payment method (and ``keys``) with the method's attributes."""
    dim = methods.select(
        F.col("payment_method_id").alias("payment_method_key"),
        "display_name", F.col("type").alias("payment_type"), "provider",
    )
    return order_totals(fact, "payment_method_key", *keys).join(dim, "payment_method_key")


def payment_share(fact: DataFrame, methods: DataFrame) -> DataFrame:
    keys = ["payment_method_id", "display_name", "payment_type", "provider"]
    paid = _paid(fact, methods).withColumnRenamed("payment_method_key", "payment_method_id")
    report = roll_up(paid, *keys).select(
        *keys,
        F.col("orders").alias("total_orders"),
        F.col("net").alias("total_net_revenue"),
        aov().alias("aov"),
    )
    return report.withColumns(
        {
            "transaction_volume_share_pct": share("total_orders"),
            "revenue_market_share_pct": share("total_net_revenue"),
        }
    ).orderBy(F.desc("total_net_revenue"))


def payment_types(
    fact: DataFrame, methods: DataFrame, order_by: str = "total_net_revenue"
) -> DataFrame:
    report = roll_up(_paid(fact, methods), "payment_type").select(
        F.col("payment_type").alias("payment_channel_type"),
        F.col("orders").alias("total_orders"),
        F.col("net").alias("total_net_revenue"),
        aov().alias("aov"),
    )
    return report.withColumn("revenue_share_pct", share("total_net_revenue")).orderBy(
        F.desc(order_by), "payment_channel_type"
    )


def payment_monthly(fact: DataFrame, methods: DataFrame, days: DataFrame) -> DataFrame:
    months = days.select("date_key", "year", "month", "month_year")
    paid = _paid(fact, methods, "date_key").join(months, "date_key")
    report = roll_up(paid, "year", "month", "month_year", "display_name", "payment_type").select(
        "year",
        "month",
        "month_year",
        F.col("display_name").alias("payment_method"),
        "payment_type",
        F.col("orders").alias("monthly_orders"),
        F.col("net").alias("monthly_revenue"),
    )
    return report.withColumn(
        "monthly_revenue_share_pct", share("monthly_revenue", ["year", "month"])
    ).orderBy("year", "month", F.desc("monthly_revenue"))


def aov_by_payment(fact: DataFrame, methods: DataFrame) -> DataFrame:
    report = roll_up(_paid(fact, methods), "display_name")
    return report.select("display_name", aov().alias("aov")).orderBy(F.desc("aov"))


# --- regions -------------------------------------------------------------------------
def region_map(spark) -> DataFrame:
    """Province to macro region, a fixed list of 44 rows."""
    rows = [(p, r) for r, provinces in REGION_PROVINCES.items() for p in provinces]
    return spark.createDataFrame(rows, "address string, macro_region string")


def delivery_map(spark) -> DataFrame:
    rows = [(p, d, t) for d, t, provinces in DELIVERY_TIERS for p in provinces]
    return spark.createDataFrame(
        rows, "province string, estimated_delivery_days double, delivery_service_tier string"
    )


def _per_customer(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Order totals per customer with address and tier: one row per buyer.

    At this grain no customer is hot, and counting buyers is counting rows.
    """
    dim = customers.select(F.col("customer_id").alias("customer_key"), "address", "tire")
    return order_totals(fact, "customer_key").join(dim, "customer_key")


def _provinces(fact: DataFrame, customers: DataFrame) -> DataFrame:
    buyers = _per_customer(fact, customers)
    province = F.coalesce("address", F.lit(UNKNOWN_PROVINCE))
    return roll_up(
        buyers.withColumn("province", province), "province", buyers=F.count("customer_key")
    )


def province_heatmap(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        _provinces(fact, customers)
        .select(
            "province",
            F.col("orders").alias("total_orders"),
            F.col("buyers").alias("active_customers"),
            F.col("units").alias("total_units_sold"),
            F.col("net").alias("total_net_revenue"),
            aov().alias("average_order_value"),
            share("net").alias("revenue_share_pct"),
        )
        .orderBy(F.desc("total_net_revenue"))
    )


def top_provinces(fact: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    report = _provinces(fact, customers).select(
        "province",
        F.col("net").alias("total_net_revenue"),
        F.col("orders").alias("total_orders"),
        F.col("buyers").alias("total_customers"),
        aov().alias("aov"),
    )
    return top_k(report, "total_net_revenue", k, "province")


def _regions(fact: DataFrame, customers: DataFrame, *keys: str) -> DataFrame:
    buyers = _per_customer(fact, customers)
    regions = F.broadcast(region_map(fact.sparkSession))  # 44 fixed rows
    tagged = (
        buyers.join(regions, "address", "left")
        .withColumn("macro_region", F.coalesce("macro_region", F.lit(SOUTH)))
        .withColumn("loyalty_tier", F.coalesce("tire", F.lit("Standard")))
    )
    return roll_up(tagged, "macro_region", *keys, buyers=F.count("customer_key"))


def macro_region(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        _regions(fact, customers)
        .select(
            "macro_region",
            F.col("orders").alias("total_orders"),
            F.col("buyers").alias("total_customers"),
            F.col("units").alias("units_sold"),
            F.col("net").alias("regional_net_revenue"),
            aov().alias("aov"),
            share("net").alias("regional_revenue_share_pct"),
        )
        .orderBy(F.desc("regional_net_revenue"))
    )


def region_tier(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        _regions(fact, customers, "loyalty_tier")
        .select(
            "macro_region",
            "loyalty_tier",
            F.col("orders").alias("tier_orders"),
            F.col("net").alias("tier_revenue"),
            aov().alias("tier_aov"),
        )
        .orderBy("macro_region", F.desc("tier_revenue"))
    )


def aov_by_region(fact: DataFrame, customers: DataFrame) -> DataFrame:
    report = _regions(fact, customers).select("macro_region", aov().alias("aov"))
    return report.orderBy(F.desc("aov"))


def delivery_sla(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Demand per province with its delivery lead time and service tier."""
    tiers = F.broadcast(delivery_map(fact.sparkSession))  # 15 fixed rows
    days, label = DELIVERY_DEFAULT
    return (
        _provinces(fact, customers)
        .join(tiers, "province", "left")
        .select(
            "province",
            F.col("orders").alias("total_orders"),
            F.col("net").alias("net_revenue"),
            F.coalesce("estimated_delivery_days", F.lit(days)).alias("estimated_delivery_days"),
            F.coalesce("delivery_service_tier", F.lit(label)).alias("delivery_service_tier"),
        )
        .orderBy(F.desc("total_orders"), "province")
    )


# --- reconciliation ------------------------------------------------------------------
def reconcile(systems: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and revenue per system, stacked: {label: (frame, amount column)}."""
    out = None
    for name, (df, amount) in systems.items():
        one = df.agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.coalesce(F.sum(amount), F.lit(0)).cast(TOTAL).alias("gross_revenue"),
        ).select(F.lit(name).alias("source_system"), "*")
        out = one if out is None else out.unionByName(one)
    return out
