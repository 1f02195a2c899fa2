"""Raw retail tables derived from the order, part, customer and event tables on disk.

Every mapping is a row-local expression or a distinct over one column: no grouping
of events into arrays, so a user with a third of all events costs nothing extra.
Text is left slightly untidy (blanks, mixed case) as raw exports are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ACTIONS, MONEY

# Nation key 0..24 to province; the last nation has no known province.
PROVINCES = [
    "Hà Nội", "Hải Phòng", "Bắc Ninh", "Lai Châu", "Điện Biên", "Hà Giang", "Quảng Ninh",
    "Nam Định", "Đà Nẵng", "Khánh Hòa", "Kon Tum", "Nghệ An", "Quảng Nam", "Lâm Đồng",
    "Đắk Nông", "TP Hồ Chí Minh", "Bình Dương", "Đồng Nai", "Cần Thơ", "Long An", "An Giang",
    "Kiên Giang", "Cà Mau", "Tây Ninh",
]
# Product categories, numbered from 1.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# Payment method number to (type, provider).
PAYMENTS = {
    1: ("E_WALLET", "MoMo"), 2: ("CARD", "Visa"), 3: ("BANKING", "VNPay"),
    4: ("COD", "Cash"), 5: ("CARD", "Mastercard"),
}
# Steps of a web session by the kind of event that ended it.
STEPS = {
    "view": ["view"],
    "click": ["view", "click", "add_to_cart"],
    "signup": ["view", "wishlist", "checkout_view"],
    "purchase": ["view", "add_to_cart", "checkout_view", "purchase"],
    "error": ["search", "view"],
}
# Other web vocabularies.
SEGMENTS = ["new", "returning", "loyal", "churn_risk"]
DEVICES = ["mobile", "desktop", "tablet"]
SYSTEMS = ["iOS", "Windows", "Android"]
GENDERS = {"AUTOMOBILE": "Nam", "BUILDING": "F", "FURNITURE": "Nữ", "HOUSEHOLD": "x"}


def _nth(values: list[str], index: Column) -> Column:
    """Zero-based pick from a fixed list; null outside it."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _case(value: Column, mapping: dict, default=None) -> Column:
    out = F
    for key, result in mapping.items():
        out = out.when(value == key, result)
    return out.otherwise(default)


def _times(created: Column, changed: Column) -> list[Column]:
    """Row times from two day counts after 2015-01-01; the source tables carry none."""
    first = F.date_add(F.lit("2015-01-01").cast("date"), created.cast("int"))
    last = F.date_add(first, changed.cast("int"))
    return [
        first.cast("timestamp").alias("created_at"), last.cast("timestamp").alias("updated_at"),
    ]


def _category_id(kind: Column) -> Column:
    position = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), kind)
    return F.nullif(position, F.lit(0)).cast("int")


def customers(customer: DataFrame) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    name = F.split("c_name", "#")
    tier = (
        F.when(balance < 0, None)
        .when(balance < 2500, "Bronze")
        .when(balance < 5000, " Silver")
        .when(balance < 7500, "GOLD")
        .when(balance < 9500, "Platinum ")
        .otherwise("vip")
    )
    phone = F.when(balance < 0, F.concat(F.lit("12-"), key)).otherwise(
        F.concat(F.lit("09-"), key + 10000000)
    )
    return customer.select(
        key.alias("customer_id"),
        F.concat(F.lit(" "), name[0]).alias("first_name"),
        F.concat(name[1], F.lit(" ")).alias("last_name"),
        F.concat(F.lit(" Customer"), key, F.lit("@Example.COM")).alias("email"),
        phone.alias("phone_number"),
        _case(F.col("c_mktsegment"), GENDERS).alias("gender"),
        tier.alias("tire"),
        _nth(PROVINCES, F.col("c_nationkey")).alias("address"),
        *_times(F.pmod(key, F.lit(3000)), F.col("c_nationkey")),
    )


def brands(part: DataFrame, nation: DataFrame) -> DataFrame:
    number = F.regexp_extract("p_brand", "([0-9]+)", 1).try_cast("int")
    known = part.select("p_brand").distinct().withColumn("n_nationkey", number - 1)
    return known.join(nation.select("n_nationkey", "n_name"), "n_nationkey", "left").select(
        F.col("p_brand").alias("brand_id"),
        F.concat("p_brand", F.lit(" ")).alias("brand_name"),
        F.concat(F.lit(" "), F.col("n_name")).alias("brand_origin"),
    )


def category(part: DataFrame) -> DataFrame:
    return (
        part.select("p_type")
        .distinct()
        .select(
            _category_id(F.col("p_type")).alias("category_id"),
            F.concat("p_type", F.lit(" ")).alias("category_display_name"),
            F.concat("p_type", F.lit(" products")).alias("category_description"),
        )
    )


def payment_method(orders: DataFrame) -> DataFrame:
    number = F.substring("o_orderpriority", 1, 1).try_cast("int")
    types = {k: t for k, (t, _) in PAYMENTS.items()}
    providers = {k: p for k, (_, p) in PAYMENTS.items()}
    return (
        orders.select("o_orderpriority")
        .distinct()
        .select(
            number.alias("payment_method_id"),
            F.expr("substring(o_orderpriority, 3)").alias("display_name"),
            _case(number, types, "OTHER").alias("type"),
            _case(number, providers).alias("provider"),
        )
    )


def products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat("p_type", F.lit(" size "), "p_size").alias("product_description"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
        _category_id(F.col("p_type")).alias("category_id"),
        F.col("p_brand").alias("brand_id"),
        *_times(F.pmod("p_partkey", F.lit(3000)), F.col("p_size")),
    )


def orders(orders: DataFrame) -> DataFrame:
    placed = F.col("o_orderdate").cast("timestamp")
    settled = F.expr(
        "make_dt_interval(CASE o_orderstatus WHEN 'F' THEN 7 WHEN 'P' THEN 3 ELSE 0 END)"
    )
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        placed.alias("order_date"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("payment_method_id"),
        placed.alias("created_at"),
        (placed + settled).alias("updated_at"),
    )


def order_items(lineitem: DataFrame) -> DataFrame:
    """Unit price is the extended price over the quantity, cut to the cent in integers."""
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.expr(
            "cast(cast(cast(l_extendedprice as decimal(12,2)) * 100 as bigint)"
            " div nullif(cast(l_quantity as int), 0) as decimal(12,0)) * 0.01"
        ).cast(MONEY).alias("price"),
        F.expr(
            "cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))"
        ).cast(MONEY).alias("discount"),
    )


def clickstream(events: DataFrame) -> DataFrame:
    """One session record per event, nested as the web log delivers it.

    Records of one user within an hour share a session id, so the later ones are
    re-deliveries that the session dedup resolves. ``error`` events come with
    contradictory metrics, which the coherence check reports.
    """
    e = events.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").cast(MONEY).alias("value"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        _case(
            F.col("event_type"),
            {k: F.array(*[F.lit(s) for s in v]) for k, v in STEPS.items()},
        ).alias("steps"),
    )
    k, user = F.col("k"), F.col("user_id")
    broken = F.col("event_type") == "error"
    bought = F.col("event_type") == "purchase"
    device = _nth(DEVICES, F.pmod(user, F.lit(3)))
    count = F.size("steps")

    def action(step: Column, i: Column) -> Column:
        product = step != "search"
        return F.struct(
            step.alias("type"),
            (F.when(broken, 1 - i).otherwise(i) * 30 + k).cast("int").alias("time_offset"),
            F.concat(F.lit("/"), step).alias("page"),
            F.when(step == "search", F.concat(F.lit("term-"), k)).alias("search_term"),
            F.when(product, k).alias("product_id"),
            F.when(product, F.concat(F.lit("item "), k)).alias("product_name"),
            F.when(product, _nth(CATEGORIES, F.pmod(k, F.lit(6)))).alias("category"),
            F.when(product, F.col("value").cast("double")).alias("price"),
            F.when(step == "purchase", F.concat(F.lit("web-"), "event_id")).alias("order_id"),
        )

    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(
            F.lit("s-"), user, F.lit("-"), F.date_format("ts", "yyyyMMddHH")
        ).alias("session_id"),
        F.col("ts").alias("timestamp"),
        user,
        _nth(SEGMENTS, F.pmod(user, F.lit(4))).alias("user_segment"),
        F.struct(
            device.alias("type"),
            _nth(SYSTEMS, F.pmod(user, F.lit(3))).alias("os"),
            F.lit("Chrome").alias("browser"),
            F.concat(F.lit("v"), F.pmod(k, F.lit(10))).alias("version"),
        ).alias("device"),
        F.struct(
            _nth(PROVINCES, F.pmod(user, F.lit(25))).alias("city"),
            F.lit("Vietnam").alias("country"),
            F.struct(
                (F.pmod(user, F.lit(16)) + 8).cast("double").alias("lat"),
                (F.pmod(user, F.lit(8)) + 102).cast("double").alias("lon"),
            ).alias("coordinates"),
        ).alias("location"),
        F.concat(F.lit("https://ref.example/"), "event_type").alias("referrer"),
        F.when(k < 50, "search").otherwise("social").alias("referrer_type"),
        F.when(k < 50, "google").otherwise("facebook").alias("source"),
        F.when(k < 10, F.concat(F.lit("camp-"), k)).alias("campaign"),
        F.transform("steps", action).cast(ACTIONS).alias("actions"),
        F.struct(
            F.when(broken & (k < 10), k).otherwise((count - 1) * 30 + k + 10)
            .cast("int").alias("duration_seconds"),
            count.alias("page_views"),
            F.when(broken & (k > 50), count + 1).otherwise(count).alias("actions_count"),
            bought.alias("has_purchase"),
            F.when(bought, F.col("value").cast("double")).otherwise(0.0).alias("revenue"),
        ).alias("session_metrics"),
        F.struct(
            F.when(F.pmod(user, F.lit(2)) == 0, "A").otherwise("B").alias("ab_test"),
            F.lit("vi").alias("language"),
            F.lit("VND").alias("currency"),
            F.when(F.col("event_type") != "view", device == "mobile").alias("is_mobile"),
        ).alias("properties"),
    )


def read_raw(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """Raw retail tables, each built on demand from the parquet tables in ``folder``."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")

    return {
        "brands": lambda: brands(table("part"), table("nation")),
        "category": lambda: category(table("part")),
        "payment_method": lambda: payment_method(table("orders")),
        "customers": lambda: customers(table("customer")),
        "products": lambda: products(table("part")),
        "orders": lambda: orders(table("orders")),
        "order_items": lambda: order_items(table("lineitem")),
        "clickstream": lambda: clickstream(table("events")),
    }


def stream_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The raw clickstream as a stream over the event table.

    The table may be a folder of part files or one file; a file source reads folders
    only, so the single file is picked out of its folder by name.
    """
    folder = folder.rstrip("/")
    table = spark.read.parquet(f"{folder}/events.parquet")
    reader = spark.readStream.schema(table.schema)
    part = table.select("_metadata.file_path").first()
    if part is not None and part[0].endswith("/events.parquet"):
        events = reader.option("pathGlobFilter", "events.parquet").parquet(folder)
    else:
        events = reader.parquet(f"{folder}/events.parquet")
    return clickstream(events)
