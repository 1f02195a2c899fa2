"""Per-user daily activity and rolling behaviour features."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio, safe_ratio
from ..schemas import ACTIONS, LABEL, MONEY, TOTAL

DAY = ["user_id", "activity_date"]
_SESSION_SUMS = ["sessions", "duration", "page_views", "actions", "purchase_sessions"]
_ACTION_SUMS = {
    "view_count": "is_view",
    "add_to_cart_count": "is_add_to_cart",
    "purchase_count": "is_purchase",
    "search_count": "is_search",
    "wishlist_count": "is_wishlist",
    "checkout_view_count": "is_checkout_view",
}


def daily_sessions(sessions: DataFrame) -> DataFrame:
    """Session totals per user and day. Input holds one row per session."""
    return (
        sessions.filter("user_id is not null")
        .groupBy("user_id", F.to_date("timestamp").alias("activity_date"))
        .agg(
            F.count("session_id").alias("sessions"),
            F.sum("duration_seconds").alias("duration"),
            F.sum("page_views").alias("page_views"),
            F.sum("actions_count").alias("actions"),
            F.count_if("has_purchase").alias("purchase_sessions"),
            F.sum("revenue").cast(TOTAL).alias("revenue"),
        )
    )


def daily_actions(actions: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Action counts per user and day of the action (which may follow the session's day).

    Actions are first combined per product, which also settles the distinct count;
    without a ``user_id`` of their own they join the sessions only after that.
    """
    owner = "user_id" if "user_id" in actions.columns else "session_id"
    per_product = actions.groupBy(
        owner, F.to_date("action_timestamp").alias("activity_date"), "product_id"
    ).agg(
        *[F.sum(flag).alias(name) for name, flag in _ACTION_SUMS.items()],
        F.sum("product_price").alias("price_sum"),
        F.count("product_price").alias("price_count"),
    )
    if owner == "session_id":
        users = sessions.select("session_id", "user_id")
        per_product = (
            per_product.join(users, "session_id")
            .groupBy(*DAY, "product_id")
            .agg(
                *[F.sum(c).alias(c) for c in [*_ACTION_SUMS, "price_sum", "price_count"]]
            )
        )
    average = ratio(F.sum("price_sum"), F.sum("price_count"), 6)
    return (
        per_product.filter("user_id is not null")
        .groupBy(*DAY)
        .agg(
            *[F.sum(c).alias(c) for c in _ACTION_SUMS],
            F.count("product_id").alias("distinct_products"),
            average.cast("decimal(18,6)").alias("avg_product_price"),
        )
    )


def daily_activity(by_session: DataFrame, by_action: DataFrame) -> DataFrame:
    """Both daily tables side by side, zero where one of them has no row."""
    both = by_session.join(by_action, DAY, "full")
    counts = [*_SESSION_SUMS, *_ACTION_SUMS, "distinct_products"]
    return both.select(
        *DAY,
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("revenue", F.lit(0)).cast(TOTAL).alias("revenue"),
        F.coalesce("avg_product_price", F.lit(0)).cast("decimal(18,6)").alias("avg_product_price"),
    )


def activity_rows(sessions: DataFrame) -> DataFrame:
    """One row for every session (``pos`` 0) and one per action, with the time it ``happened``."""
    start = F.col("event_timestamp")
    steps = F.filter("actions", lambda a: a.isNotNull())
    rows = sessions.filter("user_id is not null").select(
        "user_id",
        start.alias("at"),
        *[F.col(c) for c in ("duration_seconds", "page_views", "actions_count")],
        "has_purchase",
        "revenue",
        # the leading null element stands for the session itself
        F.posexplode(
            F.concat(
                F.array(F.lit(None).cast(ACTIONS[len("array<") : -1])),
                F.coalesce(steps, F.array().cast(ACTIONS)),
            )
        ).alias("pos", "act"),
    )
    acted = F.timestamp_seconds(
        F.unix_timestamp("at") + F.coalesce("act.time_offset", F.lit(0))
    )
    return rows.withColumn("happened", F.when(F.col("pos") == 0, F.col("at")).otherwise(acted))


def product_sums() -> list[Column]:
    """Sums of ``activity_rows`` per user, day and product."""
    is_session, kind = F.col("pos") == 0, F.col("act.type")
    price = F.col("act.price").try_cast(MONEY)
    return [
        F.count_if(is_session).alias("sessions"),
        F.sum(F.when(is_session, F.col("duration_seconds"))).alias("duration"),
        F.sum(F.when(is_session, F.col("page_views"))).alias("page_views"),
        F.sum(F.when(is_session, F.col("actions_count"))).alias("actions"),
        F.count_if(is_session & F.col("has_purchase")).alias("purchase_sessions"),
        F.sum(F.when(is_session, F.col("revenue"))).alias("revenue"),
        *[
            F.count_if(kind == flag.removeprefix("is_")).alias(name)
            for name, flag in _ACTION_SUMS.items()
        ],
        F.sum(price).alias("price_sum"),
        F.count(price).alias("price_count"),
    ]


def day_sums() -> list[Column]:
    """Sums of ``product_sums`` per user and day."""
    average = ratio(F.sum("price_sum"), F.sum("price_count"), 6)
    zero = F.lit(0)
    return [
        *[
            F.coalesce(F.sum(c), zero).cast("bigint").alias(c)
            for c in [*_SESSION_SUMS, *_ACTION_SUMS]
        ],
        F.count("product_id").alias("distinct_products"),
        F.coalesce(F.sum("revenue"), zero).cast(TOTAL).alias("revenue"),
        F.coalesce(average, zero).cast("decimal(18,6)").alias("avg_product_price"),
    ]


def activity_from_log(sessions: DataFrame) -> DataFrame:
    """``daily_activity`` straight from deduplicated records with their action arrays.

    A record contributes one row for the session and one per action, on the day each
    happened. Summing them together reads and deduplicates the log once, where the
    two daily tables would do so twice and then need an outer join.
    """
    per_product = (
        activity_rows(sessions)
        .groupBy(
            "user_id",
            F.to_date("happened").alias("activity_date"),
            F.col("act.product_id").alias("product_id"),
        )
        .agg(*product_sums())
    )
    return per_product.groupBy(*DAY).agg(*day_sums())


def purchase_label() -> Column:
    bought = (F.col("purchase_sessions") > 0) | (F.col("purchase_count") > 0)
    return F.when(bought, 1).otherwise(0).cast("int")


def label_anchor(activity: DataFrame) -> DataFrame:
    """The days to predict for: every active day, labelled 1 if the user bought on it."""
    return activity.select(
        "user_id", F.col("activity_date").alias("prediction_date"), purchase_label().alias(LABEL)
    ).distinct()


def rolling_range(
    df: DataFrame, by: str, day: str, aggs: Mapping[str, Column], lo: int = -3, hi: int = -1
) -> DataFrame:
    """Aggregate each row's window of days ``[day+lo, day+hi]`` within ``by``.

    Input holds one row per (``by``, ``day``), so a user adds at most one row per
    calendar day. One shuffle and one sort replace a range self-join. A null day has
    no window.
    """
    frame = Window.partitionBy(by).orderBy(F.unix_date(day)).rangeBetween(lo, hi)
    known = F.col(day).isNotNull()
    return df.withColumns({name: F.when(known, agg.over(frame)) for name, agg in aggs.items()})


def rolling_3d(activity: DataFrame) -> DataFrame:
    """Sums over the three days before each active day, zero where there were none."""
    sums = {f"{c}_3d": F.sum(c) for c in ["sessions", "purchase_sessions", *_ACTION_SUMS]}
    totals = {f"total_{c}_3d": F.sum(c) for c in ["duration", "page_views", "actions"]}
    rolled = rolling_range(
        activity.withColumn(LABEL, purchase_label()),
        "user_id",
        "activity_date",
        {
            **sums,
            **totals,
            "total_revenue_3d": F.sum("revenue"),
            # the largest daily distinct count, and the mean of the daily means
            "distinct_products_3d": F.max("distinct_products"),
            "_price_sum": F.sum("avg_product_price"),
            "_price_days": F.count("avg_product_price"),
        },
    )
    mean_price = F.col("_price_sum").cast("double") / F.nullif(
        F.col("_price_days").cast("double"), F.lit(0.0)
    )
    counts = [*sums, *totals, "distinct_products_3d"]
    return rolled.select(
        "user_id",
        F.col("activity_date").alias("prediction_date"),
        LABEL,
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce(F.col("total_revenue_3d").cast("double"), F.lit(0.0)).alias("total_revenue_3d"),
        F.coalesce(mean_price, F.lit(0.0)).alias("avg_product_price_3d"),
    )


def behaviour_features(rolled: DataFrame) -> DataFrame:
    """The feature table: rolling sums plus their guarded ratios."""
    c = F.col
    sessions, actions = c("sessions_3d"), c("total_actions_3d")
    return rolled.withColumns(
        {
            "avg_session_duration_3d": safe_ratio(c("total_duration_3d"), sessions, 2),
            "cart_conversion_rate_3d": safe_ratio(
                c("purchase_count_3d"), c("add_to_cart_count_3d"), 4
            ),
            "purchase_conversion_rate_3d": safe_ratio(c("purchase_count_3d"), actions, 4),
            "actions_per_session_3d": safe_ratio(actions, sessions, 4),
            "purchase_session_rate_3d": safe_ratio(c("purchase_sessions_3d"), sessions, 4),
        }
    )


def top_spenders(features: DataFrame, on: str | None = None, k: int = 20) -> DataFrame:
    """The ``k`` users with the highest three-day spend on one day (default: the last)."""
    day = F.col("prediction_date")
    if on is not None:
        features = features.filter(day == F.lit(on).cast("date"))
    # rows of the last day come first, so the k best rows hold all that are wanted
    best = features.orderBy(F.desc(day), F.desc("total_revenue_3d"), F.asc("user_id")).limit(k)
    last = F.max(day).over(Window.partitionBy())
    return best.withColumn("_last", last).filter(day == F.col("_last")).drop("_last")
