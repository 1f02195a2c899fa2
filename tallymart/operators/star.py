"""Star schema: dimensions, facts and slowly changing history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import date_key
from ..schemas import TOTAL
from .dedup import dedup_latest
from .skew import salted_join



def dim_customer(customers: DataFrame) -> DataFrame:
    """Customer attributes without contact data."""
    return customers.select(
        "customer_id", "first_name", "last_name", "gender", "tire", "address"
    )


def _calendar_columns(days: DataFrame) -> DataFrame:
    d = F.col("calendar_date")
    weekend = F.dayofweek(d).isin(1, 7)
    quarter = F.concat(F.lit("Q"), F.quarter(d).cast("string"))
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MM-yyyy").alias("month_year"),
        F.quarter(d).alias("quarter"),
        quarter.alias("quarter_name"),
        F.concat(quarter, F.lit("-"), F.year(d).cast("string")).alias("quarter_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekend.cast("int").alias("is_weekend"),
        (~weekend).cast("int").alias("is_weekday"),
    )


def calendar(
    spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31"
) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive."""
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    if days <= 0:
        raise ValueError("a calendar must not end before it starts")
    span = spark.range(days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("calendar_date")
    )
    return _calendar_columns(span)


def calendar_covering(df: DataFrame, day: str) -> DataFrame:
    """A calendar from the first to the last day found in ``df``."""
    bounds = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).filter("lo is not null")
    span = bounds.select(F.explode(F.sequence("lo", "hi")).alias("calendar_date"))
    return _calendar_columns(span)


def dim_payment_method(methods: DataFrame, start: str = "2025-01-01") -> DataFrame:
    """Every method as its first and current version; ``scd2_apply`` adds later ones."""
    return methods.select(
        "payment_method_id",
        "display_name",
        "provider",
        "type",
        F.lit(start).cast("date").alias("effective_start_date"),
        F.lit(None).cast("date").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )


def scd2_apply(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: str,
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """Fold a new snapshot into a versioned history.

    A changed key has its current version closed on ``as_of`` and a new one opened;
    a new key is opened; an unchanged or absent key is left alone. A change of a
    version that itself began on ``as_of`` replaces it, so a re-run is a no-op, and a
    version that began later than ``as_of`` is left alone: a snapshot from before it says
    nothing new. Of repeated snapshot keys the first by ``order_by`` and the remaining
    columns counts; rows without a key are left out. Untracked columns of the history go
    along; a new version takes them from the snapshot where that has them.
    """
    day = F.lit(as_of).cast("date")
    tracked = list(tracked)
    own = ["effective_start_date", "effective_end_date", "is_current"]
    others = [c for c in history.columns if c not in (key, *tracked, *own)]
    past = history.filter("not is_current")
    cur = history.filter("is_current").select(
        F.col(key), F.struct(*tracked).alias("old"), F.struct(F.lit(0).alias("_"), *others).alias("had"),
        F.col("effective_start_date").alias("since"), F.lit(True).alias("known"),
    )
    given = [c for c in others if c in snapshot.columns]
    first = dedup_latest(snapshot.filter(F.col(key).isNotNull()), [key], order_by)
    new = first.select(
        F.col(key), F.struct(*tracked).alias("new"), F.struct(F.lit(0).alias("_"), *given).alias("has"),
        F.lit(True).alias("seen"),
    )
    joined = cur.join(new, key, "full")

    def version(values: str, start: Column, end: Column, current: bool) -> Column:
        rest = {c: f"has.{c}" if values == "new" and c in given else f"had.{c}" for c in others}
        return F.struct(
            *[F.col(f"{values}.{c}").alias(c) for c in tracked],
            *[F.col(source).alias(c) for c, source in rest.items()],
            start.alias("effective_start_date"),
            end.cast("date").alias("effective_end_date"),
            F.lit(current).alias("is_current"),
        )

    never = F.lit(None).cast("date")
    same = F.col("old").eqNullSafe(F.col("new")) | F.col("seen").isNull() | (F.col("since") > day)
    opened = version("new", day, never, True)
    versions = (
        F.when(F.col("known").isNull(), F.array(opened))
        .when(same, F.array(version("old", F.col("since"), never, True)))
        .when(F.col("since") == day, F.array(opened))
        .otherwise(F.array(version("old", F.col("since"), day, False), opened))
    )
    folded = joined.select(key, F.explode(versions).alias("v")).select(key, "v.*")
    return past.unionByName(folded).select(*history.columns)


def no_history(snapshots: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """A history without versions, to fold the first snapshots into."""
    return snapshots.limit(0).select(
        key, *columns, F.lit(None).cast("date").alias("effective_start_date"),
        F.lit(None).cast("date").alias("effective_end_date"), F.lit(True).alias("is_current"),
    )


def scd2_fold(
    history: DataFrame,
    snapshots: DataFrame,
    key: str,
    tracked: Sequence[str],
    day: str,
    newest: Sequence[str] = (),
) -> DataFrame:
    """Fold many dated snapshots into a versioned history at once.

    The result is that of ``scd2_apply`` for every day of ``snapshots`` in turn. Rows and current
    versions meet once, dealt by key and sorted by day; a version begins where the tracked
    columns differ from the row before and ends where the next begins. Of a key's rows of one
    day the first counts, by ``newest`` columns descending and then all others. Rows without
    key or day are left out.
    """
    tracked = list(tracked)
    own = ["effective_start_date", "effective_end_date", "is_current"]
    others = [c for c in history.columns if c not in (key, *tracked, *own)]
    given = [c for c in others if c in snapshots.columns]
    rest = [c for c in snapshots.columns if c not in (key, day)]
    nothing = F.lit(None).cast(snapshots.select(F.struct(F.lit(0).alias("_"), *rest)).schema[0].dataType)
    had = F.struct(F.lit(0).alias("_"), *others)
    current = history.filter("is_current").select(
        key, F.struct(*tracked).alias("now"), had.alias("had"), nothing.alias("row"),
        F.col("effective_start_date").alias("_day"), F.lit(0).alias("_from"),
    )
    dated = snapshots.filter(F.col(key).isNotNull() & F.col(day).isNotNull())
    seen = dated.select(
        key, F.struct(*tracked).alias("now"), F.lit(None).cast(current.schema["had"].dataType).alias("had"),
        F.struct(F.lit(0).alias("_"), *rest).alias("row"), F.col(day).cast("date").alias("_day"), F.lit(1).alias("_from"),
        *[F.col(c).alias(f"_order{k}") for k, c in enumerate(newest)],
    )
    order = [F.desc_nulls_last(f"_order{k}") for k in range(len(newest))]
    # the struct sorts like its columns in turn, nulls first
    by_day = Window.partitionBy(key).orderBy("_day", "_from", *order, "row")
    of_key = Window.partitionBy(key)
    met = current.unionByName(seen, allowMissingColumns=True).repartition(key)
    first = met.withColumns({"_d": F.lag("_day").over(by_day), "_f": F.lag("_from").over(by_day)}).filter(
        "_d is null or _d <> _day or _f <> _from"
    )
    since = F.max(F.when(F.col("_from") == 0, F.col("_day"))).over(of_key)
    kept_had = F.first("had", ignorenulls=True).over(of_key)
    known = first.withColumns({"_since": since, "had": kept_had}).filter("_since is null or _day >= _since")
    before = F.lag("now").over(by_day)
    begun = known.withColumn("_before", before).filter("_before is null or not (_before <=> now)")
    versions = begun.withColumn("_end", F.lead("_day").over(by_day)).filter("_end is null or _end <> _day")
    fresh = F.col("_from") == 1
    values = [F.col(f"now.{c}").alias(c) for c in tracked]
    for c in others:
        value = F.when(fresh, F.col(f"row.{c}")).otherwise(F.col(f"had.{c}")) if c in given else F.col(f"had.{c}")
        values.append(value.alias(c))
    folded = versions.select(
        key, *values, F.col("_day").alias("effective_start_date"), F.col("_end").alias("effective_end_date"),
        F.col("_end").isNull().alias("is_current"),
    )
    return history.filter("not is_current").unionByName(folded).select(*history.columns)


def denormalise(
    fact: DataFrame,
    lookups: Sequence[tuple[DataFrame, str, dict[str, str]]],
    salt_by: str,
    raw_keys: DataFrame | None = None,
) -> DataFrame:
    """Left-join lookups on their key and fill the given defaults where none matched."""
    out = fact
    for dim, key, defaults in lookups:
        out = salted_join(out, dim, [key], "left", [salt_by], keys=raw_keys)
        out = out.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})
    return out


def dim_product(
    products: DataFrame,
    categories: DataFrame,
    brands: DataFrame,
    raw_keys: DataFrame | None = None,
) -> DataFrame:
    """Products with category and brand names. One brand may own most products."""
    names = categories.select("category_id", F.col("category_display_name").alias("category"))
    wide = denormalise(
        products,
        [
            (names, "category_id", {"category": "Uncategorized"}),
            (brands, "brand_id", {"brand_name": "Generic", "brand_origin": "Unknown"}),
        ],
        salt_by="product_id",
        raw_keys=raw_keys,
    )
    return wide.select(
        "product_id",
        "product_name",
        "product_description",
        F.col("price").alias("unit_price"),
        "category",
        "brand_name",
        "brand_origin",
    )


def fact_order(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order with the totals of its lines.

    Lines are summed before the join, so a giant order meets it as one row. An order
    without lines falls back to its own total.
    """
    per_order = items.groupBy("order_id").agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum((F.col("quantity") * F.col("price")).cast(TOTAL)).alias("gross"),
        F.sum("discount").alias("discounts"),
        F.sum("line_total_amount").alias("net"),
    )
    return orders.join(per_order, "order_id", "left").select(
        "order_id",
        F.col("customer_id").alias("customer_key"),
        F.col("payment_method_id").alias("payment_method_key"),
        date_key(F.col("order_date")).alias("date_key"),
        F.coalesce("total_quantity", F.lit(0)).cast("bigint").alias("quantity"),
        F.coalesce("gross", "total_amount").cast(TOTAL).alias("price"),
        F.coalesce("discounts", F.lit(0)).cast(TOTAL).alias("discount_amt"),
        F.coalesce("net", "total_amount").cast(TOTAL).alias("sub_total"),
    )


def fact_order_items(
    items: DataFrame, orders: DataFrame, raw_keys: DataFrame | None = None, colocated: bool = False
) -> DataFrame:
    """Order lines with the keys of their order; a hot order is spread over tasks.

    ``colocated`` tables, bucketed by order, are joined bucket by bucket with no exchange; lines of
    one order then stay together.
    """
    heads = orders.select("order_id", "customer_id", "payment_method_id", "order_date")
    if colocated:
        wide = items.join(heads, "order_id")
    else:
        wide = salted_join(items, heads, ["order_id"], "inner", ["order_item_id"], keys=raw_keys)
    return wide.select(
        "order_item_id",
        "order_id",
        F.col("customer_id").alias("customer_key"),
        F.col("product_id").alias("product_key"),
        F.col("payment_method_id").alias("payment_method_key"),
        date_key(F.col("order_date")).alias("order_date_key"),
        "quantity",
        "price",
        F.col("discount").alias("discount_amt"),
        F.col("line_total_amount").alias("sub_total"),
    )
