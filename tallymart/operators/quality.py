"""Data-quality checks. Each returns its violations (or counts of them) as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TOTAL


def not_null(df: DataFrame, cols: Sequence[str], table: str = "") -> DataFrame:
    """Null counts of many columns, one pass: (table, column, rows, violations)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in cols]
    )
    return counts.select(
        F.lit(table).alias("table_name"), F.col("_n").alias("rows_checked"), F.inline(rows)
    )


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys found more than once, with their row count."""
    filled = df
    for k in keys:
        filled = filled.filter(F.col(k).isNotNull())
    return filled.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def accepted_values(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Values outside the vocabulary, with their row count. Null passes."""
    return (
        df.filter(~F.col(col).isin(list(values)))
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent, with their row count. Null passes.

    Both sides are reduced to one row per key before the join, so no key is hot.
    """
    keys = (
        child.filter(F.col(fk).isNotNull())
        .groupBy(F.col(fk).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(pk).alias("value")).distinct()
    return keys.join(known, "value", "left_anti")


def _comparable(df: DataFrame, key: str, other: DataFrame, other_key: str) -> Column:
    """The key as text that is equal wherever the two columns' values are: numbers by value, whatever their types."""
    kinds = [df.schema[key].dataType, other.schema[other_key].dataType]
    if kinds[0] == kinds[1] or not all(isinstance(k, T.NumericType) for k in kinds):
        return F.col(key).cast("string")
    if any(isinstance(k, T.FractionalType) and not isinstance(k, T.DecimalType) for k in kinds):
        return F.col(key).cast("double").cast("string")
    return F.col(key).cast("decimal(38,10)").cast("string")


def relationship_counts(
    relations: Sequence[tuple[str, DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """Rows checked and orphaned per declared relation: (label, child, fk, parent, pk).

    All foreign keys of a child are read in one pass over it, and each parent once;
    keys are combined per (relation, value) before a single join. Keys of different number
    types are compared by value.
    """
    children: dict[int, tuple[DataFrame, list[Column]]] = {}
    parents: dict[tuple[int, str], tuple[DataFrame, list[Column]]] = {}
    for label, child, fk, parent, pk in relations:
        value, known = _comparable(child, fk, parent, pk), _comparable(parent, pk, child, fk)
        pair = F.struct(F.lit(label).alias("relation"), value.alias("value"))
        children.setdefault(id(child), (child, []))[1].append(pair)
        pair = F.struct(F.lit(label).alias("relation"), known.alias("value"))
        parents.setdefault((id(parent), pk), (parent, []))[1].append(pair)

    found = [df.select(F.inline(F.array(*pairs))) for df, pairs in children.values()]
    known = [df.select(F.inline(F.array(*pairs))) for df, pairs in parents.values()]
    keys = (
        reduce(DataFrame.unionByName, found)
        .filter("value is not null")
        .groupBy("relation", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known_keys = reduce(DataFrame.unionByName, known).distinct().withColumn("known", F.lit(True))
    orphan = F.when(F.col("known").isNull(), F.col("rows"))
    counts = (
        keys.join(known_keys, ["relation", "value"], "left")
        .groupBy("relation")
        .agg(F.sum("rows").alias("rows_checked"), F.sum(orphan).alias("orphans"))
    )
    declared = found[0].sparkSession.createDataFrame([(r[0],) for r in relations], "relation string")
    zero = F.lit(0).cast("bigint")
    return declared.join(counts, "relation", "left").select(
        "relation",
        F.coalesce("rows_checked", zero).alias("rows_checked"),
        F.coalesce("orphans", zero).alias("orphans"),
    )


def domain(df: DataFrame, col: str, reference: DataFrame, ref_col: str) -> DataFrame:
    """Values missing from a reference table."""
    return relationships(df, col, reference, ref_col)


def non_negative(
    tables: dict[str, tuple[DataFrame, str]], measures: Sequence[str]
) -> DataFrame:
    """Rows with a negative measure, stacked: {model: (frame, id column)}."""
    out = None
    for name, (df, key) in tables.items():
        bad = F.lit(False)
        for m in measures:
            bad = bad | (F.col(m) < 0)
        part = df.filter(bad).select(
            F.lit(name).alias("model_name"), F.col(key).alias("record_id"), *measures
        )
        out = part if out is None else out.unionByName(part)
    return out


def order_total_reconcile(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose total differs from the sum of their lines, each floored at zero."""
    line = (F.col("quantity") * F.col("price") - F.col("discount")).cast(TOTAL)
    sums = items.groupBy("order_id").agg(
        F.sum(F.greatest(line, F.lit(0).cast(TOTAL))).cast(TOTAL).alias("items_total")
    )
    zero = F.lit(0).cast(TOTAL)
    return (
        orders.select("order_id", "total_amount")
        .join(sums, "order_id", "left")
        .withColumn("items_total", F.coalesce("items_total", zero))
        .withColumn("difference", F.col("total_amount") - F.col("items_total"))
        .filter("difference <> 0")
    )


def temporal_range(df: DataFrame, key: str, col: str, lo: str, hi: str) -> DataFrame:
    """Rows whose date lies outside ``[lo, hi]``."""
    first, last = F.lit(lo).cast("date"), F.lit(hi).cast("date")
    return df.filter(~F.col(col).between(first, last)).select(key, col)


def session_coherence(staged: DataFrame) -> DataFrame:
    """Sessions whose metrics contradict their own action array; checked inside the row."""
    offsets = F.transform("actions", lambda a: F.coalesce(a["time_offset"], F.lit(0)))
    checks = {
        "offsets_decrease": offsets != F.sort_array(offsets),
        "count_differs": F.col("actions_count") != F.size("actions"),
        "duration_too_short": F.col("duration_seconds") < F.array_max(offsets),
    }
    rows = F.filter(
        F.array(
            *[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in checks.items()]
        ),
        lambda v: v.isNotNull(),
    )
    return staged.select("event_id", "session_id", F.explode(rows).alias("violation"))


def landing_counts(
    landed: DataFrame, expected: DataFrame, day: str = "ingest_date"
) -> DataFrame:
    """Landed against expected rows per day; a day missing on either side shows as zero."""
    have = landed.groupBy(day).agg(F.count(F.lit(1)).alias("landed_rows"))
    want = expected.groupBy(day).agg(F.sum("expected_rows").alias("expected_rows"))
    both = have.join(want, day, "full")
    both = both.select(
        day,
        F.coalesce("landed_rows", F.lit(0)).alias("landed_rows"),
        F.coalesce("expected_rows", F.lit(0)).cast("bigint").alias("expected_rows"),
    )
    return both.withColumn("complete", F.col("landed_rows") >= F.col("expected_rows"))


def report(checks: dict[str, DataFrame]) -> DataFrame:
    """Number of violation rows per named check; a clean check shows as zero."""
    out = None
    for name, violations in checks.items():
        one = violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )
        out = one if out is None else out.unionByName(one)
    return out.withColumn("passed", F.col("violations") == 0)


def schema_differences(df: DataFrame, expected: Sequence[str]) -> dict[str, list[str]]:
    """Columns missing from and unexpected in ``df``, and whether the order differs."""
    have, want = df.columns, list(expected)
    return {
        "missing": [c for c in want if c not in have],
        "unexpected": [c for c in have if c not in want],
        "order": [] if have == want else have,
    }
