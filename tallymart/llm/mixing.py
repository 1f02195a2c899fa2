"""Mixing sources to target weights.

Words are summed per source (combined before the shuffle), the sources share a budget by
weight, no source getting more than ``CAP`` times its size, and every document is emitted
floor(rate) times plus once more with probability equal to the rate's fraction, where the
rate is its source's target over its size. The coin is a hash of the doc_id, so reruns and
recomputed tasks agree.

Only the table of sources, one row each, passes through ordered windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup, sheltered, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, CAP, SEED = (5, 2, 1), 1.5, 2, "mix"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP
) -> DataFrame:
    """source, source_size, target: one row per source of ``sizes`` (source, size); null is a source.

    Sources in order of their names' code points, null last, take the weights in turn. The
    budget is ``share`` times all sizes. A source whose part would exceed ``cap`` times its
    size gets that much, and the rest is shared by weight among the others, until none is
    above. Sorted by size per weight, the capped sources come first, so one pass finds them.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    weighed = totals.withColumn("weight", weight)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    level = (
        F.sum("source_size").over(all_rows) * F.lit(share) - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    # the level rises while sources are capped and falls once uncapped ones count as capped
    final = F.max("level").over(all_rows)
    return weighed.withColumn("level", level).select(
        "source",
        "source_size",
        F.least(F.col("source_size") * F.lit(float(cap)), final * F.col("weight")).alias("target"),
    )


def coin(seed: str = SEED) -> Column:
    """A number in [0, 1) from the doc_id; rows without one use their text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce(F.col("text"), F.lit(""))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**13))


def copies(rate: Column, draw: Column) -> Column:
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")


def _with_rate(rows: DataFrame, targets: DataFrame) -> DataFrame:
    named = targets.withColumnRenamed("source", "_of")
    joined = lookup(rows, named, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return joined.withColumn("_copies", copies(rate, F.col("_coin")))


def mixture_table(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: one row per row of ``docs``.

    size counts words (null text: 0); a source whose documents have no words has target 0.
    Repeated rows draw the same coin. Other columns are not read.
    """
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), coin().alias("_coin"))
    rows = stored(rows, "sizes")
    targets = stored(source_targets(rows), "targets")
    return _with_rate(rows, targets).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("_copies")).alias("taken"),
        F.col("_copies").alias("copies"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, each row as often as the mix takes it (copy: 1, 2).

    A null source is a source; a null or empty text has no words, and a source without words
    is not taken. Repeated rows draw the same coin. A column ``copy`` of ``docs`` gives way to the
    new one; others may have any name. An empty table stays empty.
    """
    return sheltered(docs, ["doc_id", "text", "source", "copy"], _mix)


def _mix(docs: DataFrame) -> DataFrame:
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = stored(source_targets(sizes), "targets").select("source", "source_size", "target")
    inner = {"source_size": "_size", "target": "_target"}
    known = targets.withColumnsRenamed({"source": "_of"} | inner)
    joined = lookup(docs.withColumn("_coin", coin()), known, F.col("source").eqNullSafe(F.col("_of")))
    rate = F.when(F.col("_size") > 0, F.col("_target") / F.col("_size")).otherwise(F.lit(0.0))
    copy = F.explode(F.sequence(F.lit(1), copies(rate, F.col("_coin")))).alias("copy")
    taken = joined.filter(copies(rate, F.col("_coin")) >= 1)
    return taken.select(*[c for c in docs.columns if c != "copy"], copy)
