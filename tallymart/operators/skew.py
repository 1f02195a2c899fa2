"""Equi-join that spreads hot keys over many tasks.

A row-grain join (order lines to their orders, say) cannot be pre-aggregated. If
one key owns a third of the left rows, a plain shuffle join sends all of them to a
single task. Spark's runtime skew split only works when both join inputs come
straight from a shuffle, which is not so behind a dedup; so the split is explicit.

1. ``hot_buckets`` counts the left side's keys per hash bucket: one scan of the key
   column, combined on the map side to a few numbers per task. A bucket is hot when
   it holds more rows than one fair shuffle partition. Fewer than
   ``spark.sql.shuffle.partitions`` buckets can pass that test, whatever the data,
   so broadcasting the list is safe.
2. Left rows of a hot bucket get a salt derived from their own content (so a re-run
   task assigns the same salt); right rows of a hot bucket are copied once per salt.
   Everything else keeps salt 0 and is neither copied nor moved twice.

No row is dropped or sampled: the join result is the same as the plain one. When
Spark's own size estimate lets it broadcast the right side, no shuffle happens and
the join is left plain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark's estimate of ``df`` is below its broadcast threshold."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    digits = "".join(ch for ch in limit if ch.isdigit() or ch == "-")
    unit = {"k": 2**10, "m": 2**20, "g": 2**30}.get(limit.lower().rstrip("b")[-1:], 1)
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(estimate)) <= int(digits) * unit


def _bucket(keys: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_count(df: DataFrame) -> int:
    return min(max(4 * shuffle_partitions(df.sparkSession), 1024), 65536)


def hot_buckets(keys: DataFrame, on: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, salts) for hash buckets larger than one fair shuffle partition."""
    parts = shuffle_partitions(keys.sparkSession)
    counts = keys.groupBy(_bucket([F.col(c) for c in on], buckets).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    # at most `buckets` rows reach this unpartitioned window
    fair = F.sum("_rows").over(Window.partitionBy()) / parts
    salts = F.ceil(F.col("_rows") / fair).cast("int")
    return (
        counts.withColumn("_salts", salts)
        .filter(F.col("_salts") > 1)
        .select("_bucket", "_salts")
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    salt_by: Sequence[str],
    keys: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` for ``inner``/``left``, safe for hot left keys.

    ``salt_by`` names left columns that differ within one key. ``keys`` may be a
    cheaper frame with the left side's key column (its raw source, before dedup);
    it steers only the salting, never the result.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    on = list(on)
    if broadcastable(right):
        return left.join(right, on, how)
    buckets = bucket_count(left)
    hot = hot_buckets((keys if keys is not None else left).select(*on), on, buckets)
    marked = {"_bucket": _bucket([F.col(c) for c in on], buckets)}
    small = F.broadcast(hot)
    left = left.withColumns(marked).join(small, "_bucket", "left")
    left = left.withColumn(
        "_salt",
        F.when(
            F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*salt_by), F.col("_salts")).cast("int")
        ).otherwise(0),
    ).drop("_bucket", "_salts")
    right = right.withColumns(marked).join(small, "_bucket", "left")
    right = right.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_bucket", "_salts")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
