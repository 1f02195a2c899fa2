"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()
) -> DataFrame:
    """The first row of every key under ``order_by``.

    Ties are broken by all remaining columns, so the winner does not depend on
    partitioning. The ``row_number() = 1`` shape lets Spark keep a single row per
    key *before* the shuffle, so a key that owns a third of the input sends one
    row per map task, not a third of the table, to one reducer.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by, *rest))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
