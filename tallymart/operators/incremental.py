"""Incremental loading: high-water marks and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_latest


def high_water_mark(
    source: DataFrame, target: DataFrame, col: str, inclusive: bool = False
) -> DataFrame:
    """Source rows above the target's maximum; all rows while the target is empty.

    The mark is a scalar subquery: Spark computes it first and filters with the value.
    """
    mark = target.agg(F.max(col)).scalar()
    above = F.col(col) >= mark if inclusive else F.col(col) > mark
    return source.filter(mark.isNull() | above)


def rows_after(source: DataFrame, target: DataFrame, time: str, keys: Sequence[str]) -> DataFrame:
    """Source rows that an increment must load: those after the target's newest time, and of that very time
    those whose key the target does not hold.

    A border time that several rows share, some of them loaded, is thus neither lost nor
    loaded twice. A row without a time is new unless the target holds its key without a time.
    Only the target's rows of the border are compared. While the target is empty all rows count.
    """
    mark = target.agg(F.max(time)).scalar()
    due = F.col(time).isNull() | mark.isNull() | (F.col(time) >= mark)
    border = target.filter(F.col(time).isNull() | (F.col(time) == mark))
    named = [f"_held_{k}" for k in range(len(keys) + 1)]
    held = border.select(*[F.col(c).alias(n) for c, n in zip([*keys, time], named, strict=True)])
    same = F.lit(True)
    for c, n in zip([*keys, time], named, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(n))
    return source.filter(due).join(held, same, "left_anti")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """Target rows not in source, plus source. Repeated source keys are deduplicated first."""
    fresh = dedup_latest(source, keys, order_by)
    kept = target.join(fresh.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh.select(*target.columns))
