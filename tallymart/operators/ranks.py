"""Exact ranks, quantiles and ranking metrics over any number of rows.

Rows are combined to one per distinct value first, on the map side too, so ties however
large are one row. The distinct values are range-partitioned and stored with their partition;
counts before a value are the counts of the partitions before, which are as many rows as there are partitions
and groups, plus a running count inside its partition. No window spans more than that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, shuffle_partitions

_WIDE = "decimal(38,0)"


def counts_before(
    df: DataFrame, group: Sequence[str], value: str, counts: Sequence[str], descending: bool = False
) -> DataFrame:
    """``df`` with ``before_<count>``: the sum of each count over the rows before in the group.

    Input holds one row per (group, value).
    """
    order = F.desc(value) if descending else F.asc(value)
    keys = [*[F.col(c) for c in group], order]
    parts = shuffle_partitions(df.sparkSession)
    placed = df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id())
    placed = materialise(df.sparkSession, placed, "ranks")
    totals = placed.groupBy(*group, "_part").agg(*[F.sum(c).alias(c) for c in counts])
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    totals = totals.select(
        *group, "_part", *[F.coalesce(F.sum(c).over(earlier), zero).alias(f"_from_{c}") for c in counts]
    )
    own = Window.partitionBy(*group, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumns({f"_own_{c}": F.coalesce(F.sum(c).over(own), zero) for c in counts})
    joined = running.join(totals, [*group, "_part"])
    before = [(F.col(f"_from_{c}") + F.col(f"_own_{c}")).alias(f"before_{c}") for c in counts]
    return joined.select(*df.columns, *before)


def quantiles(df: DataFrame, cols: Sequence[str], at: Sequence[float], name: str = "feature") -> DataFrame:
    """(name, q, value): for each column the least value with at least a share q of the rows up to it.

    Nulls and NaN do not count; all columns are read in one pass.
    """
    each = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(F.inline(each)).filter("value is not null and not isnan(value)")
    # -0.0 and 0.0 are one value
    distinct = long.groupBy(name, (F.col("value") + F.lit(0.0)).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranked = counts_before(distinct, [name], "value", ["n"])
    sizes = ranked.groupBy(name).agg(F.sum("n").alias("_rows"))
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in at])).alias("q")
    place = F.greatest(F.ceil(F.col("q").cast("decimal(10,6)") * F.col("_rows")), F.lit(1))
    hit = (F.col("before_n") < place) & (place <= F.col("before_n") + F.col("n"))
    return ranked.join(sizes, name).select("*", wanted).filter(hit).select(name, "q", "value")


def ranking_metrics(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row: exact areas under the ROC and the precision-recall curve, four decimals.

    Every distinct score is a threshold. A tie of a positive and a negative counts half, so the
    first area is the rank-sum statistic. The second joins the points (recall, precision)
    by straight lines, the first precision reaching back to recall 0. Null without both classes.
    """
    known = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    per_score = known.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    ranked = counts_before(per_score, [], "score", ["pos", "neg"], descending=True)
    pos, neg, above, false = (F.col(c).cast(_WIDE) for c in ("pos", "neg", "before_pos", "before_neg"))
    # twice the pairs in the right order
    pairs = (neg * (above * 2 + pos)).cast(_WIDE)
    here = (F.col("before_pos") + F.col("pos")) / (F.col("before_pos") + F.col("before_neg") + F.col("pos") + F.col("neg"))
    first = (F.col("before_pos") + F.col("before_neg")) == 0
    back = F.when(first, here).otherwise(F.try_divide(F.col("before_pos"), F.col("before_pos") + F.col("before_neg")))
    # decimals, so that the sum does not depend on the order of the rows
    strip = (F.col("pos").cast("double") * (here + back) / 2).cast("decimal(38,12)")
    totals = ranked.agg(
        F.sum(pairs).cast("double").alias("pairs"), F.sum(strip).cast("double").alias("strips"),
        F.sum("pos").cast("double").alias("p"), F.sum("neg").cast("double").alias("n"),
    )
    both = (F.col("p") > 0) & (F.col("n") > 0)
    return totals.select(
        F.when(both, F.round(F.col("pairs") / (2 * F.col("p") * F.col("n")), 4)).alias("auc_roc"),
        F.when(both, F.round(F.col("strips") / F.col("p"), 4)).alias("auc_pr"),
    )
