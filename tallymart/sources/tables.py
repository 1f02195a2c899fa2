"""Catalog tables, read by name; bucketed ones join and group by their key without an exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions


def bucket_of(key: str, buckets: int):
    """The bucket that Spark's bucketed tables give a key."""
    return F.pmod(F.hash(key), F.lit(buckets))


def save_bucketed(df: DataFrame, name: str, key: str, path: str, buckets: int | None = None) -> DataFrame:
    """Store ``df`` at ``path`` as the table ``name``, bucketed and sorted by ``key``, and read it back.

    Rows are brought together by bucket first, so a bucket is one file, or, where Spark finds it
    much larger than others, a few; a task never opens a file per bucket. ``buckets`` is the
    parallelism of later joins: tables to be joined need the same number.
    """
    buckets = buckets or shuffle_partitions(df.sparkSession)
    names = df.columns
    dealt = df.withColumn("_bucket", bucket_of(key, buckets)).hint("rebalance", "_bucket").select(*names)
    (
        dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
        .option("path", path).saveAsTable(name)
    )
    return df.sparkSession.table(name)


def drop(spark: SparkSession, name: str) -> None:
    """Take the table out of the catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
