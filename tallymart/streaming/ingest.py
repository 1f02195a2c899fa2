"""Streaming forms of the ingest and feature steps.

Each function takes a streaming DataFrame of raw or staged clickstream records and
starts a query that stops once all files present are processed (``availableNow``);
run on a schedule it picks up where its checkpoint left off.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from ..operators.features import DAY, activity_from_log
from ..operators.incremental import upsert
from ..operators.silver import latest_sessions
from ..operators.staging import stage_clickstream
from ..sources.commits import Commits, query_id
from ..sources.files import TIME
from ..sources.sinks import upsert_partitioned


def land_clickstream(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append new records as NDJSON below ``ingest_date=YYYY-MM-DD`` folders."""
    return (
        raw.withColumn("ingest_date", F.to_date("timestamp"))
        .writeStream.format("json")
        .partitionBy("ingest_date")
        .option("path", path)
        .options(**TIME)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


#: Folders of the merged session table; a batch rewrites those its sessions fall in.
BUCKETS = 64


def _bucketed(staged: DataFrame, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64("session_id"), F.lit(buckets)).cast("int")
    return latest_sessions(staged).withColumn("bucket", bucket)


def merge_sessions(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    buckets: int = BUCKETS,
    daily: str | None = None,
) -> StreamingQuery:
    """Keep the newest record of every session, all columns, in a table at ``path``.

    Each batch is merged by session, so records may come late, again, and in any order:
    no watermark, nothing is dropped, and the table equals the batch dedup of all records
    seen. With ``daily``, the table of daily activity there is brought up to date as well.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commits, own = Commits(spark, path), query_id(spark)
        if commits.find(own, batch_id) is not None:
            return
        fresh = _bucketed(stage_clickstream(batch), buckets)
        if daily:
            # days the sessions counted in before; kept per batch, so a replay still knows them
            touched = f"{daily.rstrip('/')}-touched/query={own}/batch_id={batch_id}"
            fresh.limit(0).write.mode("append").partitionBy("bucket").parquet(path)
            known = spark.read.schema(fresh.schema).parquet(path)
            before = known.join(fresh.select("session_id"), "session_id", "left_semi")
            days = activity_from_log(fresh).select(*DAY).union(activity_from_log(before).select(*DAY))
            days.distinct().write.mode("append").parquet(touched)
        newest = lambda current, new: latest_sessions(current.unionByName(new))
        upsert_partitioned(spark, path, fresh, ["session_id"], ["bucket"], merge=newest)
        if daily:
            days = spark.read.schema("user_id bigint, activity_date date").parquet(touched).distinct()
            sessions = spark.read.schema(fresh.schema).parquet(path)
            owned = sessions.join(days.select("user_id").distinct(), "user_id", "left_semi")
            now = activity_from_log(owned).join(days, DAY, "left_semi")
            _replace_days(spark, daily, now, days)
        commits.record(own, batch_id)

    return (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _replace_days(spark: SparkSession, path: str, now: DataFrame, days: DataFrame) -> None:
    """Put ``now`` in place of the (user, day) rows named in ``days``, one folder per month."""
    month = F.date_format("activity_date", "yyyy-MM")
    gone = days.join(now.select(*DAY), DAY, "left_anti")
    rows = now.withColumn("_gone", F.lit(False)).unionByName(
        gone.withColumn("_gone", F.lit(True)), allowMissingColumns=True
    )
    rows = rows.withColumn("month", month)
    rest = lambda current, new: upsert(current, new, DAY)
    upsert_partitioned(spark, path, rows, DAY, ["month"], merge=rest)


def read_daily(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The daily table kept by ``merge_sessions``; ``schema`` is that of ``activity_from_log``."""
    table = spark.read.schema(StructType([*schema.fields, StructField("_gone", BooleanType())])).parquet(path)
    return table.filter("not _gone").drop("_gone")


def upsert_stream(
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    by: Sequence[str],
    order_by: Sequence[Column] = (),
) -> StreamingQuery:
    """Per batch: compute rows with ``build`` and merge them into a partitioned table.

    A batch leaves a record when all its folders are in place. Run again after that it changes
    nothing, so it cannot bring back rows that a later batch or another writer has replaced; run
    again before that, it completes the folders that were left old.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commits, own = Commits(spark, path), query_id(spark)
        if commits.find(own, batch_id) is not None:
            return
        upsert_partitioned(spark, path, build(batch), keys, by, order_by)
        commits.record(own, batch_id)

    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
