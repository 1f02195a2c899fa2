"""Sessions and their days as streams with state that expires.

Three queries, each with a checkpoint of its own below ``root``:

``land``   appends raw records, staged, batch by batch, and tells late ones apart: those not newer
           than the newest record of earlier batches less ``lateness``, and those without a
           time. They are kept and counted, not dropped.
``close``  holds the best record of every open session as streaming state, and appends it to the
           closed sessions once the watermark has passed its time by ``gap``; the state goes then.
``count``  sums closed sessions per user and day in event-time windows, and appends a day once
           the watermark has passed it.

All tables are only ever appended to, so the work of a batch follows from the batch and the
open state, not from the table. State lies in the checkpoint's files: a task holds that of its own
partition while it runs, an executor no other, so memory follows from the partitions of the
shuffle and not from all sessions of a batch. What a reader wants is put together on reading, exactly:

* sessions: the closed ones, landed records newer than those (sessions still open), and the
  late records, the newest of each session;
* days: those closed, less the (user, day) pairs that late records touch, which are summed
  anew, and the days after the last closed one.

Records of a session follow one another within ``gap``; a session that goes on later counts as
another one in the days, and as one in ``sessions``. An action further than ``reach`` from its
session's time is kept out of the windows, so that it cannot move their watermark, and its day
is summed anew on reading.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import features
from ..operators.silver import latest_sessions
from ..operators.staging import stage_clickstream
from ..sources.commits import Commits, query_id

DAY_MS = "1 day"
#: Files of a batch's closed sessions of one day, at most (and of strays as many).
DAY_PARTS = 8
#: No partition's state stays in memory after its task; the store keeps the last two versions of all otherwise.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "spark.sql.streaming.maxBatchesToRetainInMemory": "0",
}


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session with ``conf`` for as long as a query starts, which takes its settings along."""
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@dataclass(frozen=True)
class SessionLog:
    """The stream ``raw`` of click records, and the tables that grow from it below ``root``."""

    spark: SparkSession
    raw: DataFrame
    root: str
    lateness: str = "1 day"
    gap: str = "1 hour"
    reach_seconds: int = 86_400

    @cached_property
    def schema(self) -> StructType:
        return stage_clickstream(self.raw).schema

    @cached_property
    def _landed_schema(self) -> StructType:
        return StructType.fromDDL(f"{self.schema.toDDL()}, query string, batch int, late boolean")

    @cached_property
    def _closed_schema(self) -> StructType:
        return StructType.fromDDL(f"{self.schema.toDDL()}, stray boolean")

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _start(self, df: DataFrame, name: str, *by: str) -> StreamingQuery:
        """Append to the table ``name``; the sink's own log makes every batch count once."""
        with _settings(self.spark, STATE):
            return (
                df.writeStream.format("parquet")
                .partitionBy(*by)
                .option("path", self._path(name))
                .option("checkpointLocation", self._path(f"checkpoints/{name}"))
                .outputMode("append")
                .trigger(availableNow=True)
                .start()
            )

    def _table(self, name: str, schema: StructType | str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self._path(name))
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" in str(missing):
                return self.spark.createDataFrame([], schema)
            raise

    def _stream(self, name: str, schema: StructType) -> DataFrame:
        if self._table(name, schema).isEmpty():  # a source folder must exist
            self.spark.createDataFrame([], schema).write.mode("append").parquet(self._path(name))
        return self.spark.readStream.schema(schema).parquet(self._path(name))

    # --- the streams
    def land(self) -> StreamingQuery:
        """Stage and append the records at hand, late ones in folders of their own."""
        path, lateness = self._path("landed"), F.expr(f"INTERVAL {self.lateness}")

        def sink(batch: DataFrame, number: int) -> None:
            spark = batch.sparkSession
            commits, query = Commits(spark, path), query_id(spark)
            if commits.find(query, number) is not None:
                return
            before = commits.newest_before(query, number)
            at = F.col("event_timestamp")
            late = at.isNull() if before is None else at.isNull() | (at <= F.lit(before) - lateness)
            seen = Observation()
            (
                stage_clickstream(batch)
                .withColumn("late", late)
                .observe(
                    seen, F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("late"), F.max(at).alias("newest")
                )
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .partitionBy("late")
                .parquet(f"{path}/query={query}/batch={number}")
            )
            facts = seen.get
            newest = max((t for t in (before, facts["newest"]) if t is not None), default=None)
            commits.record(query, number, rows=facts["rows"], late=facts["late"], newest=newest)

        return (
            self.raw.writeStream.foreachBatch(sink)
            .option("checkpointLocation", self._path("checkpoints/landed"))
            .trigger(availableNow=True)
            .start()
        )

    def close(self) -> StreamingQuery:
        """Append the sessions that have expired, one row each, as the batch dedup picks it."""
        rest = [c for c in self.schema.names if c != "session_id"]
        # the least such row is the newest record, ties in the order of the other columns
        ranked = F.struct((-F.unix_micros("event_timestamp")).alias("_newest"), *rest)
        closed = (
            self._stream("landed", self._landed_schema)
            .filter("not late and session_id is not null")
            .withWatermark("event_timestamp", self.lateness)
            .groupBy("session_id", F.session_window("event_timestamp", self.gap))
            .agg(F.min(ranked).alias("best"))
        )
        names = [F.col("session_id") if c == "session_id" else F.col(f"best.{c}") for c in self.schema.names]
        # a state partition holds all days: without this, a batch writes a file for every partition and day
        part = F.pmod(F.xxhash64("session_id"), F.lit(DAY_PARTS))
        out = closed.select(*names).withColumn("stray", self._strays()).repartition("event_date", part)
        return self._start(out, "sessions", "stray", "event_date")

    def count(self) -> StreamingQuery:
        """Append the (user, day) rows of the days that are over."""
        rows = features.activity_rows(self._stream("sessions", self._closed_schema).filter("not stray"))
        # sessions come in the order of their times, batch by batch; actions lie within reach
        per_product = (
            rows.withWatermark("happened", f"{2 * self.reach_seconds + 1} seconds")
            .groupBy("user_id", F.window("happened", DAY_MS), F.col("act.product_id").alias("product_id"))
            .agg(*features.product_sums())
        )
        per_day = per_product.groupBy("user_id", "window").agg(*features.day_sums())
        dated = per_day.withColumn("activity_date", F.to_date("window.start")).drop("window")
        return self._start(dated, "days", "activity_date")

    def run(self) -> None:
        """All three once, over what is there."""
        for step in (self.land, self.close, self.count):
            _finish(step())

    # --- reading
    def _strays(self) -> Column:
        far = F.exists("actions", lambda a: F.abs(F.coalesce(a["time_offset"], F.lit(0))) > self.reach_seconds)
        return F.coalesce(far, F.lit(False))

    def late(self) -> DataFrame:
        """The records that came too late for the state, or have no time."""
        return self._table("landed", self._landed_schema).filter("late").select(*self.schema.names)

    def commits(self) -> DataFrame:
        """Rows, late rows and newest time of every batch."""
        return Commits(self.spark, self._path("landed")).all()

    def _closed(self) -> DataFrame:
        return self._table("sessions", self._closed_schema)

    def _open(self) -> DataFrame:
        """The records on time that are newer than all closed sessions: those of open ones."""
        last = self._closed().agg(F.max("event_timestamp")).scalar()
        landed = self._table("landed", self._landed_schema).filter("not late")
        newer = landed.filter(last.isNull() | (F.col("event_timestamp") > last))
        return newer.select(*self.schema.names)

    def sessions(self) -> DataFrame:
        """The newest record of every session, as the batch dedup of all records has it."""
        closed = self._closed().select(*self.schema.names)
        return latest_sessions(closed.unionByName(self._open()).unionByName(self.late()))

    def days(self) -> DataFrame:
        """Daily activity of all sessions, as the batch has it.

        Without late records only the open days are summed here, from the last folders of the
        closed sessions and from open ones.
        """
        names = [c for c in self._days_schema.names]
        counted = self._table("days", self._days_schema)
        last = counted.agg(F.max("activity_date")).scalar()
        day, closed = F.col("activity_date"), self._closed()
        strays = closed.filter("stray").select(*self.schema.names)
        steady = closed.filter("not stray").select(*self.schema.names)
        reach = F.make_dt_interval(secs=F.lit(self.reach_seconds))
        # folders of days whose sessions can reach an open day
        near = last.isNull() | (F.col("event_date") >= F.to_date(F.date_add(last, 1).cast("timestamp") - reach))
        later = last.isNull() | day.isNull() | (day > last)

        if not self.commits().agg(F.sum("late")).first()[0]:
            now = steady.filter(near).unionByName(latest_sessions(self._open()))
            recent = features.activity_from_log(now.unionByName(strays)).filter(later)
            touched, anew = self._days_of(strays), strays
            reworked = steady
        else:
            late = self.late()
            own = late.select("session_id").distinct()
            held = steady.join(own, "session_id", "left_semi").unionByName(self._open())
            mended = latest_sessions(held.unionByName(late).unionByName(strays))
            untouched = steady.join(own, "session_id", "left_anti")
            recent = features.activity_from_log(untouched.filter(near).unionByName(mended)).filter(later)
            moved = steady.join(own, "session_id", "left_semi").unionByName(late).unionByName(strays)
            touched, anew, reworked = self._days_of(moved), mended, untouched
        users = touched.select("user_id").distinct()
        owned = reworked.join(users, "user_id", "left_semi").unionByName(anew.join(users, "user_id", "left_semi"))
        again = features.activity_from_log(owned).filter(day <= last).join(touched, features.DAY, "left_semi")
        kept = counted.join(touched, features.DAY, "left_anti")
        return kept.select(*names).unionByName(again.select(*names)).unionByName(recent.select(*names))

    @cached_property
    def _days_schema(self) -> StructType:
        return features.activity_from_log(self.spark.createDataFrame([], self.schema)).schema

    def _days_of(self, sessions: DataFrame) -> DataFrame:
        """The (user, day) pairs that sessions count in."""
        rows = features.activity_rows(sessions)
        return rows.select("user_id", F.to_date("happened").alias("activity_date")).distinct()
