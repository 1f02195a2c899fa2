"""Streaming forms against their batch twins."""

import shutil

from conftest import DATA, rows_of
from pyspark.sql import functions as F

from tallymart.operators import campaign, features, silver, staging
from tallymart.plans.lakehouse import Lakehouse
from tallymart.sources import files, warehouse
from tallymart.streaming import ingest


def log(spark, path, *records):
    """Append raw records (event, session, user, timestamp) as one NDJSON file."""
    rows = spark.createDataFrame(list(records),
                                 "event_id string, session_id string, user_id long, timestamp string")
    rows = rows.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows.withColumn("ingest_date", F.to_date("timestamp")).coalesce(1).write.mode(
        "append").partitionBy("ingest_date").json(path)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def write(df, path, checkpoint):
    finish(df.writeStream.format("parquet").option("path", path)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def shuffled(spark, tmp_path):
    """The raw log as eight files in random order, read one file per batch."""
    raw = Lakehouse(spark, str(DATA)).raw("clickstream")
    path = str(tmp_path / "raw")
    raw.repartition(8, F.xxhash64("event_id", F.lit(3))).write.parquet(path)
    return raw, lambda: spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_merged_sessions_equal_the_batch_whatever_the_order(spark, tmp_path):
    raw, stream = shuffled(spark, tmp_path)
    sessions, daily = str(tmp_path / "sessions"), str(tmp_path / "daily")
    finish(ingest.merge_sessions(stream(), sessions, str(tmp_path / "ck"), buckets=2, daily=daily))
    staged = staging.stage_clickstream(raw)
    merged = spark.read.schema(staged.schema).parquet(sessions).drop("bucket")
    assert rows_of(silver.silver_user_sessions(merged)) == rows_of(silver.silver_user_sessions(staged))
    batch = features.activity_from_log(silver.latest_sessions(staged))
    got = ingest.read_daily(spark, daily, batch.schema).drop("month")
    assert rows_of(got.select(*batch.columns)) == rows_of(batch)


def test_a_late_record_corrects_the_session_and_its_days(spark, tmp_path):
    src, sessions, daily, ck = (str(tmp_path / n) for n in ("src", "sessions", "daily", "ck"))

    def run():
        raw = files.stream_clickstream(spark, src)
        finish(ingest.merge_sessions(raw, sessions, ck, buckets=2, daily=daily))
        schema = features.activity_from_log(
            silver.latest_sessions(staging.stage_clickstream(files.read_clickstream(spark, src)))
        ).schema
        rows = ingest.read_daily(spark, daily, schema).orderBy("activity_date").collect()
        return [(r.user_id, str(r.activity_date), r.sessions) for r in rows]

    log(spark, src, ("1", "a", 1, "2024-01-01 10:00:00"), ("2", "b", 1, "2024-01-05 10:00:00"))
    assert run() == [(1, "2024-01-01", 1), (1, "2024-01-05", 1)]
    log(spark, src, ("3", "c", 1, "2024-01-01 11:00:00"))  # four days late
    assert run() == [(1, "2024-01-01", 2), (1, "2024-01-05", 1)]
    log(spark, src, ("4", "b", 1, "2024-01-06 10:00:00"))  # a newer record moves its session
    assert run() == [(1, "2024-01-01", 2), (1, "2024-01-06", 1)]
    log(spark, src, ("5", "b", 1, "2024-01-02 10:00:00"))  # an older one changes nothing
    assert run() == [(1, "2024-01-01", 2), (1, "2024-01-06", 1)]


def test_landing_is_exactly_once_over_restarts(spark, tmp_path):
    path, ck = str(tmp_path / "landing"), str(tmp_path / "ck")
    for _ in range(2):
        finish(ingest.land_clickstream(warehouse.stream_raw(spark, str(DATA)), path, ck))
    lake = Lakehouse(spark, str(DATA))
    landed = files.read_clickstream(spark, path)
    assert landed.count() == lake.raw("clickstream").count()
    days = landed.groupBy("ingest_date").count()
    batch = lake.staged("clickstream").groupBy("ingest_date").count()
    assert rows_of(days) == rows_of(batch)


def test_campaign_upsert_stream_replaces_earlier_scores(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    feats = Lakehouse(spark, str(DATA)).behaviour
    early = feats.withColumn("sessions_3d", F.lit(0).cast("bigint"))

    def run(rows):
        rows.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(feats.schema).parquet(src)
        finish(ingest.upsert_stream(
            stream, lambda b: campaign.campaign(campaign.score_rule(b)), out, ck,
            campaign.CAMPAIGN_KEY, ["year", "month", "day"]))

    run(early)
    run(feats)
    expected = campaign.campaign(campaign.score_rule(feats))
    got = spark.read.schema(expected.schema).parquet(out)
    assert rows_of(got) == rows_of(expected)


def test_the_event_table_may_be_a_folder_of_files(spark, tmp_path):
    events = spark.read.parquet(str(DATA / "events.parquet"))
    events.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    out = str(tmp_path / "out")
    raw = warehouse.stream_raw(spark, str(tmp_path)).select("event_id", "session_id")
    write(raw, out, str(tmp_path / "ck"))
    lake = Lakehouse(spark, str(DATA))
    assert rows_of(spark.read.parquet(out)) == rows_of(
        lake.raw("clickstream").select("event_id", "session_id"))


def upserts(spark, tmp_path):
    """A table of (id, part, value) kept by a stream over files, and a way to run it."""
    src, out, ck = (tmp_path / n for n in ("src", "out", "ck"))

    def run(*rows):
        if rows:
            df = spark.createDataFrame(list(rows), "id long, part int, value string")
            df.coalesce(1).write.mode("append").parquet(str(src))
        stream = spark.readStream.schema("id long, part int, value string").parquet(str(src))
        finish(ingest.upsert_stream(stream, lambda b: b, str(out), str(ck), ["id"], ["part"]))
        return rows_of(spark.read.schema("id long, value string, part int").parquet(str(out)))

    return run, out, ck


def lose_last_commit(ck):
    """As if the driver had been lost before the checkpoint moved on."""
    last = max((f for f in (ck / "commits").iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    for f in (last, last.with_name(f".{last.name}.crc")):
        f.unlink(missing_ok=True)


def test_a_replayed_batch_does_not_bring_old_rows_back(spark, tmp_path):
    run, out, ck = upserts(spark, tmp_path)
    run((1, 0, "first"), (2, 1, "first"))
    fix = spark.createDataFrame([(1, 0, "mended by hand")], "id long, part int, value string")
    ingest.upsert_partitioned(spark, str(out), fix, ["id"], ["part"])
    lose_last_commit(ck)
    assert run() == [(1, "mended by hand", 0), (2, "first", 1)]


def test_a_crash_between_two_folders_is_completed(spark, tmp_path):
    run, out, ck = upserts(spark, tmp_path)
    run((1, 0, "old"), (2, 1, "old"))
    shutil.copytree(out / "part=1", tmp_path / "kept")
    assert run((1, 0, "new"), (2, 1, "new")) == [(1, "new", 0), (2, "new", 1)]
    # the second folder was not moved into place yet, and neither record nor checkpoint written
    shutil.rmtree(out / "part=1")
    shutil.copytree(tmp_path / "kept", out / "part=1")
    records = sorted(tmp_path.glob("out-commits/query=*/batch=1"))
    shutil.rmtree(records[0])
    lose_last_commit(ck)
    assert run() == [(1, "new", 0), (2, "new", 1)]


def test_a_fresh_checkpoint_does_not_skip_its_batches(spark, tmp_path):
    run, out, ck = upserts(spark, tmp_path)
    run((1, 0, "one"))
    ck.rename(tmp_path / "lost")
    (tmp_path / "src").rename(tmp_path / "done")
    assert run((1, 0, "two"), (3, 2, "three")) == [(1, "two", 0), (3, "three", 2)]  # batch 0 again
