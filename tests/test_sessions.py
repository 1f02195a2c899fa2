"""Sessions and days from streams whose state expires, against the batch."""

import os
import shutil

import pytest
from conftest import DATA, rows_of
from pyspark.sql import functions as F

from tallymart.operators import features, silver, staging
from tallymart.plans.lakehouse import Lakehouse
from tallymart.sources import files
from tallymart.sources.commits import Commits
from tallymart.streaming.sessions import SessionLog, _finish


def batch_of(raw):
    staged = silver.latest_sessions(staging.stage_clickstream(raw))
    return staged, features.activity_from_log(staged)


def same(log, raw):
    sessions, days = batch_of(raw)
    assert rows_of(log.sessions().select(*sessions.columns)) == rows_of(sessions)
    assert rows_of(log.days().select(*days.columns)) == rows_of(days)


def parts(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """The raw log in eight files, records dealt at random."""
    raw = Lakehouse(spark, str(DATA)).raw("clickstream")
    path = str(tmp_path_factory.mktemp("raw"))
    raw.repartition(8, F.xxhash64("event_id", F.lit(3))).write.mode("append").parquet(path)
    return raw, lambda: spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("lateness", ["40 days", "2 days"])
def test_eight_shuffled_files_equal_the_batch(spark, tmp_path, shuffled, lateness):
    raw, stream = shuffled
    log = SessionLog(spark, stream(), str(tmp_path / "log"), lateness)
    log.run()
    same(log, raw)
    facts = log.commits().agg(F.count("batch"), F.sum("rows"), F.sum("late")).first()
    assert facts[0] == 8 and facts[1] == raw.count() and facts[2] == log.late().count()
    assert (facts[2] > 0) == (lateness == "2 days")


def test_a_day_gets_few_files_however_many_state_partitions(spark, tmp_path):
    source, root = str(tmp_path / "src"), str(tmp_path / "log")
    rows = [(str(k), f"s-{k}", k, f"2024-01-{1 + k % 2:02} 10:00:00", 5) for k in range(120)]
    record(spark, source, *rows, ("last", "last", 1, "2024-02-01 10:00:00", None))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        log = SessionLog(spark, files.stream_clickstream(spark, source), root)
        _finish(log.land())
        _finish(log.close())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    folders = [os.path.dirname(f) for f in parts(root + "/sessions") if "event_date=2024-01" in f]
    assert len(set(folders)) == 2 and max(map(folders.count, folders)) <= 8
    batch = silver.latest_sessions(staging.stage_clickstream(files.read_clickstream(spark, source)))
    assert rows_of(log.sessions().select(*batch.columns)) == rows_of(batch)


def test_no_state_stays_in_memory_after_its_task(spark, tmp_path):
    source, root = str(tmp_path / "src"), str(tmp_path / "log")
    rows = [(str(k), f"s-{k}", k, f"2024-01-{1 + k % 2:02} 10:00:00", 5) for k in range(2000)]
    record(spark, source, *rows, ("last", "last", 1, "2024-02-01 10:00:00", None))
    settings = ["spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.maxBatchesToRetainInMemory"]
    before = [spark.conf.get(key) for key in settings]
    log = SessionLog(spark, files.stream_clickstream(spark, source), root)
    _finish(log.land())
    for step in (log.close, log.count):
        query = step()
        _finish(query)
        operators = [o for p in query.recentProgress for o in p["stateOperators"]]
        assert sum(o["numRowsUpdated"] for o in operators) >= 2000
        # four partitions; what is left of each is the empty store
        assert max(o["memoryUsedBytes"] for o in operators) < 4 * 2000
    assert [spark.conf.get(key) for key in settings] == before
    same(log, files.read_clickstream(spark, source))


def record(spark, path, *records):
    rows = [(e, s, u, t, [{"type": "view", "time_offset": o}] if o is not None else None) for e, s, u, t, o in records]
    df = spark.createDataFrame(rows, "event_id string, session_id string, user_id long, timestamp string, "
                                     "actions array<struct<type: string, time_offset: int>>")
    df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withColumn(
        "ingest_date", F.lit("2024-01-01")).coalesce(1).write.mode("append").partitionBy("ingest_date").json(path)


def test_batches_append_and_late_records_are_kept_and_counted(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "log")

    def step(*records):
        record(spark, src, *records)
        before = parts(root + "/sessions") | parts(root + "/days")
        log = SessionLog(spark, files.stream_clickstream(spark, src), root)
        log.run()
        assert before <= parts(root + "/sessions") | parts(root + "/days"), "nothing is rewritten"
        same(log, files.read_clickstream(spark, src))
        return log

    log = step(("1", "a", 1, "2024-01-01 10:00:00", 5), ("2", "b", 1, "2024-01-05 10:00:00", None))
    assert log.late().count() == 0
    log = step(("3", "a", 1, "2024-01-01 11:00:00", 7), ("4", "c", 2, "2024-01-09 10:00:00", 90_000_000))
    assert [r.event_id for r in log.late().collect()] == ["3"]  # newer than its closed session
    log = step(("5", "d", 1, "2024-01-02 10:00:00", 3), ("6", "b", 1, None, 2), ("7", None, 3, "2024-01-20 10:00:00", 1))
    assert sorted(r.event_id for r in log.late().collect()) == ["3", "5", "6"]
    log = step(("4", "c", 2, "2024-01-09 10:00:00", 90_000_000), ("8", "e", None, "2024-02-20 10:00:00", 1))
    found = log.commits().groupBy().agg(F.sum("rows"), F.sum("late")).first()
    assert tuple(found) == (9, log.late().count())
    files_now = parts(root + "/sessions")
    step(("9", "f", 9, "2024-02-20 11:00:00", 1))  # one more session closes none
    assert parts(root + "/sessions") == files_now


def test_a_stream_without_records(spark, tmp_path):
    src = str(tmp_path / "src")
    record(spark, src)
    os.makedirs(src, exist_ok=True)
    log = SessionLog(spark, files.stream_clickstream(spark, src), str(tmp_path / "log"))
    log.run()
    assert log.sessions().count() == 0 and log.days().count() == 0 and log.late().count() == 0


def test_a_batch_that_is_run_again_is_skipped_and_a_fresh_checkpoint_is_not(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "log")
    record(spark, src, ("1", "a", 1, "2024-01-01 10:00:00", 5))
    make = lambda: SessionLog(spark, files.stream_clickstream(spark, src), root)
    make().run()
    landed = parts(root + "/landed")
    checkpoint = tmp_path / "log" / "checkpoints" / "landed"
    for f in (checkpoint / "commits").iterdir():  # the driver was lost before the checkpoint moved on
        f.unlink()
    _finish(make().land())
    assert parts(root + "/landed") == landed, "the record says the batch is done"
    # lost between the data and the record: the batch is done again, in the same folder
    for f in (checkpoint / "commits").iterdir():
        f.unlink()
    shutil.rmtree(root + "/landed-commits")
    _finish(make().land())
    assert len(parts(root + "/landed")) == len(landed)
    # a fresh checkpoint counts its batches from 0 again, under another id
    record(spark, src, ("2", "b", 1, "2024-01-03 10:00:00", 5))
    shutil.move(str(checkpoint), str(tmp_path / "old"))
    make().run()
    assert {r["batch"] for r in make().commits().collect()} == {0}
    assert Commits(spark, root + "/landed").all().select("query").distinct().count() == 2
    same(make(), files.read_clickstream(spark, src))
