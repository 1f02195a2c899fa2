"""Compaction: good files untouched, sizes near the target, lost runs completed."""

import os
import random
from pathlib import Path

import pytest
from conftest import rows_of
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymart.sources import compaction

MB = 2**20
BY = ["part"]


def files(path):
    return {str(f.relative_to(path)): f.stat().st_size for f in Path(path).rglob("*.parquet") if "_compaction" not in f.parts}


def table(spark, path, sizes):
    """A file of about the given bytes per entry (part, bytes), of rows that do not compress."""
    at = 0
    for part, size in sizes:
        rows = max(1, size // 40)
        df = spark.range(at, at + rows).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
        df = df.withColumn("text", F.unhex("text")).withColumn("part", F.lit(part))
        df.coalesce(1).write.mode("append").partitionBy("part").parquet(path)
        at += rows


@given(st.lists(st.integers(1, 80), max_size=60))
def test_bins_hold_files_once_and_are_near_the_target(sizes):
    bins = compaction.pack(sizes, 100)
    held = [k for b in bins for k in b]
    assert len(held) == len(set(held)) and all(len(b) > 1 for b in bins)
    sums = [sum(sizes[k] for k in b) for b in bins]
    assert all(s <= 120 for s in sums) and sum(s < 80 for s in sums) <= 1
    alone = [s for k, s in enumerate(sizes) if k not in held]
    # what is left cannot be merged: no two of the unfilled fit together
    loose = alone + [s for s in sums if s < 80]
    assert all(a + b > 120 for i, a in enumerate(loose) for b in loose[:i])


def test_only_undersized_files_change(spark, tmp_path):
    path = str(tmp_path / "table")
    draw = random.Random(2)
    small = [("a b/c", draw.randrange(20_000, 300_000)) for _ in range(14)] + [("y", 50_000), ("y", 60_000), ("z", 9_000)]
    table(spark, path, [("a b/c", 1_000_000), ("y", 2_500_000), *small])
    before, rows = files(path), rows_of(spark.read.parquet(path).select("id", "part"))
    big = {n: s for n, s in before.items() if s > 0.8 * MB}
    assert len(big) == 2
    merged = compaction.compact_small_files(spark, path, BY, target_mb=1)
    after = files(path)
    assert merged == 16 and rows_of(spark.read.parquet(path).select("id", "part")) == rows
    for name, size in big.items():
        assert after[name] == size
    lonely = [n for n in before if n.startswith("part=z/")]
    assert lonely[0] in after
    new = {n: s for n, s in after.items() if n not in before}
    near = [s for s in new.values() if 0.8 * MB <= s <= 1.2 * MB]
    assert len(near) >= len(new) - 2  # one rest per folder may be smaller
    assert compaction.compact_small_files(spark, path, BY, target_mb=1) == 0 and files(path) == after


def test_where_limits_the_folders(spark, tmp_path):
    path = str(tmp_path / "table")
    table(spark, path, [("a", 9_000), ("a", 9_000), ("b", 9_000), ("b", 9_000)])
    before = files(path)
    assert compaction.compact_small_files(spark, path, BY, 1, F.col("part") == "a") == 2
    assert {n for n in before if n.startswith("part=b")} <= files(path).keys() and len(files(path)) == 3


def test_every_bin_has_a_task_of_its_own(spark, tmp_path):
    path = str(tmp_path / "table")
    table(spark, path, [(f"p{k % 12:02}", 4_000) for k in range(24)])
    rows = rows_of(spark.read.parquet(path).select("id", "part"))
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    assert compaction.compact_small_files(spark, path, BY, 1) == 24
    tasks = [name.split("-part-")[1].split("-")[0] for name in files(path)]
    assert len(tasks) == len(set(tasks)) == 12
    assert rows_of(spark.read.parquet(path).select("id", "part")) == rows and spark.conf.get(key, None) == before


@pytest.mark.parametrize("lost", ["before the journal", "before the moves", "between", "before the journal goes"])
def test_a_lost_run_is_undone_or_completed(spark, tmp_path, monkeypatch, lost):
    path = str(tmp_path / "table")
    table(spark, path, [("a", 9_000), ("a", 8_000), ("b", 7_000), ("b", 6_000)])
    rows, before = rows_of(spark.read.parquet(path).select("id", "part")), files(path)

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        if lost == "before the journal":
            patch.setattr(compaction, "_write", stop)
        else:
            real = compaction.recover
            patch.setattr(compaction, "recover", lambda p: stop() if os.path.exists(path + "/_compaction/journal.json") else real(p))
        with pytest.raises(KeyboardInterrupt):
            compaction.compact_small_files(spark, path, BY, 1)
    assert rows_of(spark.read.parquet(path).select("id", "part")) == rows and files(path) == before
    if lost in ("between", "before the journal goes"):
        with monkeypatch.context() as patch:
            seen = []
            limit = 5 if lost == "between" else 10**6
            real_exists = compaction._exists
            patch.setattr(compaction, "_exists", lambda s, p: stop() if len(seen) > limit else seen.append(p) or real_exists(s, p))
            if lost == "between":
                with pytest.raises(KeyboardInterrupt):
                    compaction.recover(path)
    done = compaction.recover(path)
    assert done == (lost != "before the journal")
    assert rows_of(spark.read.parquet(path).select("id", "part")) == rows
    assert len(files(path)) == (2 if done else 4)
