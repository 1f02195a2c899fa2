"""Compaction that touches undersized files only.

The small files of a folder are packed into bins near the target size; every bin becomes one
file, and files that are large enough, or find no company, keep their names and bytes.

The new files are written aside, below ``_compaction`` in the table, where no reader looks. A
journal that names old and new files is the point from which the change counts: a run that
is lost before it leaves the table as it was, one that is lost after it is completed by the
next run or by ``recover``. While the files are exchanged a reader may see some rows twice.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# packing runs in tasks, whose workers need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A file or bin between these shares of the target is good.
LEAST, MOST = 0.8, 1.2
_BINS = "file string, bin string"


def pack(sizes: Sequence[int], target: float) -> list[list[int]]:
    """Positions of ``sizes`` in bins: first fit, largest first, no bin above ``MOST`` of the target.

    Bins below ``LEAST`` are put together if that makes them fewer files; a file
    that stays alone is in no bin.
    """
    bins: list[list[int]] = []
    room: list[float] = []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        at = next((b for b, left in enumerate(room) if sizes[k] <= left), None)
        if at is None:
            bins.append([])
            room.append(MOST * target)
            at = len(bins) - 1
        bins[at].append(k)
        room[at] -= sizes[k]
    full = [b for b, left in zip(bins, room, strict=True) if (MOST * target - left) >= LEAST * target]
    rest = [b for b in bins if b not in full]
    # two bins that are not full do not fit into one: they stay apart
    return [b for b in [*full, *rest] if len(b) > 1]


def files_of(df: DataFrame) -> DataFrame:
    """(file, folder, bytes) of the files a table reads; no column is read."""
    meta = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    found = meta.groupBy("file").agg(F.max("bytes").alias("bytes"))
    return found.withColumn("folder", F.regexp_extract("file", "^(.*)/[^/]*$", 1))


def bins_of(files: DataFrame, target: float) -> DataFrame:
    """(file, bin) of the undersized files that are worth merging.

    A folder's small files are packed in one task: names and sizes, not rows.
    """

    def per_folder(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("file").reset_index(drop=True)
        found = pack(some["bytes"].tolist(), target)
        rows = [(some["file"][k], uuid.uuid5(uuid.NAMESPACE_URL, "|".join(some["file"][b])).hex) for b in found for k in b]
        return pd.DataFrame(rows, columns=["file", "bin"])

    small = files.filter(F.col("bytes") < LEAST * target)
    return small.groupBy("folder").applyInPandas(per_folder, _BINS)


def compact_small_files(
    spark: SparkSession, path: str, by: Sequence[str] = (), target_mb: float = 128, where: Column | None = None
) -> int:
    """Merge undersized files of the Parquet table at ``path`` in place; the number of files merged.

    ``by`` are the table's partition columns; ``where``, on them, limits the folders looked at.
    """
    recover(path)
    table = spark.read.parquet(path)
    chosen = table if where is None else table.filter(where)
    bins = bins_of(files_of(chosen), target_mb * 2**20)
    run = uuid.uuid4().hex
    aside = f"{path.rstrip('/')}/_compaction/{run}"
    bins.write.parquet(f"{aside}/bins")
    bins = spark.read.schema(_BINS).parquet(f"{aside}/bins")
    names = sorted(r["bin"] for r in bins.select("bin").distinct().toLocalIterator())
    if not names:
        return 0
    numbered = bins.join(F.broadcast(spark.createDataFrame(list(enumerate(names)), "_task int, bin string")), "bin")
    rows = chosen.withColumn("_file", F.col("_metadata.file_path")).join(
        numbered.withColumnsRenamed({"file": "_file", "bin": "_bin"}), "_file"
    )
    # a bin's rows meet in a task of their own, which writes them to its one file as they come
    dealt = rows.repartitionById(len(names), F.col("_task")).drop("_file", "_task")
    with _unsorted(spark):
        dealt.write.partitionBy(*by, "_bin").parquet(f"{aside}/new")
    old = [r["file"] for r in bins.select("file").toLocalIterator()]
    system, at = fs.FileSystem.from_uri(aside)
    staged = system.get_file_info(fs.FileSelector(f"{at}/new", recursive=True))
    new = [f.path for f in staged if f.type == fs.FileType.File and f.path.endswith(".parquet")]
    _write(system, f"{_root(path)[1]}/_compaction/journal.json", {"run": at, "old": old, "new": new})
    recover(path)
    return len(old)


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """A task that writes a single folder does not sort its rows by folder, which would hold a whole bin in memory."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _root(path: str) -> tuple[fs.FileSystem, str]:
    system, at = fs.FileSystem.from_uri(path)
    return system, at.rstrip("/")


def _write(system: fs.FileSystem, path: str, value: dict) -> None:
    with system.open_output_stream(f"{path}.part") as out:
        out.write(json.dumps(value).encode())
    system.move(f"{path}.part", path)


def _exists(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound


def _places(root: str, run: str, new: Sequence[str]) -> Iterator[tuple[str, str]]:
    """Where each file is staged, and its place in the table: its folder without the bin."""
    for file in new:
        *folders, last, name = file.removeprefix(f"{run}/new/").split("/")
        yield file, "/".join([root, *folders, f"{last.removeprefix('_bin=')}-{name}"])


def recover(path: str) -> bool:
    """Complete an exchange of files that its journal says has begun; whether there was one."""
    system, root = _root(path)
    journal = f"{root}/_compaction/journal.json"
    if not _exists(system, journal):
        return False
    with system.open_input_stream(journal) as source:
        plan = json.loads(source.read())
    for staged, place in _places(root, plan["run"], plan["new"]):
        if _exists(system, staged):
            system.move(staged, place)
    for file in plan["old"]:
        gone = fs.FileSystem.from_uri(file)[1]
        if _exists(system, gone):
            system.delete_file(gone)
    system.delete_file(journal)
    return True
