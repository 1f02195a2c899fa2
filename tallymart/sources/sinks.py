"""Writers: partitioned tables, in-place upserts, compaction and clustering."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.incremental import upsert
from .files import TIME

YMD = ["year", "month", "day"]


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str] = YMD, mode: str = "overwrite"
) -> None:
    """Write one folder per partition value.

    The rebalance hint groups rows by partition value, so a task does not open a file
    per day, and lets Spark split a value that is larger than one file.
    """
    (
        df.hint("rebalance", *by)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_json_days(df: DataFrame, path: str, day: str = "ingest_date") -> None:
    """Write NDJSON, one folder per day."""
    df.hint("rebalance", day).write.mode("overwrite").options(**TIME).partitionBy(day).json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write a one-row metrics frame as a single JSON line."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def upsert_partitioned(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    by: Sequence[str] = YMD,
    order_by: Sequence[Column] = (),
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> None:
    """Merge ``source`` into a partitioned table, rewriting only the partitions it touches.

    ``by`` must follow from ``keys``, so a key never moves between partitions. A dynamic
    partition overwrite writes aside and moves folder after folder into place once all
    tasks have succeeded; a driver lost between two moves leaves some partitions old, and
    running the same batch again completes them. ``merge(current, source)`` may replace
    the plain upsert. The batch is kept beside the table, in a folder the next one reuses.
    """
    schema, delta = source.schema, f"{path.rstrip('/')}-delta"
    source.write.mode("overwrite").parquet(delta)  # read several times below
    source = spark.read.schema(schema).parquet(delta)
    source.limit(0).write.mode("append").partitionBy(*by).parquet(path)  # table exists
    target = spark.read.schema(source.schema).parquet(path)
    current = _only_partitions(target, source.select(*by).distinct(), by)
    merged = merge(current, source) if merge else upsert(current, source, keys, order_by)
    write_partitioned(merged, path, by)


def _only_partitions(table: DataFrame, touched: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of ``table`` in the ``touched`` partitions.

    The partitions become a set of literals, so the scan skips all other folders. They are
    folder names of one batch, which the driver lists in any case when it writes them.
    """
    name = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in by])
    wanted = [row[0] for row in touched.select(name).distinct().collect()]
    return table.filter(name.isin(wanted))


def table_size(df: DataFrame) -> DataFrame:
    """(files, bytes) of the files a DataFrame reads, from file metadata."""
    files = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    )
    return files.groupBy("path").agg(F.max("size").alias("size")).agg(
        F.count("path").alias("files"), F.sum("size").alias("bytes")
    )


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    by: Sequence[str] = (),
    where: Column | None = None,
    target_mb: int = 128,
) -> None:
    """Rewrite a table with files near ``target_mb``; ``where`` limits what is rewritten.

    Each partition value (or the table) gets as many files as its bytes ask for, rows
    dealt by a hash of their content. Rows outside ``where`` are carried over as they are,
    so the target holds the whole table.
    """
    df = spark.read.parquet(source)
    chosen = df if where is None else df.filter(where)
    files = chosen.select(
        *by, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size")
    )
    sizes = files.groupBy(*by, "_path").agg(F.max("_size").alias("_size"))
    pieces = F.greatest(F.ceil(F.sum("_size") / (target_mb * 1024 * 1024)), F.lit(1)).cast("int")
    spread = sizes.groupBy(*by).agg(pieces.alias("_pieces"))
    salt = F.pmod(F.xxhash64(*df.columns), F.col("_pieces")).cast("int")
    if by:
        named = spread.withColumnsRenamed({c: f"_of_{c}" for c in by})
        match = F.lit(True)
        for c in by:
            match = match & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        dealt = chosen.join(named, match, "left").withColumn("_salt", salt)
        # one task may get several pieces: files are cut per partition value and piece
        count = max(1, int(spread.agg(F.sum("_pieces")).first()[0] or 0))
        dealt = dealt.repartition(count, *by, "_salt").select(*df.columns)
    else:
        count = spread.first()
        dealt = chosen.repartition(count["_pieces"] if count and count["_pieces"] else 1)
    rest = df.limit(0) if where is None else df.filter(~F.coalesce(where, F.lit(False)))
    out = dealt if where is None else dealt.unionByName(rest)
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(target)


def _numeric(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(F.col(col).cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType | T.BinaryType):  # the order of the first six bytes
        head = F.rpad(F.hex(F.substring(F.col(col).cast("binary"), 1, 6)), 12, "0")
        return F.when(F.col(col).isNotNull(), F.conv(head, 16, 10).cast("double"))
    return F.col(col).cast("double")


ROW_BYTES = 8


def _size_of(df: DataFrame) -> int:
    try:
        return table_size(df).first()["bytes"] or 0
    except AnalysisException:  # joined or computed: no file metadata
        return df.count() * len(df.columns) * ROW_BYTES


def zorder_key(df: DataFrame, cols: Sequence[str], bits: int = 6) -> DataFrame:
    """Add ``_z``: quantile rank of every column, bits interleaved.

    The quantiles come from one approximate pass; ``2**bits - 1`` boundaries per
    column are all that reaches the driver.
    """
    names = [f"_z_{c}" for c in cols]
    numeric = df.withColumns({n: _numeric(df, c) for n, c in zip(names, cols, strict=True)})
    steps = [i / 2**bits for i in range(1, 2**bits)]
    bounds = numeric.approxQuantile(names, steps, 1 / 2 ** (bits + 2))
    infinity = float("inf")
    splits = [[-infinity, *sorted(set(b)), infinity] for b in bounds]
    ranks = [f"{n}_rank" for n in names]
    ranked = Bucketizer(
        splitsArray=splits, inputCols=names, outputCols=ranks, handleInvalid="keep"
    ).transform(numeric)
    z = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            one = F.col(rank).cast("bigint").bitwiseAND(F.lit(1 << bit))
            z = z.bitwiseOR(F.shiftleft(one, bit * (len(ranks) - 1) + i))
    return ranked.withColumn("_z", z).drop(*names, *ranks)


def zorder_cluster(
    df: DataFrame,
    cols: Sequence[str],
    files: int | None = None,
    bits: int = 6,
    target_mb: int = 128,
) -> DataFrame:
    """Range-partition and sort by Z-order key.

    The number of files follows from the size of the files ``df`` reads unless given; for a
    frame that is not a plain table, from its rows at ``ROW_BYTES`` a column.

    A content hash follows the key in the range, so rows sharing one Z value can be
    split over several files.
    """
    if files is None:
        files = max(1, -(-_size_of(df) // (target_mb * 1024 * 1024)))
    keyed = zorder_key(df, cols, bits).withColumn("_h", F.xxhash64(*df.columns))
    return (
        keyed.repartitionByRange(files, "_z", "_h")
        .sortWithinPartitions("_z")
        .drop("_z", "_h")
    )
