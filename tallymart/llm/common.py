"""Helpers shared by the text operators: stored tables, checked broadcasts, table readers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialise

#: Rows up to which a stored lookup table is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 20_000
#: Records and bytes of one Arrow batch, so that a worker holds a bounded part of the table.
ARROW_RECORDS, ARROW_BYTES = 2000, str(8 << 20)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage ends there."""
    return materialise(df.sparkSession, df, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_batches(df: DataFrame, func, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow(func, schema)`` over batches of a bounded number of rows and bytes."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_RECORDS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return df.mapInArrow(func, schema)


def lookup(
    df: DataFrame, small: DataFrame, on, how: str = "left", rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join a stored ``small`` table, broadcast only if it has at most ``rows`` rows.

    Beyond that the join shuffles, and Spark splits skewed partitions.
    """
    if small.count() <= rows:
        small = F.broadcast(small)
    return df.join(small, on, how)


def named(column: str):
    """The column of exactly this name, dots and back quotes included."""
    quoted = column.replace("`", "``")
    return F.col(f"`{quoted}`")


def sheltered(docs: DataFrame, own: Sequence[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step(docs)``, where columns outside ``own`` have names that no operator uses; they come back after."""
    safe = {c: f"other_column_{k}" for k, c in enumerate(docs.columns) if c not in own}
    out = step(docs.select(*[named(c).alias(safe.get(c, c)) for c in docs.columns]))
    back = {new: old for old, new in safe.items()}
    return out.select(*[F.col(c).alias(back.get(c, c)) for c in out.columns])


def sort_key(docs: DataFrame, column: str):
    """The column as something Spark can sort by: maps, alone or inside, as JSON."""
    kind = docs.schema[column].dataType.simpleString()
    return F.to_json(F.struct(named(column))) if "map<" in kind or "variant" in kind else named(column)


def crc32_id(column: str = "doc_id"):
    """crc32 of an id written as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
