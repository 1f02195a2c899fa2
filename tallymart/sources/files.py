"""Readers: relational snapshots (JDBC or CSV) and clickstream NDJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CLICKSTREAM, RAW_TABLES, struct

#: Times keep their microseconds.
TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
#: Text comes back as it was: quotes, line breaks, blanks, and empty apart from null.
CSV = TIME | {
    "header": "true", "multiLine": "true", "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a parallel JDBC read that projects exactly the table's known columns."""
    columns = ", ".join(f.name for f in struct(RAW_TABLES[table]).fields)
    options = {
        "url": url,
        "dbtable": f"(SELECT {columns} FROM {table}) AS src",
        "fetchsize": str(fetch_size),
    }
    if partition_column:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def extract(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """Read one relational table, in parallel when a numeric partition column is given."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def read_snapshot(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A CSV snapshot with header and declared schema; ``\\N`` is null, an empty field empty text."""
    return spark.read.schema(RAW_TABLES[table]).options(**CSV).csv(path)


def write_snapshot(df: DataFrame, path: str, table: str) -> None:
    """Overwrite the CSV snapshot of a table, columns in the declared order."""
    names = [f.name for f in struct(RAW_TABLES[table]).fields]
    df.select(*names).write.mode("overwrite").options(**CSV, quoteAll="true").csv(path)


def read_clickstream(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON records below ``ingest_date=...`` folders, nested columns as structs."""
    return spark.read.schema(f"{CLICKSTREAM}, ingest_date date").options(**TIME).json(path)


def stream_clickstream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same folder as a stream; each batch takes a bounded number of new files."""
    return (
        spark.readStream.schema(f"{CLICKSTREAM}, ingest_date date")
        .options(**TIME)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
