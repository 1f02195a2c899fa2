"""A record of every batch a stream has put into a table.

The record is written after the batch's data. A batch that is run again, because the driver
was lost before its checkpoint moved on, finds its record and leaves the table alone; one that
was lost before the record is done again. Records are kept by the query's own id, so the
batches of a stream that starts afresh, numbered from 0 again, are not taken for old ones.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

FACTS = "rows bigint, late bigint, newest timestamp"


class Commits:
    """The records beside the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = f"{path.rstrip('/')}-commits"

    def _at(self, query: str, batch: int) -> str:
        return f"{self.path}/query={query}/batch={batch}"

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(FACTS).parquet(path)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" in str(missing):
                return None
            raise

    def find(self, query: str, batch: int) -> Row | None:
        """The facts of a batch, None if it is not (wholly) done."""
        found = self._read(self._at(query, batch))
        return None if found is None else found.first()

    def record(self, query: str, batch: int, **facts) -> None:
        row = [facts.get(name) for name in ("rows", "late", "newest")]
        self.spark.createDataFrame([row], FACTS).coalesce(1).write.mode("overwrite").parquet(
            self._at(query, batch)
        )

    def newest_before(self, query: str, batch: int):
        """The newest event time of the batches before; a record holds that of all up to it."""
        last = self.find(query, batch - 1) if batch else None
        if last is not None:
            return last["newest"]
        return self.all().agg(F.max("newest")).first()[0]

    def all(self) -> DataFrame:
        """Every record: query, batch, rows, late, newest."""
        found = self._read(self.path)
        if found is None:
            return self.spark.createDataFrame([], f"{FACTS}, query string, batch int")
        return self.spark.read.schema(f"{FACTS}, query string, batch int").parquet(self.path)


def query_id(spark: SparkSession) -> str:
    """The id of the streaming query whose batch runs in this thread; its checkpoint keeps it."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
