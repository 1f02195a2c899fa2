"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Shared folder of a local master whose session names none in ``spark.checkpoint.dir``.
LOCAL_SHARED = "/tmp/checkpoints"


def get_session(app: str = "tallymart", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the operators are tuned for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # streaming state on local disk with changelogs, not on the executor heap
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one named by ``spark.checkpoint.dir``.

    Sinks, model files and streaming checkpoints all live there, so any executor
    or a restarted driver can read them. Only a local master, which has no other
    machine to share with, may leave it unset and gets ``LOCAL_SHARED``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = LOCAL_SHARED
    return f"{base.rstrip('/')}/tallymart/{name}-{uuid.uuid4().hex[:12]}"


def materialise(spark: SparkSession, df, name: str):
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs need the same expensive input (model fitting): unlike
    a cache the files outlive a lost executor, and the lineage ends here.
    """
    path = workspace(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
