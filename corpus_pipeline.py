"""The corpus pipeline: documents in, a cleaned and weighted training mix out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents. All but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import decontaminate, language, mixing, near_dedup, secrets
from tallymart.llm.common import crc32_id, stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one known language; the model learns from two thirds of the labelled rows.

    Null and letterless texts go, and so do mixed ones without a main language.
    """
    return language.accepted(docs, language.fit(docs.filter(crc32_id() % 3 != 1)))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; texts without words and rows without doc_id stay."""
    return near_dedup.without_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; null texts hold none."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark and n_chars brought up to date."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks; ``copy`` numbers the copies."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", remove_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix_sources),
]

#: Learned models and signatures are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
