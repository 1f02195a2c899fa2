"""The named queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    chat, decontaminate, html_text, language, licenses, lm, merkle, mixing, near_dedup, quality, secrets, sql,
    token_codes, vector_codes,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": lambda spark, d: decontaminate.leaks(
        table(spark, d, "documents"), table(spark, d, "benchmark")
    ),
    "op2_secret_scan": lambda spark, d: secrets.secret_table(table(spark, d, "documents")),
    "op3_mix_sources": lambda spark, d: mixing.mixture_table(table(spark, d, "documents")),
    "op4_language_id": lambda spark, d: language.language_table(table(spark, d, "documents")),
    "op5_html_text": lambda spark, d: html_text.extract(table(spark, d, "pages")),
    "op6_near_dedup": lambda spark, d: near_dedup.near_duplicates(table(spark, d, "documents")),
    "op7_chat_format": lambda spark, d: chat.chat_table(spark, table(spark, d, "conversations")),
    "op8_license_scan": lambda spark, d: licenses.license_table(table(spark, d, "documents")),
    "op9_lm_score": lambda spark, d: lm.score_table(table(spark, d, "documents")),
    "op10_quality_rules": lambda spark, d: quality.quality_table(
        table(spark, d, "documents"), table(spark, d, "labels")
    ),
    "op11_token_codes": lambda spark, d: token_codes.code_table(
        table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json")
    ),
    "op12_merkle_manifest": lambda spark, d: merkle.manifest_table(table(spark, d, "documents")),
    "op13_vector_codes": lambda spark, d: vector_codes.code_table(table(spark, d, "embeddings")),
}

ORACLE_SQL: dict[str, str] = {
    "op3_mix_sources": sql.MIXING,
    "op8_license_scan": sql.license_sql(
        licenses.KNOWN, licenses.SPELLINGS, licenses.COPYRIGHT_LINE, licenses.NOT_WORD
    ),
    "op6_near_dedup": sql.NEAR_DEDUP,
    "op12_merkle_manifest": sql.MERKLE,
    "op13_vector_codes": sql.vector_code_sql(),
}
