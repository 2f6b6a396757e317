"""The registered queries of this package and their SQL twins.

Where there is no twin, tests/llm holds the query against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from comptoir.llm import (
    ann, chat, decontaminate, language, line_dedup, mixing, ngram_join, pii, resampling, sharding, spelling, token_counts,
    url_filter,
)
from comptoir.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    def over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, folder: operator(table(spark, folder, name))

    def resampled(spark: SparkSession, folder: str) -> DataFrame:
        return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))

    def contained(spark: SparkSession, folder: str) -> DataFrame:
        return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))

    return {
        "op1_pii": over("documents", pii.document_identifiers),
        "op2_token_counts": over("documents", token_counts.document_sections),
        "op3_mix_sources": over("documents", mixing.mixed_words),
        "op4_chat_format": over("conversations", chat.formatted_conversations),
        "op5_nearest_vectors": over("embeddings", ann.nearest_vectors),
        "op6_decontamination": contained,
        "op7_ngram_join": over("documents", ngram_join.join_documents),
        "op8_language_id": over("documents", language.document_languages),
        "op9_shards": over("documents", sharding.shard_of_documents),
        "op10_url_filter": over("pages", url_filter.judged_pages),
        "op11_line_dedup": over("documents", line_dedup.line_report),
        "op12_spelling_variants": over("documents", spelling.variants),
        "op13_resampling": resampled,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mix_sources": mixing.MIXED_WORDS_SQL,
        "op4_chat_format": chat.FORMATTED_CONVERSATIONS_SQL,
        "op6_decontamination": decontaminate.CONTAINED_ITEMS_SQL,
        "op7_ngram_join": ngram_join.JOIN_DOCUMENTS_SQL,
        "op10_url_filter": url_filter.JUDGED_PAGES_SQL,
        "op11_line_dedup": line_dedup.LINE_REPORT_SQL,
    }
