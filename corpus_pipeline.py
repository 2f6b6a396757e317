"""The corpus pipeline: documents in, shard places out.

``STAGES`` holds (name, function) in order. Each function takes (spark, docs,
sf_dir); the result is written and read again as the next one's ``docs``.

Nulls, empty texts, repeated rows and other columns are treated as each
operator's module says; all stages but the last keep every column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from comptoir.llm import decontaminate, language, mixing, ngram_join, sharding
from comptoir.llm.common import table
from comptoir.sources.stores import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are in no language that the labelled ones teach."""
    return language.in_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return ngram_join.one_of_each_group(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that each source meets its target."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document, repeats included."""
    return sharding.shard_of_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("mix", mix_sources),
    ("shard", shard),
]

#: Hyperdimensional profiles cannot be expressed in SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
