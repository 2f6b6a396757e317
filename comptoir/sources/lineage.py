"""Audit columns that each layer adds when it is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

STAMP = {"bronze": "_ingested_at", "silver": "_cleaned_at", "gold": "_aggregated_at"}


def with_lineage(df: DataFrame, layer: str, source: str | Column | None = None) -> DataFrame:
    df = without_lineage(df).withColumn(STAMP[layer], F.current_timestamp())
    if layer == "bronze":
        df = df.withColumn("_source_file", F.lit(source) if isinstance(source, str) or source is None else source)
    return df.withColumn("_layer", F.lit(layer))


def without_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*STAMP.values(), "_source_file", "_layer")
