"""Text cleaning rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def or_default(c: Column, default: str) -> Column:
    """``c`` unless it is null or only spaces; the kept text is not trimmed."""
    return F.when(F.length(F.trim(c)) > 0, c).otherwise(F.lit(default))


def title(c: Column) -> Column:
    return F.initcap(F.trim(c))


def capitals(c: Column) -> Column:
    return F.upper(F.trim(c))
