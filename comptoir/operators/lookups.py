"""Joins of a large table to a lookup that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``facts`` with the lookup's columns.

    The strategy is left to Spark: a lookup whose measured size is under the
    broadcast threshold is broadcast, a larger one is sort-merge joined.

    In the second case a hot key, or all the null keys together, would make one
    huge task. AQE splits such a partition only if both inputs of the join come
    straight from a shuffle, and an aggregated lookup does not: its aggregate
    has already placed it by ``key``. The constant second join column makes
    Spark shuffle both sides for the join itself, so AQE can split.
    """
    part = F.pmod(F.hash(key), F.lit(1)).alias("_part")
    joined = facts.select("*", part).join(lookup.select("*", part), [key, "_part"], how)
    return joined.select(*facts.columns, *(c for c in lookup.columns if c != key))
