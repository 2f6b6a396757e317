"""Quantiles within a stated error of rank, from sketches that can be stored and merged.

A sketch (KLL) of a group keeps some of its values, by chance, so that the rank
of any value is known within ``error`` times the group's size, in 99 of 100
cases. Its size depends on the error, hardly on the rows. Sketches of finer
groups, kept with a roll-up, merge into those of any coarser group with the same
error, so quantiles need no second read of the facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

#: Rank error of a sketch of size k is A / k ** B.
A, B = 2.296, 0.9723
LEAST_K, MOST_K = 8, 65_535


def size_for(error: float) -> int:
    """The sketch size that keeps ranks within ``error``."""
    if not 0 < error < 1:
        raise ValueError("error must be between 0 and 1")
    return min(MOST_K, max(LEAST_K, ceil((A / error) ** (1 / B))))


def sketched(df: DataFrame, *keys: str | Column, columns: Mapping[str, Column], error: float) -> DataFrame:
    """The keys and, per name, the sketch of a column of whole numbers; nulls do not count."""
    size = size_for(error)
    return df.groupBy(*keys).agg(*(F.kll_sketch_agg_bigint(c.cast("long"), size).alias(n) for n, c in columns.items()))


def merged(sketches: DataFrame, *keys: str | Column, names: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*keys).agg(*(F.kll_merge_agg_bigint(n).alias(n) for n in names))


def estimated(sketch: str, probs: Sequence[float]) -> Column:
    """Array of quantiles of a column of sketches; of nulls where no value was seen."""
    wanted = F.array(*(F.lit(float(p)) for p in probs))
    none = F.array(*(F.lit(None).cast("long") for _ in probs))
    return F.when(F.kll_sketch_get_n_bigint(sketch) > 0, F.kll_sketch_get_quantile_bigint(sketch, wanted)).otherwise(none)
