"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def one_per_key(
    df: DataFrame, *keys: str, required: Sequence[str] = (), order: Sequence[str] = (), copies: str | None = None,
) -> DataFrame:
    """Keep one row per key: the one that lacks the fewest ``required`` columns,
    of these the smallest by the other columns, nulls last.

    ``order`` gives the columns' order of comparison; columns it does not name
    follow in the frame's order. An aggregate rather than a ranking: copies of a
    key that meet in a map task collapse there, so a key that holds a large
    share of the rows never travels whole, and Catalyst learns that the key is
    unique, which lets it drop a left join to this table when none of its
    columns are read. ``copies`` names a further column, the rows that the key had.
    """
    others = [c for c in df.columns if c not in keys]
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    if not others:
        return df.groupBy(*df.columns).agg(*counted) if copies else df.distinct()
    compared = [c for c in order if c in others] + [c for c in others if c not in order]
    missing = sum((F.col(c).isNull().cast("int") for c in required if c in others), F.lit(0))
    # min() of a struct puts nulls first, so each column is preceded by whether it is null.
    ranked = [missing.alias("_missing")]
    for number, name in enumerate(compared):
        ranked += [F.col(name).isNull().alias(f"_null_{number}"), F.col(name)]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_kept"), *counted)
    columns = [F.col(c) if c in keys else F.col("_kept")[c].alias(c) for c in df.columns]
    return kept.select(*columns, *filter(None, [copies]))
