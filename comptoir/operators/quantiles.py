"""Quantiles of integer columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from comptoir.operators.sketches import estimated, sketched

# A 64-bit value is read as high, middle and low bits, so a counting step never
# has more than 2^24 (first) or 2^20 (later) groups per wanted quantile.
SHIFTS = (40, 20, 0)


def quantiles(
    df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float], exact: bool = True, error: float = 0.01,
) -> DataFrame:
    """One row with, per name, the array of its quantiles as BIGINT.

    A quantile is the smallest value whose cumulative share reaches the
    probability; nulls do not count. ``exact=False`` estimates them within
    ``error`` of rank in one pass.

    The exact form counts values by their leading bits, picks for each quantile
    the group that holds its rank, and repeats inside that group with the next
    bits. Every step is a grouped count with map-side combine, so neither many
    distinct values nor one very frequent value ends up in a single task.
    """
    if not exact:
        whole = sketched(df, columns=columns, error=error)
        return whole.select(*(estimated(n, probs).alias(n) for n in columns))

    pairs = [F.struct(F.lit(n).alias("name"), c.cast("long").alias("v")) for n, c in columns.items()]
    values = df.select(F.inline(F.array(*pairs))).where("v is not null")
    wanted = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)))

    # Rank of each quantile, and the group of leading bits it falls into.
    counted = values.groupBy("name", F.shiftright("v", SHIFTS[0]).alias("bits")).agg(F.count("*").alias("n"))
    found = (
        counted.withColumns({
            "upto": F.sum("n").over(Window.partitionBy("name").orderBy("bits")),
            "total": F.sum("n").over(Window.partitionBy("name")),
        })
        .select("*", F.inline(wanted))
        .withColumn("rank", F.greatest(F.ceil(F.col("p") * F.col("total")), F.lit(1)))
    )
    found = _group_of_rank(found)

    for previous, shift in zip(SHIFTS, SHIFTS[1:]):
        # ``found`` has one row per name and probability, so it is safe to broadcast.
        inside = values.withColumn("bits", F.shiftright("v", previous)).join(F.broadcast(found), ["name", "bits"])
        counted = inside.groupBy("name", "i", "rank", F.shiftright("v", shift).alias("bits")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("name", "i").orderBy("bits"))
        found = _group_of_rank(counted.withColumn("upto", upto))

    cell = lambda n, i: F.max(F.when((F.col("name") == n) & (F.col("i") == i), F.col("bits")))
    arrays = [F.array(*(cell(n, i) for i in range(len(probs)))).alias(n) for n in columns]
    return found.agg(*arrays)


def _group_of_rank(running: DataFrame) -> DataFrame:
    before = F.col("upto") - F.col("n")
    holds = (before < F.col("rank")) & (F.col("rank") <= F.col("upto"))
    return running.where(holds).select("name", "i", "bits", (F.col("rank") - before).alias("rank"))
