"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: A word, as the contracts define it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Column names like these that ``df`` does not have in any letter case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return tuple(found)


def column(name: str) -> Column:
    """The column with exactly this name, dots and spaces included."""
    return F.col(f"`{name.replace('`', '``')}`")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, keys: list[str], by: list[str], parts: int, name: str) -> DataFrame:
    """``df`` with ``name``, a number from 0 without gaps within each key.

    A key may hold any share of the rows: each key is dealt over ``parts`` hash
    parts of ``by``, the rows of a part are ranked in one task, and the parts'
    counts, summed in order, shift the ranks. ``by`` must tell rows apart, or
    those that are equal meet in one part. ``df`` is evaluated twice, so it
    should be stored.
    """
    part = "_part"
    dealt = df.withColumn(part, F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int"))
    counts = dealt.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*keys, part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    rank = F.row_number().over(Window.partitionBy(*keys, part).orderBy(*by)) - 1
    joined = dealt.join(shifts, [*keys, part])
    return joined.withColumn(name, (rank + F.col("_shift")).cast("long")).drop(part, "_shift")
