"""A set of keys as bits that every task holds, to leave rows out before they are shuffled.

Keys are hashed to cells, a bit each. A key of the set always finds its cell
marked; another one finds it marked with a chance of about one in
``BITS_PER_KEY``, so what passes is still joined. The bits are a scalar
subquery: no action is run to make them, and Spark sends them to the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 16
#: Cells at most: 16 MB of bits. Beyond a sixteenth as many keys, more rows pass.
MOST = 1 << 27


def marked_cells(cells: DataFrame, count: Column | int, most: int) -> Column:
    """Scalar struct (count, words) of a frame with one column ``cell`` of numbers under ``count``, a power of two up to ``most``."""
    count = F.lit(count).cast("long") if isinstance(count, int) else count
    bit = F.col("cell").bitwiseAND(F.lit(63)).cast("int")
    marked = cells.groupBy(F.shiftright("cell", 6).alias("place")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    # One number per 64 cells, in order.
    every = cells.sparkSession.range(max(1, most // 64)).select(F.col("id").alias("place"), count.alias("count"))
    every = every.where((F.col("place") == 0) | (F.col("place") < F.shiftright("count", 6)))
    whole = every.join(marked, "place", "left").select("place", "count", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    words = F.sort_array(F.collect_list(F.struct("place", "bits"))).getField("bits")
    return whole.agg(F.struct(F.max("count").alias("count"), words.alias("words"))).scalar()


def cell_is_marked(marks: Column, cell: Column) -> Column:
    word = F.get(marks["words"], F.shiftright(cell, 6).cast("int"))
    return F.getbit(word, cell.bitwiseAND(F.lit(63)).cast("int")) == 1


def key_marks(keys: DataFrame, bits_per_key: int = BITS_PER_KEY, most: int = MOST) -> Column:
    """Marks of the keys, as many cells as their number asks for. ``keys`` is read twice."""
    wanted = F.greatest(F.count(F.lit(1)) * bits_per_key, F.lit(64))
    count = keys.agg(F.least(F.pow(F.lit(2), F.length(F.bin(wanted - 1))).cast("long"), F.lit(most).cast("long"))).scalar()
    hashed = keys.select(F.xxhash64(*keys.columns).alias("hash"), count.alias("count"))
    return marked_cells(hashed.select(F.col("hash").bitwiseAND(F.col("count") - 1).alias("cell")), count, most)


def may_hold(marks: Column, *key: Column) -> Column:
    """Whether a key may be among those that were marked; false for none of them."""
    return cell_is_marked(marks, F.xxhash64(*key).bitwiseAND(marks["count"] - 1))
