"""Connected components of a graph, in Spark, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comptoir.operators.lookups import lookup_join
from comptoir.sources.stores import written


def _with_least(edges: DataFrame, own_counts: bool) -> DataFrame:
    """Each edge (a, b) with the least neighbour of ``a``, ``a`` itself counted if asked.

    An aggregate and a join rather than a window, so that a node with very many
    edges is summed in the map tasks and can be split in the join.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    if own_counts:
        least = least.withColumn("least", F.least("a", "least"))
    return lookup_join(edges, least, "a", "inner")


def _stars(edges: DataFrame) -> DataFrame:
    """One large star, then one small star; edges (a, b) with a > b."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _with_least(both, own_counts=True).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    large = large.where("a <> b").distinct()
    small = _with_least(large, own_counts=False)
    small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionAll(small.select("a", F.col("least").alias("b")))
    return small.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b, whole numbers).

    A component's name is its least node. Edges may repeat, point either way or
    to themselves (then ignored). The number of rounds grows with the logarithm of the size; each
    round is written, so that a lost executor costs no more than that round.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before = written(ordered.distinct(), "stars"), None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == before:
            break
        before, now = seen, written(_stars(now), "stars")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component")))
