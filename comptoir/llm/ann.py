"""Approximate nearest neighbours by inner product: robust-pruned directed graphs, one per shard.

Vectors are dealt by hash into shards of a bounded size; in a shard, vectors of
similar length (by a factor of 2) form a graph of their own. A task builds the
graph of its shard: points enter in batches, a greedy search from the entry
points proposes neighbours, and robust pruning keeps a candidate only if no kept
one is closer to it by the factor ``ALPHA``, so edges stay diverse. Kept
neighbours get the reverse edge and are pruned again when they have too many.
Entry points are the middle, points far from all earlier ones, and random ones: where
points form clusters, edges seldom lead from one to another, so a search begins
at the nearest entries. Points to which no path leads in the end become further entries.
The index (vectors, nodes, edges) is a table. A query visits every shard by
beam search; queries come in blocks, so a task holds one shard and one block.

Largest inner product becomes smallest distance by one more component,
``sqrt(M^2 - |x|^2)`` with M the graph's longest vector, and 0 in queries; that
needs lengths that are alike. Graphs hold single precision, of vectors scaled by
a power of two; beams are scored again on the original vectors in double precision.

Vectors that are null, zero or hold null or non-finite components take no part,
nor do rows without id. Equal vectors share a node, so copies cannot crowd it.
Vectors are compared with those of their length only. A query leaves out rows
with its own id; of rows that repeat an id the smallest vector asks. Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from comptoir.sources.stores import written

QUERY_EVERY, NEAREST = 20, 20
SHARD_ROWS, LEAST_SHARDS, QUERY_BLOCK = 8192, 8, 16384
DEGREE, ALPHA = 32, 1.2
BUILD_BEAM, SEARCH_BEAM = 64, 128
#: Entries that are far from each other, and random ones.
FAR_ENTRIES, RANDOM_ENTRIES = 64, 192
#: Points that are searched or pruned together, and nodes that each expands at a time.
TOGETHER, EXPANDED = 256, 4


class Graph:
    """Vamana-style graph over the rows of ``points``, by Euclidean distance."""

    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None, entries: np.ndarray | None = None):
        self.points = points.astype(np.float32)
        self.norms = np.einsum("ij,ij->i", self.points, self.points)
        if edges is None:
            self.entries = self._spread()
            self.edges = np.full((len(points), DEGREE), -1, np.int32)
            self._build()
            self._reach_all()
        else:
            self.edges, self.entries = edges, entries

    def _spread(self) -> np.ndarray:
        """The middle, then the point farthest from all chosen ones again and again, then random points."""
        centre = self.points.mean(axis=0)
        chosen = [int((self.norms - 2 * (self.points @ centre)).argmin())]
        gap = np.full(len(self.points), np.inf, np.float32)
        for _ in range(min(FAR_ENTRIES, len(self.points) - 1)):
            last = chosen[-1]
            gap = np.minimum(gap, self.norms - 2 * (self.points @ self.points[last]) + self.norms[last])
            gap[last] = -np.inf
            chosen.append(int(gap.argmax()))
        some = np.random.default_rng(1).permutation(len(self.points))[:RANDOM_ENTRIES]
        return np.array(list(dict.fromkeys([*chosen, *some.tolist()])))

    def _build(self) -> None:
        order = np.random.default_rng(len(self.points)).permutation(len(self.points))
        order = np.concatenate([self.entries, order[~np.isin(order, self.entries)]])
        done = 0
        while done < len(order):
            batch = order[done:done + min(TOGETHER, max(1, done))]
            found, distances = self.search(self.points[batch], BUILD_BEAM)
            self._connect(batch, found, distances)
            done += len(batch)

    def _reach_all(self) -> None:
        """Makes the longest point that no path leads to one more entry, until there is none."""
        reached, fresh = np.zeros(len(self.points), bool), self.entries
        outermost = np.argsort(-self.norms, kind="stable")
        while True:
            while len(fresh):
                reached[fresh] = True
                fresh = np.unique(self.edges[fresh])
                fresh = fresh[(fresh >= 0) & ~reached[fresh]]
            outermost = outermost[~reached[outermost]]
            if not len(outermost):
                return
            fresh = outermost[:1]
            self.entries = np.append(self.entries, fresh)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of each query's final beam and their distances (less the query's norm), nearest first; -1 pads."""
        queries = queries.astype(np.float32)
        n = len(queries)

        ids = np.full((n, beam), -1, np.int32)
        distances = np.full((n, beam), np.inf, np.float32)
        expanded = np.ones((n, beam), bool)
        seen = np.zeros((n, len(self.points) + 1), bool)  # the last column takes the padding
        seen[:, -1] = True
        far = self.norms[self.entries] - 2 * (queries @ self.points[self.entries].T)
        nearest = far.argsort(axis=1, kind="stable")[:, :beam]
        width = nearest.shape[1]
        ids[:, :width], distances[:, :width] = self.entries[nearest], np.take_along_axis(far, nearest, 1)
        expanded[:, :width] = False
        seen[:, self.entries] = True
        while not expanded.all():
            active = np.flatnonzero(~expanded.all(axis=1))
            rank = np.argsort(expanded[active], axis=1, kind="stable")[:, :EXPANDED]
            picked = np.where(expanded[active[:, None], rank], -1, ids[active[:, None], rank])
            expanded[active[:, None], rank] = True
            near = np.where(picked[:, :, None] >= 0, self.edges[picked], -1).reshape(len(active), -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[active[:, None], near]] = -1
            seen[active[:, None], near] = True
            width = int((near >= 0).sum(axis=1).max())
            if not width:
                continue
            near = -np.sort(-near, axis=1)[:, :width]
            far = self.norms[near] - 2 * np.matmul(self.points[near], queries[active, :, None])[:, :, 0]
            far[near < 0] = np.inf
            all_ids = np.concatenate([ids[active], near], axis=1)
            all_far = np.concatenate([distances[active], far], axis=1)
            all_done = np.concatenate([expanded[active], near < 0], axis=1)
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            inner = np.take_along_axis(all_far, best, 1).argsort(axis=1, kind="stable")
            best = np.take_along_axis(best, inner, 1)
            ids[active], distances[active] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_far, best, 1)
            expanded[active] = np.take_along_axis(all_done, best, 1)
        return ids, distances

    def _pruned(self, nodes: np.ndarray, found: np.ndarray, distances: np.ndarray) -> np.ndarray:
        """Up to DEGREE diverse neighbours per node, of candidates sorted by distance."""
        kept = np.full((len(nodes), DEGREE), -1, np.int32)
        own = distances + self.norms[nodes][:, None]  # true squared distances
        alive = (found >= 0) & (found != nodes[:, None])
        near = self.points[found]
        norms = self.norms[found]
        rows = np.arange(len(nodes))
        for place in range(DEGREE):
            first = alive.argmax(axis=1)
            some = alive[rows, first]
            if not some.any():
                break
            kept[some, place] = found[rows, first][some]
            between = norms + norms[rows, first][:, None] - 2 * np.matmul(near, near[rows, first][:, :, None])[:, :, 0]
            alive &= ~(some[:, None] & (ALPHA**2 * between <= own))
            alive[rows, first] = False
        return kept

    def _connect(self, batch: np.ndarray, found: np.ndarray, distances: np.ndarray) -> None:
        self.edges[batch] = self._pruned(batch, found, distances)
        source = np.repeat(batch, DEGREE)
        target = self.edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        for start in range(0, len(nodes), TOGETHER):
            some, at, n = (x[start:start + TOGETHER] for x in (nodes, first, count))
            wide = np.full((len(some), DEGREE + n.max()), -1, np.int32)
            wide[:, :DEGREE] = self.edges[some]
            for row, (a, k) in enumerate(zip(at, n)):
                wide[row, DEGREE:DEGREE + k] = source[a:a + k]
            wide.sort(axis=1)
            wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
            far = self.norms[wide] - 2 * np.matmul(self.points[wide], self.points[some][:, :, None])[:, :, 0]
            far[wide < 0] = np.inf
            order = far.argsort(axis=1, kind="stable")
            wide, far = np.take_along_axis(wide, order, 1), np.take_along_axis(far, order, 1)
            over = (wide >= 0).sum(axis=1) > DEGREE
            self.edges[some[~over]] = wide[~over, :DEGREE]
            if over.any():
                self.edges[some[over]] = self._pruned(some[over], wide[over], far[over])


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Times the power of two that brings the largest component to between a half and one; exact."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(initial=0))[1])


def _augmented(vectors: np.ndarray) -> np.ndarray:
    vectors = _scaled(vectors)
    longest = np.einsum("ij,ij->i", vectors, vectors)
    return np.hstack([vectors, np.sqrt(np.maximum(longest.max() - longest, 0))[:, None]])


def _indexed(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("vec_id", kind="stable")
    vectors = np.stack(shard["vector"].to_numpy()).astype(np.float64)
    points, first, node = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    graph = Graph(_augmented(points))
    lead = np.zeros(len(shard), bool)
    lead[first] = True
    node = node.ravel()
    edges = [graph.edges[i] if leads else None for i, leads in zip(node, lead)]
    return pd.DataFrame({
        "dim": shard["dim"].to_numpy(), "band": shard["band"].to_numpy(), "shard": shard["shard"].to_numpy(), "vec_id": shard["vec_id"].to_numpy(),
        "vector": list(vectors), "node": node, "edges": edges, "entry": np.isin(node, graph.entries)})


def _searched(key: tuple, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(index) and len(queries):
        index = index.sort_values(["node", "vec_id"], kind="stable")
        node, ids = index["node"].to_numpy(), index["vec_id"].to_numpy()
        first = np.flatnonzero(np.diff(node, prepend=-1))
        copies = np.diff(np.append(first, len(node)))
        lead = index[index["edges"].notna()].drop_duplicates("node")
        points = np.stack(lead["vector"].to_numpy())
        graph = Graph(_augmented(points), np.stack(lead["edges"].to_numpy()).astype(np.int32), lead["node"].to_numpy()[lead["entry"].to_numpy()])
        asked = np.stack(queries["vector"].to_numpy()).astype(np.float64)
        pointed = np.vstack([_scaled(one[None]) for one in asked])  # a query's length changes no order
        names = queries["query_id"].to_numpy()
        for start in range(0, len(asked), TOGETHER):
            some = asked[start:start + TOGETHER]
            found, _ = graph.search(np.hstack([pointed[start:start + TOGETHER], np.zeros((len(some), 1))]), SEARCH_BEAM)
            for row, name in enumerate(names[start:start + TOGETHER]):
                nodes = found[row][found[row] >= 0]
                scores = points[nodes] @ some[row]
                # The smallest ids of a node are enough: its copies tie.
                held = [ids[first[i]:first[i] + min(copies[i], NEAREST + 1)] for i in nodes]
                every, repeated = np.concatenate(held), np.repeat(scores, [len(x) for x in held])
                others = every != name
                every, repeated = every[others], repeated[others]
                best = np.lexsort((every, -repeated))[:NEAREST]
                out["query_id"].append(np.full(len(best), name))
                out["vec_id"].append(every[best])
                out["score"].append(repeated[best])
    whole = {c: np.concatenate(parts) if parts else np.zeros(0) for c, parts in out.items()}
    return pd.DataFrame(whole).astype({"query_id": np.int64, "vec_id": np.int64, "score": np.float64})


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (double), dim and band (of its length) of the rows that take part."""
    rows = vectors.where("vec_id IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & ~odd).where(F.exists("vector", lambda x: x != 0))
    # Through the exponent of the largest component, as squares may leave the range of doubles.
    exponent = F.greatest(F.floor(F.log2(F.array_max(F.transform("vector", F.abs)))), F.lit(-1000))
    rows = rows.withColumn("exponent", exponent.cast("int"))
    half = F.pow(F.lit(2.0), -F.col("exponent") / 2)  # in two steps, each within the range
    squared = F.aggregate("vector", F.lit(0.0), lambda total, x: total + (x * F.col("half") * F.col("half")) ** 2)
    length = F.col("exponent") + F.log2(squared) / 2
    return rows.withColumn("half", half).select(
        "vec_id", "vector", F.size("vector").alias("dim"), F.floor(length + 0.5).cast("int").alias("band"))


def build_index(rows: DataFrame) -> DataFrame:
    """The stored index of ``usable`` rows: one row per vector, edges on the first of equal ones."""
    shards = max(LEAST_SHARDS, -(-rows.count() // SHARD_ROWS))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    schema = "dim int, band int, shard int, vec_id long, vector array<double>, node int, edges array<int>, entry boolean"
    return written(dealt.groupBy("dim", "band", "shard").applyInPandas(_indexed, schema), "vector-index")


def search(index: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest of each query (query_id, vector, dim)."""
    queries = written(queries, "vector-queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    graphs = written(index.select("dim", "band", "shard").distinct(), "vector-graphs").withColumnRenamed("dim", "of")
    asked = queries.select("query_id", "vector", "dim").join(graphs, F.col("dim") == F.col("of")).select(
        "dim", "band", "shard", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"),
        "query_id", "vector")
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ("dim", "band", "shard", "block")
    found = held.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(
        _searched, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= NEAREST).select(
        "query_id", "rank", "vec_id", "score")


def nearest_vectors(embeddings: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    """The nearest of every vector whose id is divisible by ``every``, among all others."""
    rows = written(usable(embeddings), "vectors")
    asking = rows.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id"))
    queries = asking.agg(F.min(F.struct("vector", "dim")).alias("one")).select("query_id", "one.vector", "one.dim")
    return search(build_index(rows), queries)
