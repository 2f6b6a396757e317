from __future__ import annotations

import math

import numpy as np
import pytest

from comptoir.llm import ann


def exact(ids, vectors, every=20, k=20):
    found = {}
    for query in sorted({i for i in ids if i % every == 0}):
        mine = vectors[ids.index(query)]
        near = [(-float(np.dot(v, mine)), i) for i, v in zip(ids, vectors) if i != query and len(v) == len(mine)]
        found[query] = [(i, -s) for s, i in sorted(near)[:k]]
    return found


def searched(frame):
    found: dict = {}
    for r in sorted(ann.nearest_vectors(frame).collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def recall(found, wanted):
    return np.mean([len({i for i, _ in wanted[q]} & {i for i, _ in found.get(q, [])}) / max(1, len(wanted[q])) for q in wanted])


def test_recall_on_given_vectors(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in table.collect()]
    wanted = exact([i for i, _ in rows], [v for _, v in rows])
    found = searched(table)
    assert set(found) == set(wanted) and recall(found, wanted) >= 0.95
    for query, near in found.items():
        for i, score in near:
            assert math.isclose(score, float(np.dot(dict(rows)[i], dict(rows)[query])), rel_tol=1e-12, abs_tol=1e-15)


def test_lengths_that_differ(spark):
    """Largest inner product, not smallest angle: long vectors win."""
    made = np.random.default_rng(4)
    vectors = made.normal(size=(3000, 16)) * made.lognormal(sigma=1, size=(3000, 1))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    assert recall(searched(frame), exact(list(range(3000)), list(vectors))) >= 0.9


def clustered(rows: int, clusters: int, seed: int = 7, size: int = 64) -> np.ndarray:
    made = np.random.default_rng(seed)
    centres = made.normal(size=(clusters, size))
    vectors = centres[made.integers(clusters, size=rows)] + 0.3 * made.normal(size=(rows, size))
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@pytest.mark.parametrize("clusters", [8, 50, 1000, 8192])
def test_a_full_shard_in_clusters(clusters):
    points = clustered(ann.SHARD_ROWS, clusters)
    graph, asked = ann.Graph(ann._augmented(points)), points[::20]
    found, _ = graph.search(np.hstack([asked, np.zeros((len(asked), 1))]), ann.SEARCH_BEAM)
    wanted = np.argsort(-(asked @ points.T), axis=1)[:, :20]
    got = [len(set(f[:20].tolist()) & set(w.tolist())) / 20 for f, w in zip(found, wanted)]
    assert np.mean(got) >= 0.95


def test_full_shards_in_clusters(spark):
    """The whole operator on eight full shards in 50 clusters, against exact search for 500 of its queries."""
    vectors = clustered(8 * ann.SHARD_ROWS, 50)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = searched(frame)
    asked = sorted(found)[::max(1, len(found) // 500)]
    scores = vectors[asked] @ vectors.T
    scores[np.arange(len(asked)), asked] = -np.inf
    wanted = {q: [(int(i), 0) for i in row] for q, row in zip(asked, np.argpartition(-scores, 20, axis=1)[:, :20])}
    assert len(found) == -(-len(vectors) // 20) and recall(found, wanted) >= 0.95


@pytest.mark.parametrize("scale", [1e-300, 1e-170, 1e-25, 1e25, 1e150])
def test_lengths_beyond_single_precision(spark, scale):
    vectors = clustered(3000, 20, size=16) * scale
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    unit = exact(list(range(3000)), list(vectors / scale))
    assert recall(searched(frame), unit) >= (0.9 if scale > 1e-150 else 0)  # products of smaller ones are all zero
    bands = {r.band for r in ann.usable(frame).select("band").distinct().collect()}
    assert {math.floor(math.log2(scale) + 0.5 + d) for d in (-0.01, 0.01)} >= bands


def test_a_repeated_id_asks_with_its_smallest_vector(spark):
    rows = [(0, [2.0, 1.0]), (0, [1.0, 3.0]), (0, [1.0, 3.0])] + [(i, [float(i), float(-i)]) for i in range(1, 10)]
    for order in (1, -1):
        found = searched(spark.createDataFrame(rows[::order], "vec_id long, embedding array<double>"))
        assert [score for _, score in found[0]] == sorted((-2.0 * i for i in range(1, 10)), reverse=True)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 1.0])]
    rows += [(20, [1.0, 1.0, 1.0]), (21, [2.0, 1.0, 0.0])]  # another length
    rows += [(100 + i, [1.0, 0.5]) for i in range(60)] + [(7, [3.0, 3.0]), (8, [-1.0, 0.0])]  # many ties
    frame = spark.createDataFrame([(i, v, 9, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, label int, shard int, node int")
    good = [(i, np.array(v)) for i, v in rows if i not in (1, 2, 3, 4, 5, 6, None)]
    assert searched(frame) == exact([i for i, _ in good], [v for _, v in good])
    assert searched(frame.limit(0)) == {}


def test_every_row_is_in_the_index(spark, folder):
    rows = ann.usable(spark.read.parquet(f"{folder}/embeddings.parquet"))
    index = ann.build_index(rows)
    assert index.count() == rows.count() and index.where("edges IS NOT NULL").count() > 0


def test_pruning_keeps_diverse_edges():
    made = np.random.default_rng(1)
    graph = ann.Graph(made.normal(size=(800, 4)))
    for node in range(0, 800, 50):
        kept = graph.edges[node][graph.edges[node] >= 0]
        assert 0 < len(kept) <= ann.DEGREE and node not in kept and len(set(kept)) == len(kept)
