from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from comptoir.llm import ngram_join
from comptoir.llm.components import components
from comptoir.llm.shingles import shingle_sets
from llm.cases import edited, frame, odd_rows, text, words


def shingles(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset({tuple(w)} if w else ())


def brute(rows):
    """[(doc_id, n_shingles, component_id)], from all pairs that share a shingle."""
    members = defaultdict(list)
    for i, t, *_ in rows:
        members[shingles(t)].append(i)
    sets, holders, root = [s for s in members if s], defaultdict(list), {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, s in enumerate(sets):
        shared = Counter(b for t in s for b in holders[t])
        for b, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[b]) - n):
                root[top(a)] = top(b)
        for t in s:
            holders[t].append(a)
    least: dict = {}
    for a, s in enumerate(sets):
        least.setdefault(top(a), []).extend(i for i in members[s] if i is not None)
    at = {s: a for a, s in enumerate(sets)}
    every = [(i, shingles(t)) for i, t, *_ in rows]
    return sorted(repr((i, len(s), min(least[top(at[s])], default=i) if s else i)) for i, s in every)


def joined(docs):
    return sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in ngram_join.join_documents(docs).collect())


def test_sets_are_those_of_the_words():
    texts = ["a b c d e f", "A B c\td\re\nf", "a b", "", None, "\x0b \x0c", "x " * 500, "É é b c d", "a b c d e f"]
    tokens, bounds = shingle_sets(texts)
    assert [b - a for a, b in zip(bounds, bounds[1:])] == [len(shingles(t)) for t in texts]
    sets = [frozenset(tokens[a:b].tolist()) for a, b in zip(bounds, bounds[1:])]
    for i, s in enumerate(texts):
        for j, t in enumerate(texts):
            assert len(sets[i] & sets[j]) == len(shingles(s) & shingles(t))


def test_odd_rows(spark):
    rows = odd_rows()
    assert joined(frame(spark, rows)) == brute(rows)
    assert joined(frame(spark, rows).limit(0)) == []


def test_large_ids_beside_a_null(spark):
    rows = [(2**60 + i, "the same few words again and again", "en", "a") for i in (1, 3)] + [(None, "x y z", None, None)]
    assert joined(frame(spark, rows)) == brute(rows)


def near_copies(seed: int, n: int):
    """Copies of a few texts of all lengths with edits around the threshold, and passages that many share."""
    pick = random.Random(seed)
    bases = [words(seed + i, length) for i, length in enumerate((1, 2, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 40, 80, 200, 700))]
    passage = " ".join(words(seed - 1, 60))
    rows = []
    for i in range(n):
        base = pick.choice(bases)
        edits = pick.sample(range(len(base)), pick.randint(0, max(1, len(base) // 30)))
        t = edited(base, edits)
        if pick.random() < 0.2:
            t = " ".join(words(seed + i, pick.randint(1, 15))) + " " + passage
        if pick.random() < 0.3:
            t += " " + " ".join(words(i, pick.randint(0, max(1, len(base) // 6))))
        rows.append((i, t, "en", "x"))
    return rows


@pytest.mark.parametrize("group, block", [(64, 1024), (4, 16)])
def test_random_near_copies(spark, monkeypatch, group, block):
    """Small limits send most groups through blocks; the links are the same."""
    monkeypatch.setattr(ngram_join, "GROUP", group)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(10 * group, 900)
    assert joined(frame(spark, rows)) == brute(rows)


def test_blocks_are_cut_by_shingles_too(spark, monkeypatch):
    """A connected part of few but long sets is compared in several blocks; the links are the same."""
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 6000)
    calls = spark.sparkContext.accumulator(0)
    real = ngram_join._block_links

    def counted(sets):
        calls.add(1)
        assert sets["tokens"].map(len).sum() < 30_000
        return real(sets)

    monkeypatch.setattr(ngram_join, "_block_links", lambda sets: counted(sets))
    base = words(4, 600)
    rows = [(i, edited(base, [i * 5, i * 5 + 2]), "en", "x") for i in range(110)]
    assert joined(frame(spark, rows)) == brute(rows)
    assert calls.value > 10


@pytest.mark.parametrize("segments", [1, 2, 3])
def test_linked_sets_share_a_signature(segments, monkeypatch):
    """With very few segments most sets need deletions or the group for the rest."""
    pick, np_random = random.Random(segments), np.random.default_rng(segments)
    real = np.maximum
    for _ in range(300):
        size = pick.randint(1, 40)
        a = np.unique(np_random.integers(0, 2**63, size).astype(np.uint64))
        kept = a[np_random.random(len(a)) > pick.choice((0, 0.05, 0.1, 0.15))]
        b = np.unique(np.concatenate([kept, np_random.integers(0, 2**63, pick.randint(0, 4)).astype(np.uint64)]))
        shared = len(np.intersect1d(a, b))
        if not ngram_join.linked(shared, len(a), len(b)) or not shared:
            continue
        monkeypatch.setattr(np, "maximum", lambda x, y, **k: np.full_like(y, segments) if isinstance(x, int) and x == 64 else real(x, y, **k))
        costs = ngram_join.Costs(a[::2], np.full(len(a[::2]), 1000))
        of, signature = ngram_join.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), costs)
        monkeypatch.undo()
        assert set(signature[of == 0].tolist()) & set(signature[of == 1].tolist())


def test_sketches_never_rule_out_a_link(spark):
    pick = np.random.default_rng(8)
    sets = []
    for size in (3, 30, 64, 65, 120, 130, 500, 1025):
        base = pick.integers(0, 2**63, size).astype(np.uint64)
        sets += [np.unique(base), np.unique(np.concatenate([base[size // 8:], pick.integers(0, 2**63, size // 20).astype(np.uint64)]))]
    bounds = np.cumsum([0, *map(len, sets)])
    parity = ngram_join._parities(np.concatenate(sets), bounds)
    pairs = [(i, len(sets[i]), parity[i].tolist(), j, len(sets[j]), parity[j].tolist()) for i in range(len(sets)) for j in range(len(sets))]
    frame = spark.createDataFrame(pairs, "a int, a_n int, a_parity array<long>, b int, b_n int, b_parity array<long>")
    kept = {(r.a, r.b) for r in frame.where(ngram_join._may_link("a", "b")).collect()}
    links = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if ngram_join.linked(len(np.intersect1d(x, y)), len(x), len(y))}
    assert links <= kept and len(kept) < len(pairs) / 3


def test_components(spark):
    pick = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000 + pick.randint(0, 400), 1000 + pick.randint(0, 400)) for _ in range(300)]
    edges += [(5000, 5000 + i) for i in range(1, 300)] + [(7, 7), (3, 2), (9000, 9000)]
    root: dict = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group(spark):
    rows = [r for r in odd_rows() if r[0] is not None]
    docs = frame(spark, rows)
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    groups = ngram_join.join_documents(docs).select("doc_id", "component_id").distinct().collect()
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in groups if r.doc_id == r.component_id)
    assert ngram_join.one_of_each_group(docs.limit(0)).count() == 0


def test_one_of_each_group_goes_by_rows_not_ids(spark):
    base, other, third = words(1, 120), words(2, 120), words(3, 120)
    near = lambda of, k: edited(of, [k])
    rows = [
        (5, " ".join(base)), (None, near(base, 3)), (None, " ".join(base)), (7, near(base, 9)),  # 5 stays
        (7, text(50, 60)),  # another text under the id of a copy
        (8, " ".join(other)), (8, near(other, 4)),  # near copies under one id
        (None, " ".join(third)), (None, " ".join(third)), (None, near(third, 5)),  # a group without ids
        (None, text(51, 60)), (None, None), (None, None), (9, ""), (9, "")]
    docs = frame(spark, [(*row, "en", "x") for row in rows]).repartition(40)  # most partitions are empty
    got = [(r.doc_id, r.text) for r in ngram_join.one_of_each_group(docs).collect()]
    for one in ((5, " ".join(base)), (7, text(50, 60)), (None, text(51, 60)), (9, "")):
        assert got.count(one) == 1
    assert sum(i == 8 for i, _ in got) == 1
    assert sum(t in (" ".join(third), near(third, 5)) for _, t in got) == 1
    assert got.count((None, None)) == 2 and len(got) == 8
