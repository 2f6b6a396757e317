from __future__ import annotations

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from comptoir.llm import sharding
from comptoir.llm.common import numbered
from comptoir.sources.stores import written
from llm.cases import frame, odd_rows, text


def checked(rows, got, shards=40):
    """The contract's columns, whole groups where they fit, slots without gaps; returns bytes per shard."""
    assert len(got) == len(rows)
    expected = sorted((repr(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((repr(r.doc_id), r["size"], r.text_crc32) for r in got) == expected
    slots, held = defaultdict(list), defaultdict(int)
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        held[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return held


def test_odd_rows(spark):
    rows = odd_rows()
    checked(rows, sharding.shard_of_documents(frame(spark, rows)).collect())
    assert sharding.shard_of_documents(frame(spark, rows).limit(0)).count() == 0


def test_even_shards_and_whole_groups(spark):
    rows = [(i, text(i % 1500, 10 + i % 1500 % 90), None, None) for i in range(3000)]
    got = sharding.shard_of_documents(frame(spark, rows)).collect()
    held = checked(rows, got)
    mean = sum(held.values()) / 40
    assert len(held) == 40 and max(held.values()) < 1.02 * mean and min(held.values()) > 0.9 * mean
    places = defaultdict(set)
    for r in got:
        places[rows[r.doc_id][1]].add(r.shard)
    assert all(len(p) == 1 for p in places.values())


def test_a_group_larger_than_a_shard_is_divided(spark):
    rows = [(i, "the same text in a third of all rows", None, None) for i in range(1000)]
    rows += [(1000 + i, text(i, 6), None, None) for i in range(2000)]
    held = checked(rows, sharding.shard_of_documents(frame(spark, rows)).collect())
    mean = sum(held.values()) / 40
    assert len(held) == 40 and max(held.values()) < 1.05 * mean


def test_rows_without_id_are_many_tasks(spark):
    """Equal rows are dealt over the parts too: no part of a number holds them all."""
    rows = [(None, "the same row", None, None)] * 3000 + [(i, text(i, 6), None, None) for i in range(1000)]
    checked(rows, sharding.shard_of_documents(frame(spark, rows)).collect())
    stored = written(spark.range(9000).selectExpr("1 AS k", "id AS row", "CAST(NULL AS BIGINT) AS doc_id"), "equal-rows")
    counted = numbered(stored, ["k"], ["doc_id", "row"], 16, "n")
    assert sorted(r.n for r in counted.collect()) == list(range(9000))
    parts = stored.groupBy(F.pmod(F.xxhash64("doc_id", "row"), F.lit(16))).count().agg(F.max("count")).first()[0]
    assert parts < 9000 / 8


def test_tree_finds_the_tightest_bin():
    import random

    pick, tree, bins = random.Random(5), sharding.CapacityTree(), []
    for step in range(2000):
        if not bins or pick.random() < 0.6:
            tree.add(size := pick.randint(0, 50), step)
            bins.append((size, step))
        else:
            wanted = pick.randint(0, 60)
            fitting = sorted(b for b in bins if b[0] >= wanted)
            assert tree.tightest(wanted) == (fitting[0] if fitting else None)
            if fitting:
                bins.remove(fitting[0])
    while bins:
        assert tree.emptiest() == max(bins)
        bins.remove(max(bins))
    assert tree.emptiest() is None


def test_packing_by_hand():
    items = [(6, 1, "a"), (5, 1, "b"), (4, 1, "c"), (3, 1, "d"), (2, 1, "e")]
    places = sharding.best_fit(items, 2, 10)
    assert places == {"a": [(0, 1)], "b": [(1, 1)], "c": [(0, 1)], "d": [(1, 1)], "e": [(1, 1)]}
    assert sharding.best_fit(items, 1, 10) is None
    assert sharding.best_fit([(2, 10, "g")], 4, 6) == {"g": [(0, 3), (1, 3), (2, 3), (3, 1)]}
    huge = sharding.pack([(100, 1, "big"), (1, 1, "x"), (1, 1, "y")], 3)
    assert len({p for places in huge.values() for p, _ in places}) == 3
