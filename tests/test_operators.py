"""Quantiles and pairs against brute force; joins, skew and pruning by their plans."""

from __future__ import annotations

import math
import random
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import combinations

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from comptoir.operators.dedup import one_per_key
from comptoir.operators.lookups import lookup_join
from comptoir.operators import pairs, sketches
from comptoir.operators.pairs import item_counts, top_pairs
from comptoir.operators.quantiles import quantiles
from comptoir.plans import gold
from comptoir.sources.stores import balanced, written
from conftest import final_plan


def brute_quantile(values, p):
    ordered = sorted(v for v in values if v is not None)
    return ordered[max(math.ceil(p * len(ordered)), 1) - 1] if ordered else None


@pytest.mark.parametrize("values", [
    [5], [3, 1, 2], [None, None], [None, 4, 4, 4, 9], [-7, -7, 0, 2**40, -(2**45), 2**62, 1, 1, 1],
    [7] * 500 + list(range(250)), [(i * 7919) % 100_003 * 1_048_576 for i in range(400)],
])
def test_quantiles(spark, values):
    df = spark.createDataFrame([(v, None if v is None else -v) for v in values], "a long, b long")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = quantiles(df, {"a": F.col("a"), "b": F.col("b")}, probs).first()
    known = [v for v in values if v is not None]
    if not known:
        assert found.a == found.b == [None] * 5
        return
    assert found.a == [brute_quantile(known, p) for p in probs]
    assert found.b == [brute_quantile([-v for v in known], p) for p in probs]


def skewed_values(n):
    """Most values small, a third equal, a long tail."""
    pick = random.Random(n)
    return [7 if pick.random() < 1 / 3 else int(pick.paretovariate(0.7) * 10) for _ in range(n)]


@pytest.mark.parametrize("error", [0.01, 0.05])
def test_sketches_keep_their_error(spark, error):
    """Direct, and merged from 60 groups of uneven size, on skewed values."""
    values, probs = skewed_values(60_000), [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    df = spark.createDataFrame([(int((i % 3600) ** 0.5), v) for i, v in enumerate(values)] + [(3, None)], "g long, v long").repartition(9)
    groups = sketches.sketched(df, "g", columns={"v": F.col("v")}, error=error)
    stored = written(groups, "sketches")
    merged = sketches.merged(stored, names=["v"]).select(sketches.estimated("v", probs).alias("v"))
    direct = quantiles(df, {"v": F.col("v")}, probs, exact=False, error=error)
    ordered = sorted(values)
    for found in (merged.first().v, direct.first().v):
        for p, v in zip(probs, found):
            low, high = bisect_left(ordered, v) / len(ordered), bisect_right(ordered, v) / len(ordered)
            assert low - error <= p <= high + error
    widest = stored.select(F.max(F.length("v"))).first()[0]
    assert widest < 20 * sketches.size_for(error) + 1000


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v long")
    for rows in (df, df.limit(0)):
        assert quantiles(rows, {"v": F.col("v")}, [0.5, 0.9], exact=False).first().v == [None, None]
    with pytest.raises(ValueError):
        sketches.size_for(0)


def brute_pairs(rows, limit, at_least, distinct=False):
    groups: dict = {}
    for g, item, label in rows:
        if g is not None and item is not None:
            groups.setdefault(g, Counter())[(item, label)] += 1
    score: Counter = Counter()
    for counts in groups.values():
        for x, y in combinations(sorted(counts), 2):
            if x[0] != y[0]:
                score[(*x, *y)] += 1 if distinct else counts[x] * counts[y]
    kept = [(a, la, b, lb, n) for (a, la, b, lb), n in score.items() if n >= at_least]
    return sorted(kept, key=lambda r: (-r[4], r[0], r[2], r[1], r[3]))[:limit]


def uneven(seed, groups, items, rows, hot_group=0.0, hot_item=0.0):
    rng = random.Random(seed)
    for _ in range(rows):
        g = 0 if rng.random() < hot_group else rng.randrange(groups)
        item = 0 if rng.random() < hot_item else rng.randrange(items)
        yield g, item, f"label {item % 3}"


CASES = {
    "even": list(uneven(1, 40, 60, 900)),
    "hot group": list(uneven(2, 40, 300, 2500, hot_group=0.4)),
    "hot item": list(uneven(3, 60, 200, 2000, hot_item=0.35)),
    "hot both": list(uneven(4, 30, 250, 2500, hot_group=0.35, hot_item=0.35)),
    "all tied": [(g, i, "x") for g in range(2) for i in range(160)],
    "one group": [(1, i, "x") for i in range(150) for _ in range(2)],
    "two labels": [(g, i, f"l{g % 2}") for g in range(6) for i in range(12)] + [(None, 1, "n"), (1, None, "n")],
    "few": [(1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (2, 2, "b"), (3, 3, "c")],
    "none": [(1, 1, "a"), (2, 2, "b")],
}


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("block_items", [20, 10**6])
@pytest.mark.parametrize("case", CASES)
def test_pairs(spark, case, block_items, distinct):
    rows = CASES[case]
    df = spark.createDataFrame(rows, "g long, i long, l string")
    counts = item_counts(df, "g", "i", "l", distinct).cache()
    found = top_pairs(counts, 100, 2, block_items=block_items)
    assert [tuple(r) for r in found.collect()] == brute_pairs(rows, 100, 2, distinct)


def test_a_larger_limit_has_its_own_bar(spark):
    """With more rows asked for than the first seeds form pairs, items are still left out."""
    rows = list(uneven(6, 60, 2000, 20_000, hot_item=0.1))
    counts = item_counts(spark.createDataFrame(rows, "g long, i long, l string"), "g", "i", "l").cache()
    bounds = pairs._bounds(counts)
    bar = pairs._bar(counts, bounds, 1000, 2)
    score = spark.range(1).select(bar.alias("bar")).first().bar.score
    assert score > 1 and bounds.where(F.col("bound") < score).count() > 0
    found = [tuple(r) for r in top_pairs(counts, 1000).collect()]
    assert found == brute_pairs(rows, 1000, 2, False)


@pytest.mark.parametrize("limit", [127, 128, 129, 500])
def test_the_bar_of_every_limit_prunes(spark, limit):
    rows = list(uneven(6, 60, 2000, 20_000, hot_item=0.1))
    counts = item_counts(spark.createDataFrame(rows, "g long, i long, l string"), "g", "i", "l").cache()
    bounds = pairs._bounds(counts)
    score = spark.range(1).select(pairs._bar(counts, bounds, limit, 2).alias("bar")).first().bar.score
    assert bounds.where(F.col("bound") < score).count() > 0
    assert [tuple(r) for r in top_pairs(counts, limit).collect()] == brute_pairs(rows, limit, 2, False)


@pytest.mark.parametrize("cells", [1, 64, 1 << 16])
def test_cells_lose_no_pair(spark, cells):
    """With few cells every pair is counted one by one, with more fewer are; the result is the same."""
    for case in ("even", "hot both", "two labels", "none"):
        rows = CASES[case]
        counts = item_counts(spark.createDataFrame(rows, "g long, i long, l string"), "g", "i", "l").cache()
        assert [tuple(r) for r in top_pairs(counts, cells=cells).collect()] == brute_pairs(rows, 100, 2, False)


def test_evenly_popular_items_are_pruned_by_cell(spark):
    """No item stands out, so the bound prunes none; of 190,000 rows of pairs few are counted one by one."""
    pick = random.Random(8)
    rows = [(g, i, "x") for g in range(1000) for i in pick.sample(range(2000), 20)]
    counts = item_counts(spark.createDataFrame(rows, "g long, i long, l string"), "g", "i", "l").cache()
    bounds = pairs._bounds(counts)
    formed = pairs._formed(pairs._side(counts, "a"), pairs._side(counts, "b"), F.lit(True))
    assert formed.count() == 190_000 and bounds.where("bound < 4").count() < 2000 / 20
    assert pairs._in_full_cells(formed, F.lit(4), 1 << 20).count() < 190_000 / 20
    assert [tuple(r) for r in top_pairs(counts, cells=1 << 20).collect()] == brute_pairs(rows, 100, 2, False)


def test_cells_are_used_where_pairs_are_many(spark, monkeypatch):
    counts = item_counts(spark.createDataFrame(CASES["even"], "g long, i long, l string"), "g", "i", "l")
    assert pairs.cells_for(counts) is None and pairs.cells_for(counts.limit(0)) is None
    monkeypatch.setattr(pairs, "OUTRIGHT", 1000)
    assert pairs.cells_for(counts) == pairs.CELLS


@pytest.mark.parametrize("case, distinct", [*((case, False) for case in CASES), ("hot both", True), ("two labels", True)])
def test_pairs_by_item(spark, case, distinct):
    """With groups in many lists and items in many shares."""
    counts = item_counts(spark.createDataFrame(CASES[case], "g long, i long, l string"), "g", "i", "l", distinct).cache()
    found = pairs.top_pairs_by_item(counts, task_pairs=500, list_items=7)
    assert [tuple(r) for r in found.collect()] == brute_pairs(CASES[case], 100, 2, distinct)


def test_pairs_by_item_of_texts_and_missing_labels(spark):
    rows = [(g, f"i{i}", None if (g + i) % 3 == 0 else "x") for g in range(8) for i in range(12)]
    counts = item_counts(spark.createDataFrame(rows, "g long, i string, l string"), "g", "i", "l").cache()
    key = lambda r: (-r[4], r[0], r[2], r[1] is None, r[1] or "", r[3] is None, r[3] or "")
    score: Counter = Counter()
    for g in range(8):
        for x, y in combinations([r[1:] for r in rows if r[0] == g], 2):
            score[(*min(x, y, key=lambda i: i[0]), *max(x, y, key=lambda i: i[0]))] += 1
    expected = sorted(((*pair, n) for pair, n in score.items() if n >= 2), key=key)[:100]
    assert [tuple(r) for r in pairs.top_pairs_by_item(counts, task_pairs=200).collect()] == expected


def test_the_shuffle_of_evenly_popular_pairs_is_a_number_each(spark):
    """No item stands out; lists of items are shuffled, no rows of pairs."""
    pick = random.Random(9)
    rows = [(g, i, "a label that need not travel with each pair") for g in range(1500) for i in pick.sample(range(3000), 30)]
    counts = item_counts(spark.createDataFrame(rows, "g long, i long, l string"), "g", "i", "l").cache()
    found = pairs.top_pairs_by_item(counts, task_pairs=100_000)
    plan = final_plan(found).partition("Initial Plan")[0]
    assert [tuple(r) for r in found.collect()] == brute_pairs(rows, 100, 2, False)
    assert plan.count("REPARTITION_BY_NUM") == 3 and "Exchange hashpartitioning(item_a" not in plan
    after = plan[:plan.index("REPARTITION_BY_NUM")]
    assert "hashpartitioning(a" in after and after.count("Exchange hashpartitioning") == 1


def test_affinity_of_many_pairs_goes_by_item(spark, house, monkeypatch):
    expected = [tuple(r) for r in gold.product_affinity(house.silver.ventes).collect()]
    monkeypatch.setattr(gold, "OUTRIGHT", 1000)
    monkeypatch.setattr(gold, "top_pairs", None)
    assert expected and [tuple(r) for r in gold.product_affinity(house.silver.ventes).collect()] == expected


def test_building_the_pairs_runs_nothing(spark):
    counts = item_counts(spark.createDataFrame([(1, 1, "a"), (1, 2, "b")] * 2, "g long, i long, l string"), "g", "i", "l")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pairs", "building")
    top_pairs(counts)
    assert list(tracker.getJobIdsForGroup("pairs")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_one_large_group_is_not_paired_in_full(spark):
    """4,200 items in one group: 9 million pairs, of which few can reach the top."""
    rows = [(0, i, "x") for i in range(4200) for _ in range(1 + (i % 10 == 0) + (i % 50 == 0) * 5)]
    rows += list(uneven(5, 800, 4200, 6_000))
    counts = item_counts(spark.createDataFrame(rows, "g long, i long, l string"), "g", "i", "l").cache()
    found = top_pairs(counts)
    duck = duckdb.connect()
    duck.register("sold", pd.DataFrame(rows, columns=["g", "i", "l"]))
    expected = duck.execute("""
        SELECT a.i, a.l, b.i, b.l, count(*) AS n FROM sold a JOIN sold b ON a.g = b.g AND a.i < b.i
        GROUP BY ALL ORDER BY n DESC, a.i, b.i, a.l, b.l LIMIT 100""").fetchall()
    assert [tuple(r) for r in found.collect()] == expected


def skewed(spark):
    left = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 31 == 0, None).otherwise(F.col("id") % 5000).alias("k"), "id")
    right = spark.range(5000).select(F.col("id").alias("k")).groupBy("k").agg(F.max("k").alias("v"))
    return left.repartition(16), right


def test_hot_key_of_a_large_lookup_is_split(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50k")
    left, right = skewed(spark)
    joined = lookup_join(left, right, "k")
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert joined.count() == 200_000
    assert joined.where("k IS NOT NULL AND v <> k OR k IS NULL AND v IS NOT NULL").count() == 0


def test_hot_date_is_split_over_files(spark, conf):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50k")
    day = F.when(F.col("id") % 3 > 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date")
    rows = spark.range(300_000).select(day.alias("date_vente"), F.xxhash64("id").alias("x")).repartition(16)
    assert "skewed" in final_plan(balanced(rows, "date_vente"))


def test_copies_of_one_key_are_combined_before_the_shuffle(spark):
    rows = spark.range(100_000).select(F.pmod("id", F.lit(1)).alias("k"), (F.col("id") % 5).alias("v"))
    plan = one_per_key(rows, "k")._jdf.queryExecution().executedPlan().toString()
    final, shuffle, partial = (plan.index(s) for s in ("[min(struct", "Exchange hashpartitioning(k", "partial_min(struct"))
    assert final < shuffle < partial


def test_small_lookup_is_broadcast_after_its_size_is_known(spark):
    left, right = skewed(spark)
    assert "BroadcastHashJoin" in final_plan(lookup_join(left, right, "k"))


def test_unused_lookups_are_not_joined(house):
    plan = house.gold.ca_daily._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan


def test_no_cross_joins(house):
    for name in ("ca_by_canal", "stock_alert", "client_rfm", "daily_trend", "product_affinity"):
        plan = house.gold[name]._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_only_needed_columns_are_read(house):
    plan = house.bronze.retours.select("retour_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string>" in plan
    assert "EqualTo(l_returnflag,R)" in plan
