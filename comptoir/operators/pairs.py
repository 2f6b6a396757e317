"""Most frequent item pairs within groups, without writing out every pair.

The score of a pair is the number of row pairs it forms inside the groups:
the sum over groups of ``k_a * k_b``, with ``k`` the rows of the item in the
group. Rows are therefore counted per group and item before anything is paired.

Groups with many items give a quadratic number of pairs, so pairs that cannot
reach the result are left out beforehand, exactly, by one plan at every size:

1. An item's *bound* is the sum over its groups of ``k`` times the largest ``k``
   in the group. No pair with this item scores above it.
2. The pairs among a few items with the highest bounds are scored in full. The
   last of the best ``limit`` of them is the *bar*: the result cannot contain a
   pair that sorts after it.
3. An item whose bound is under the bar is in no result pair. One whose bound
   equals the bar matters only in ties, which the item order settles.
4. What remains of a group is dealt into blocks of ``BLOCK_ITEMS`` items, so a
   large group is paired by many tasks.
5. If more than ``OUTRIGHT`` rows of pairs may be formed, pairs are first hashed to
   ``CELLS`` cells and their scores summed by cell. A cell's sum is the score of each of its pairs plus that of the pairs that share the
   cell: never too low, and too high by ``all scores / CELLS`` on average. The
   sums of parts of the data add up, so every map task sums first. Pairs of a
   cell under the bar are in no result; only the others are counted one by one.

One item or group that dominates makes the bar high, so few items remain after
step 3. Where items are evenly popular, step 3 prunes little; step 5 does as long
as the bar is well above ``all scores / CELLS``. Step 5 changes the work, never
the result; at fewer rows counting them outright is faster.

Rows of pairs grow with the input while the bar of evenly popular items does not,
so past some size all cells are full. ``top_pairs_by_item`` therefore shuffles no
pairs: each item gets, from every group, the list of the items that follow it
there, a number for each, and its pairs are formed and counted in the task that
holds the lists. An item with very many partners is counted by several tasks, each
with some of the partners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from comptoir.operators.lookups import lookup_join
from comptoir.operators.marks import cell_is_marked, marked_cells
from comptoir.sources.stores import written

#: Items whose pairs give the bar; more if the limit is larger.
LEAST_SEEDS = 128
BLOCK_ITEMS = 4096
#: Sums of step 5; a power of two. The marks of the cells, a bit each, are what every task holds.
CELLS = 1 << 24
#: Rows of pairs that are counted outright.
OUTRIGHT = 1 << 24
#: Rows of pairs that one task of ``top_pairs_by_item`` is to count, and items of a group that one list may have.
TASK_PAIRS = 1 << 21
LIST_ITEMS = 1024


def item_counts(
    rows: DataFrame, group: str, item: str, label: str, distinct_groups: bool = False
) -> DataFrame:
    """g, item (struct id, label) and k. ``distinct_groups`` sets every k to 1."""
    known = rows.where(F.col(group).isNotNull() & F.col(item).isNotNull())
    keys = known.groupBy(
        F.col(group).alias("g"), F.struct(F.col(item).alias("id"), F.col(label).alias("label")).alias("item"))
    k = F.lit(1).cast("long") if distinct_groups else F.count("*")
    return keys.agg(k.alias("k"))


def top_pairs(
    counts: DataFrame, limit: int = 100, at_least: int = 2, block_items: int = BLOCK_ITEMS, cells: int | None = None,
) -> DataFrame:
    """Columns a, label_a, b, label_b, score with a < b; the best ``limit`` pairs.

    ``counts`` comes from ``item_counts`` and is read several times, so it
    should be a stored table. ``cells`` (see ``cells_for``) turns step 5 on.
    Nothing is run when this is called.
    """
    bounds = _bounds(counts)
    bar = _bar(counts, bounds, limit, at_least)
    level = F.coalesce(bar["score"], F.lit(at_least - 1))
    tied = lambda condition: F.coalesce(condition, F.lit(False))
    marked = bounds.withColumn("level", level).where("bound >= level").select(
        "item",
        (F.col("bound") > F.col("level")).alias("above"),
        tied(F.col("item.id") < bar["a"]).alias("before"),
        tied(F.col("item.id") == bar["a"]).alias("at"),
        tied(F.col("item.id") <= bar["b"]).alias("upto"),
    )
    kept = lookup_join(counts, marked, "item", "inner")
    can_reach = (
        (F.col("above_a") & F.col("above_b")) | F.col("before_a") | (F.col("at_a") & F.col("upto_b")))
    left, right = _in_blocks(kept.where("above or before or at"), kept, block_items)
    pairs = _formed(left, right, can_reach, ("g", "part"))
    if cells:
        pairs = _in_full_cells(pairs, F.greatest(level, F.lit(at_least)), cells)
    return _best(_summed(pairs), limit, at_least)


def rows_of_pairs(counts: DataFrame) -> float:
    """How many rows of pairs the items of the groups form; one small job."""
    size = F.col("n").cast("double")
    return counts.groupBy("g").agg(F.count("*").alias("n")).agg(F.sum(size * (size - 1) / 2)).first()[0] or 0


def cells_for(counts: DataFrame) -> int | None:
    """``CELLS`` if the items of the groups form so many pairs that step 5 pays."""
    return CELLS if rows_of_pairs(counts) > OUTRIGHT else None


def top_pairs_by_item(
    counts: DataFrame, limit: int = 100, at_least: int = 2, task_pairs: int = TASK_PAIRS, list_items: int = LIST_ITEMS,
) -> DataFrame:
    """As ``top_pairs``, for any number of pairs. Writes its lists first, so ``counts`` should be a stored table."""
    items = _items(counts)
    found = counts.sparkSession.range(1).select(_bar(counts, items, limit, at_least).alias("bar")).first().bar
    level = found.score if found else at_least - 1
    load = F.col("load").cast("double")
    above, all_loads = items.agg(F.sum(F.when(F.col("bound") > level, load)), F.sum(load)).first()
    follows = lambda a, b: b > a
    if pruned := (above or 0) < 0.75 * (all_loads or 0):  # else leaving items out costs more than it saves
        marked = items.where(F.col("bound") >= level).select("item", (F.col("bound") > level).alias("above"))
        counts = written(lookup_join(counts, marked, "item", "inner").select(*counts.columns, "above"), "pair-kept")
        items = _items(counts)
        all_loads = items.agg(F.sum(load)).first()[0]
        upto = lambda a, b: (a < found.a) | ((a == found.a) & (b <= found.b)) if found else F.lit(False)
        follows = lambda a, b: (b > a) & ((F.col("above_a") & F.col("above_b")) | upto(a, b))
    tasks = int((all_loads or 0) / 2 // task_pairs) + 1
    lists = written(_lists(counts if pruned else counts.withColumn("above", F.lit(True)), items, list_items, tasks), "pair-lists")
    every_part = lists.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left, right = (
        _side(side.drop("parts"), name, ("g", "part")).repartition(tasks, "g", "part") for side, name in ((lists, "a"), (every_part, "b")))
    met = left.join(right, ["g", "part"]).withColumn("a", F.explode("ids_a"))
    partners = F.filter("ids_b", lambda b: follows(F.col("a"), b))
    lines = met.select("a", "v_a", "v_b", (F.col("k_a") * F.col("k_b")).alias("k"), partners.alias("partners"))
    placed = _in_shares(lines, items, task_pairs).where(F.size("partners") > 0).repartition(tasks, "a", "share")
    pairs = placed.select("a", "share", "v_a", F.explode("partners").alias("b"), "v_b", "k")
    scored = pairs.groupBy("a", "share", "b", "v_a", "v_b").agg(F.sum("k").alias("score"))
    best = scored.where(F.col("score") >= at_least).orderBy(F.desc("score"), "a", "b", "v_a", "v_b").limit(limit)
    for side in "ab":
        names = items.select(F.col("item.id").alias(side), F.col("v").alias(f"v_{side}"), F.col("item.label").alias(f"label_{side}"))
        best = names.join(F.broadcast(best), [side, f"v_{side}"])
    return best.select("a", "label_a", "b", "label_b", "score").orderBy(*_result_order())


def _items(counts: DataFrame) -> DataFrame:
    """item, bound, load (the items of its groups) and v, which tells the labels of one id apart; stored."""
    groups = counts.groupBy("g").agg(F.max("k").alias("largest"), F.count("*").alias("items")).where("items > 1")
    items = lookup_join(counts, groups, "g", "inner").groupBy("item").agg(
        F.sum(F.col("k") * F.col("largest")).alias("bound"), F.sum("items").alias("load"))
    labels = Window.partitionBy("item.id").orderBy(F.asc_nulls_last("item.label"))
    return written(items.withColumn("v", F.row_number().over(labels) - 1), "pair-items")


def _lists(counts: DataFrame, items: DataFrame, list_items: int, tasks: int) -> DataFrame:
    """g, part, k, v, above, parts, ids: a group's items of one k, label and flag, in ``parts`` parts by the id."""
    sizes = counts.groupBy("g").agg(F.count("*").alias("items")).where(F.col("items") > list_items)
    parts = written(sizes.select("g", F.ceil(F.col("items") / list_items).cast("int").alias("parts")).coalesce(1), "pair-parts")
    further = items.where("v > 0")
    v = F.lit(0)
    if not further.isEmpty():
        counts, v = lookup_join(counts, further.select("item", "v"), "item"), F.coalesce("v", F.lit(0))
    known = lookup_join(counts.withColumn("v", v), parts, "g").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("item.id"), F.col("parts")).cast("int")
    flat = known.select("g", part.alias("part"), "k", "v", "above", "parts", F.col("item.id").alias("id"))
    together = flat.repartition(tasks, "g", "part")
    return together.groupBy("g", "part", "k", "v", "above", "parts").agg(F.collect_list("id").alias("ids"))


def _in_shares(lines: DataFrame, items: DataFrame, task_pairs: int) -> DataFrame:
    """``lines`` with a column ``share``; those of an item with very many partners are cut into shares by partner."""
    loads = items.groupBy(F.col("item.id").alias("a")).agg(F.sum("load").alias("load"))
    heavy = loads.where(F.col("load") > 2 * task_pairs).select("a", F.ceil(F.col("load") / task_pairs).cast("int").alias("shares"))
    # At most as many rows as there are tasks.
    cut = lines.join(written(heavy.coalesce(1), "pair-shares"), "a", "left")
    cut = cut.withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)))
    own = F.filter("partners", lambda b: F.pmod(F.xxhash64(b), F.col("shares")) == F.col("share"))
    return cut.withColumn("partners", F.when(F.col("shares").isNull(), F.col("partners")).otherwise(own)).drop("shares")


def _in_full_cells(pairs: DataFrame, level: Column, cells: int) -> DataFrame:
    """The rows of ``pairs`` whose cell sums to ``level`` or more."""
    cell = F.xxhash64("item_a", "item_b").bitwiseAND(F.lit(cells - 1))
    sums = pairs.groupBy(cell.alias("cell")).agg(F.sum("score").alias("n"))
    full = sums.withColumn("level", level).where("n >= level")
    return pairs.where(cell_is_marked(marked_cells(full.select("cell"), cells, cells), cell))


def _in_blocks(left: DataFrame, right: DataFrame, block_items: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``part``: a left row is in one block of its group, a right row in all of them."""
    sizes = right.groupBy("g").agg(F.count("*").alias("n"))
    parts = sizes.select("g", F.ceil(F.col("n") / block_items).cast("int").alias("parts"))
    left, right = (lookup_join(side, parts, "g", "inner") for side in (left, right))
    left = left.withColumn("part", F.pmod(F.xxhash64("item"), F.col("parts")).cast("int"))
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return _side(left.drop("parts"), "a", ("g", "part")), _side(right.drop("parts"), "b", ("g", "part"))


def _bounds(counts: DataFrame) -> DataFrame:
    """item, bound. Groups with a single item form no pair and add nothing."""
    groups = counts.groupBy("g").agg(F.max("k").alias("largest"), F.count("*").alias("items"))
    largest = groups.where("items > 1").select("g", "largest")
    both = lookup_join(counts, largest, "g", "inner")
    return both.groupBy("item").agg(F.sum(F.col("k") * F.col("largest")).alias("bound"))


def _bar(counts: DataFrame, bounds: DataFrame, limit: int, at_least: int) -> Column:
    """Scalar struct (score, a, b), null when the seeds form too few pairs."""
    order = [F.desc("bound"), F.asc("item")]
    count = max(LEAST_SEEDS, 2 * limit)
    seeds = bounds.orderBy(*order).limit(count)
    seeds = seeds.select("item", F.row_number().over(Window.orderBy(*order)).alias("place"))
    # ``count`` rows, so the broadcast is bounded; so are the rows per group.
    inside = counts.join(F.broadcast(seeds), "item")
    # The first seed meets all others, which alone is more than ``limit`` pairs, and later ones fewer.
    near = F.col("place_a") * F.col("place_b") <= count
    best = _best(_summed(_formed(_side(inside, "a"), _side(inside, "b"), near)), limit, at_least)
    nth = F.row_number().over(Window.orderBy(*_result_order()))
    last = best.select("*", nth.alias("nth")).where(F.col("nth") == limit)
    return last.agg(F.max(F.struct("score", "a", "b"))).scalar()


def _side(df: DataFrame, side: str, shared: tuple[str, ...] = ("g",)) -> DataFrame:
    return df.select(*shared, *(F.col(c).alias(f"{c}_{side}") for c in df.columns if c not in shared))


def _formed(left: DataFrame, right: DataFrame, condition: Column, on: tuple[str, ...] = ("g",)) -> DataFrame:
    """item_a, item_b, score: one row per pair and group."""
    ordered = F.col("item_a.id") < F.col("item_b.id")
    together = left.join(right, list(on)).where(ordered & condition)
    return together.select("item_a", "item_b", (F.col("k_a") * F.col("k_b")).alias("score"))


def _summed(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("item_a", "item_b").agg(F.sum("score").alias("score"))


def _result_order():
    return [F.desc("score"), F.asc("a"), F.asc("b"), F.asc_nulls_last("label_a"), F.asc_nulls_last("label_b")]


def _best(scored: DataFrame, limit: int, at_least: int) -> DataFrame:
    flat = scored.where(F.col("score") >= at_least).select(
        F.col("item_a.id").alias("a"), F.col("item_a.label").alias("label_a"),
        F.col("item_b.id").alias("b"), F.col("item_b.label").alias("label_b"), "score",
    )
    return flat.orderBy(*_result_order()).limit(limit)
