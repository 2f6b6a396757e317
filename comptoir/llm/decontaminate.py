"""Benchmark decontamination: MinHash containment search, verified exactly.

A test item is in a document if the document holds at least 75% of the item's
shingles (five words; the whole sequence of a shorter text). Items are short and
documents long, so the similarity of whole sets is near zero and says nothing;
what counts is containment in the item.

*Size partitions.* Items are partitioned by their number of shingles n, in
powers of two. Each partition has its own number of agreeing positions that make
a candidate: a fourth of its smallest n, one at least. An item's sketch are its
``n - ceil(0.75 n) + agree`` first shingles in MinHash order, the fewest of which
a containing document must hold ``agree``; so recall is 1. Shingles that are in
many items come last in that order (by powers of two of their frequency among
items, then by hash): a sentence that items share is in few sketches, and alone
makes no candidate.

*Search.* All shingles of the documents meet the sketches in one equality join
on the hash: the items' side is broadcast if its counted rows are few. Otherwise
both are shuffled, and of the documents only what marks of the sketches let pass.
Agreements are counted by document and item.

*Verification.* Candidates are joined with all shingles of their item, and these
by document and shingle with the candidate documents, read again; no pair but a
candidate is formed. Hashes of 64 bits stand for shingles.

DataFrame functions only. Nulls: a null text, and one without a word, has no
shingles, so it contains nothing and is contained nowhere. The filter judges
each text of a document by each text of an item, whatever their ids: null and
repeated ids neither hide nor drop anything. The report is by id and, as its SQL
twin has it, takes null as an id and counts the texts of one id together. Empty
tables give no rows. Other columns pass through the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from comptoir.llm.common import column, fresh
from comptoir.operators.lookups import lookup_join
from comptoir.operators.marks import key_marks, may_hold
from comptoir.sources.stores import written

WORDS = 5
#: Containment, as a fraction.
LEAST = (3, 4)
#: What separates words: anything but letters and digits.
GAPS = r"[^\p{L}\p{N}]+"
#: Agreeing positions of a partition: its smallest number of shingles, shifted right by so many bits.
AGREE_SHIFT = 2
#: Rows that may be broadcast (16 to 24 bytes each).
BROADCAST_ROWS = 1_000_000


def _hashes(words: Column) -> Column:
    """Of an array of words, the array of hashed shingles, as often as they occur."""
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.greatest(F.size(words) - (WORDS - 1), F.lit(1))))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WORDS)))


def _shingles(rows: DataFrame, id_column: str) -> DataFrame:
    """(id, hash): one row per shingle of a text, repeats included."""
    words = F.filter(F.split(F.lower("text"), GAPS), lambda w: w != "")
    # Bound to a lambda variable, the words are made once per text however the plan is rewritten.
    hashes = F.transform(F.array(words), _hashes)[0]
    # Outer, as an inner explode has Spark compute the array once more to filter empty ones.
    exploded = rows.select(id_column, hashes.alias("hashes")).select(id_column, F.explode_outer("hashes").alias("hash"))
    return exploded.where("hash IS NOT NULL")


def _sized(df: DataFrame, purpose: str) -> DataFrame:
    """Stored, and marked for broadcast if it has few rows."""
    stored = written(df, purpose)
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def item_shingles(items: DataFrame) -> DataFrame:
    """item_id, hash, n (shingles of the item), needed (to contain it), agree, rank in the order of sketches."""
    distinct = _shingles(items.select("item_id", "text"), "item_id").distinct()
    shared = distinct.groupBy("hash").agg(F.count(F.lit(1)).alias("items"))
    power = lambda c: F.length(F.bin(c))  # rises by one when the number doubles
    order = Window.partitionBy("item_id").orderBy(power(F.col("items")), "hash")
    sizes = distinct.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    same = F.col("item_id").eqNullSafe(F.col("of"))
    sized = lookup_join(distinct, shared, "hash").join(sizes.withColumnRenamed("item_id", "of"), same).drop("of")
    up, down = LEAST
    least_of_partition = F.shiftright(F.pow(F.lit(2), power(F.col("n")) - 1).cast("long"), AGREE_SHIFT)
    return sized.select(
        "item_id", "hash", "n", F.ceil(F.col("n") * up / down).alias("needed"),
        F.greatest(least_of_partition, F.lit(1)).alias("agree"), F.row_number().over(order).alias("rank"))


def _candidates(docs: DataFrame, every: DataFrame) -> DataFrame:
    """doc, item: the pairs that agree in enough positions of the item's sketch."""
    sketch = written(every.where("rank <= n - needed + agree").select("hash", F.col("item_id").alias("item"), "agree"), "item-sketches")
    probes = _shingles(docs, "doc_id")
    if sketch.count() <= BROADCAST_ROWS:
        sketch = F.broadcast(sketch)
    else:
        probes = probes.where(may_hold(key_marks(sketch.select("hash")), F.col("hash")))
    met = probes.join(sketch, "hash").groupBy(F.col("doc_id").alias("doc"), "item").agg(
        F.count_distinct("hash").alias("agreeing"), F.max("agree").alias("agree"))
    return met.where("agreeing >= agree").select("doc", "item")


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment of every item in every document that holds it."""
    docs = docs.select("doc_id", "text")
    every = written(item_shingles(items), "item-shingles")
    candidates = written(_candidates(docs, every), "leak-candidates")

    ids = _sized(candidates.select("doc").distinct(), "leak-documents")
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("doc")), "left_semi")
    held = _shingles(texts, "doc_id").join(_sized(every.select("hash").distinct(), "item-hashes"), "hash", "left_semi").distinct()
    wanted = candidates.join(every, F.col("item").eqNullSafe(F.col("item_id")))
    wanted = wanted.select("doc", "item_id", F.col("hash").alias("of"), "n", "needed")
    # Placed by document and shingle together, so neither a long document nor a common shingle is one task.
    shared = wanted.join(held, (F.col("hash") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("doc")))
    counted = shared.groupBy("doc_id", "item_id").agg(
        F.max("n").alias("n_item"), F.max("needed").alias("needed"), F.count(F.lit(1)).alias("n_shared"))
    whole = counted.where("n_shared >= needed")
    return whole.select("doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item; columns as in ``docs``.

    Texts go by a key of their own, so that ids do not matter.
    """
    (of,) = fresh(docs, "_held_in")
    key = F.unhex(F.md5("text"))
    by_text = lambda rows, name: rows.select(key.alias(name), "text")
    found = contained_items(by_text(docs, "doc_id"), by_text(items, "item_id"))
    held = written(found.select(F.col("doc_id").alias(of)).distinct(), "leaks")
    small = F.broadcast(held) if held.count() <= BROADCAST_ROWS else held
    return docs.join(small, key == column(of), "left_anti")


CONTAINED_ITEMS_SQL = """
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
split AS (
  SELECT kind, id, row_number() OVER () AS row,
         list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS words FROM texts),
words AS (SELECT kind, id, row, len(words) AS n, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM split),
runs AS (
  SELECT kind, id, n, pos, string_agg(w, ' ') OVER (PARTITION BY row ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS shingle
  FROM words),
shingles AS (SELECT DISTINCT kind, id, shingle FROM runs WHERE pos <= greatest(n - 4, 1)),
items AS (SELECT id, shingle, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE kind = 'i'),
shared AS (
  SELECT d.id AS doc_id, i.id AS item_id, any_value(n) AS n_item, count(*) AS n_shared
  FROM items i JOIN shingles d ON d.kind = 'd' AND d.shingle = i.shingle GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared, n_shared::DOUBLE / n_item AS containment
FROM shared WHERE 4 * n_shared >= 3 * n_item
"""
