"""Sharding by best-fit-decreasing bin packing.

Indivisible groups (documents with equal text), largest first, each enter the
shard whose remaining capacity is the tightest that holds them, found in a
balanced tree.

Packing is sequential, so its input has a fixed bound. A group that holds more
than ``1 / GRAIN`` of a shard is an item of its own; there are at most ``GRAIN``
times the number of shards of them. All smaller groups are dealt by hash into
as many crates, whole, and a crate is one item. The driver packs these items;
everything that has one row per document or per text stays in Spark.

A group larger than a shard, such as one text in a third of all rows, is
divided over the emptiest ones. Other groups stay whole, unless shards would
then differ by more than ``WHOLE_SLACK``: only then are those divided, too,
that fit into no shard.

Nulls: a null text has no bytes and CRC 0; all null texts are one group. Ids
may be null or repeated. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F

from comptoir.llm.common import column, fresh, numbered
from comptoir.sources.stores import written

SHARDS = 40
GRAIN = 256
ROW_BYTES = 16
#: Room over an even share, as a fraction, up to which groups stay whole.
WHOLE_SLACK = 1 / 32
#: Rows of a shard that one task numbers, about.
PART_ROWS = 200_000


class CapacityTree:
    """Bins by remaining capacity, in a treap: all steps take the log of their number."""

    def __init__(self):
        self._root = None  # (remaining, bin), priority, left, right

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, remaining: int, number: int) -> None:
        priority = hashlib.blake2b(f"{remaining}/{number}".encode(), digest_size=8).digest()
        low, high = self._split(self._root, (remaining, number))
        self._root = self._merge(self._merge(low, [(remaining, number), priority, None, None]), high)

    def _take(self, low, middle, high):
        self._root = self._merge(low, high)
        return middle[0] if middle else None

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least remaining capacity of at least ``size``."""
        low, rest = self._split(self._root, (size, -1))
        node = rest
        while node and node[2]:
            node = node[2]
        if node is None:
            return self._take(low, None, rest)
        taken, high = self._split(rest, (node[0][0], node[0][1] + 1))
        return self._take(low, taken, high)

    def emptiest(self) -> tuple[int, int] | None:
        node = self._root
        while node and node[3]:
            node = node[3]
        if node is None:
            return None
        low, taken = self._split(self._root, node[0])
        return self._take(low, taken, None)


def best_fit(items: list[tuple[int, int, object]], shards: int, capacity: int, whole: bool = False) -> dict | None:
    """key -> [(shard, copies)] for items (size of a copy, copies, key); None if they do not fit.

    Items come in any order. ``shards`` bounds the bins that may be opened. With
    ``whole``, only items larger than a bin may be divided.
    """
    tree, opened, places = CapacityTree(), 0, {}
    for each, count, key in sorted(items, key=lambda x: (-x[0] * x[1], str(x[2]))):
        found = tree.tightest(each * count)
        if found is None and opened < shards and each * count <= capacity:
            found, opened = (capacity, opened), opened + 1
        if found is not None:
            places[key] = [(found[1], count)]
            tree.add(found[0] - each * count, found[1])
            continue
        if whole and each * count <= capacity:
            return None
        places[key] = []
        while count:  # divided
            if opened < shards:
                found, opened = (capacity, opened), opened + 1
            else:
                found = tree.emptiest()
            fit = min(count, found[0] // each)
            if fit == 0:
                return None
            places[key].append((found[1], fit))
            tree.add(found[0] - each * fit, found[1])
            count -= fit
    return places


def pack(items: list[tuple[int, int, object]], shards: int) -> dict:
    """Packs into ``shards`` bins of the smallest common capacity that is found to do.

    A single document larger than an even share gets a shard of its own.
    """
    rest, places, own = sorted(items, key=lambda x: -x[0]), {}, 0
    left = sum(each * count for each, count, _ in rest)
    while rest and own < shards - 1 and rest[0][0] * (shards - own) > left:
        each, count, key = rest[0]
        places.setdefault(key, []).append((shards - 1 - own, 1))
        own, left = own + 1, left - each
        rest = ([(each, count - 1, key)] if count > 1 else []) + rest[1:]
    if rest:
        even = max(rest[0][0], -(-left // (shards - own)))
        slack, whole = 0, True
        while (found := best_fit(rest, shards - own, even + slack, whole)) is None:
            slack = max(2 * slack, even >> 12, 1)
            if whole and slack > even * WHOLE_SLACK:
                slack, whole = 0, False
        for key, placed in found.items():
            places.setdefault(key, []).extend(placed)
    return places


def best_fit_shards(docs: DataFrame, shards: int = SHARDS, grain: int = GRAIN, row_bytes: int = ROW_BYTES) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: one row per document."""
    spark, text = docs.sparkSession, F.coalesce("text", F.lit(""))
    measured = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + row_bytes).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNull(), F.lit("")).otherwise(F.md5("text")).alias("digest"),
        F.monotonically_increasing_id().alias("row"),  # stored, it tells equal rows apart from here on
    )
    stored = written(measured, "shard-sizes")
    totals = stored.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    grain_bytes = max(1, (totals.bytes or 0) // (shards * grain))
    crate = F.pmod(F.xxhash64("digest"), F.lit(shards * grain)).cast("string")
    groups = stored.groupBy("digest").agg(F.max("size").alias("each"), F.count(F.lit(1)).alias("copies"))
    large = F.col("each") * F.col("copies") > grain_bytes
    groups = written(groups.withColumn("item", F.when(large, F.col("digest")).otherwise(crate)), "shard-groups")
    own = groups.where(large).select("item", "each", "copies")
    crates = groups.where(~large).groupBy("item").agg(
        F.sum(F.col("each") * F.col("copies")).alias("each"), F.lit(1).cast("long").alias("copies"))
    items = own.unionAll(crates).collect()  # at most 2 * shards * grain rows
    places = pack([(r["each"], r["copies"], r["item"]) for r in items], shards)
    rows = []
    for item, placed in places.items():
        first = 0
        for shard, count in placed:
            rows.append((item, len(placed) > 1, first, first + count, shard))
            first += count
    placed = spark.createDataFrame(rows, "item string, divided boolean, from_copy long, to_copy long, shard int")
    whole = placed.where("not divided").select(F.col("item").alias("_item"), "shard")
    pieces = placed.where("divided").groupBy(F.col("item").alias("digest")).agg(
        F.collect_list(F.struct("from_copy", "to_copy", "shard")).alias("pieces"))
    # Both have at most one row per item, so these broadcasts have the items' bound.
    big = groups.where(large).select("digest").where(F.lit(True))
    of = stored.join(F.broadcast(big.withColumn("_own", F.lit(True))), "digest", "left")
    of = of.withColumn("_item", F.when(F.col("_own"), F.col("digest")).otherwise(crate)).drop("_own")
    in_one = of.join(F.broadcast(whole), "_item").select("doc_id", "size", "text_crc32", "row", "shard")
    split = of.join(F.broadcast(pieces), "digest")
    parts = max(16, -(-totals.rows // (shards * PART_ROWS)))
    counted = numbered(split, ["digest"], ["doc_id", "row"], max(parts, totals.rows // PART_ROWS), "copy")
    piece = F.filter("pieces", lambda p: (p["from_copy"] <= F.col("copy")) & (F.col("copy") < p["to_copy"]))
    in_many = counted.select("doc_id", "size", "text_crc32", "row", piece[0]["shard"].alias("shard"))
    dealt = written(in_one.unionAll(in_many), "shard-places")
    return numbered(dealt, ["shard"], ["doc_id", "row"], parts, "slot").drop("row")


def shard_of_documents(docs: DataFrame) -> DataFrame:
    """The digest of the sharding under the law ``bytes``."""
    return best_fit_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
