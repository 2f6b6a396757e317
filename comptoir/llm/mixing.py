"""Mixing sources to target weights: repetition rates and hash-seeded copies.

Words are summed per source, targets shared out by weight, and a source's rate
is its target over its size. Each document is emitted ``floor(rate)`` times and
once more with probability ``rate - floor(rate)``, drawn from a hash of the
seed, the document's id and its text: reruns agree, in any partitioning.
DataFrame functions only.

Nulls: a null source is a source of its own, last in order; a null text has no
words, is emitted by the same rule and takes nothing. Repeated rows (same
source, id and text) are numbered, and each has a draw of its own. A source without words has target 0 and rate 0. An
empty table gives an empty mix. Other columns pass through unchanged. Targets are
set in one task over one small row per source: millions of sources (hosts, say) are
a sort of millions of rows there, and a larger join, but not a limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from comptoir.llm.common import column, fresh, numbered, word_count
from comptoir.operators.lookups import lookup_join
from comptoir.sources.stores import written

WEIGHTS = (5, 2, 1)
#: All targets together, as a fraction (numerator, denominator) of all words.
SHARE = (3, 2)
#: A target is at most this multiple of its source's size.
MOST = 2
SEED = "mix-1"
_DRAW_DIGITS = 12
#: Tasks over which the copies of one row are numbered.
COPY_PARTS = 256


def draw(doc_id: Column, text: Column, copy: Column | None = None, seed: str = SEED) -> Column:
    """A number in [0, 1) from the leading hex digits of an MD5. ``copy`` counts repeated rows from 0."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    again = F.lit("") if copy is None else F.when(copy > 0, F.concat(F.lit("/"), copy.cast("string"))).otherwise(F.lit(""))
    digest = F.md5(F.concat(F.lit(seed), F.lit("/"), part(doc_id), F.lit("/"), part(text), again))
    return F.conv(F.substring(digest, 1, _DRAW_DIGITS), 16, 10).cast("double") / F.lit(float(16**_DRAW_DIGITS))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST,
) -> DataFrame:
    """source, source_size, target and rate, from one row (source, source_size) per source.

    Weights repeat over the sources by code point. A target over ``most`` times
    its source's size stops there and the excess is shared again by weight.
    The end of that is ``min(cap, level * weight)`` for one common level, found
    here without rounds: by rising ``cap / weight`` sources are capped as long
    as what is left for the rest would lift them over their cap. The windows
    hold one row per source.
    """
    over_all = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*(F.lit(w).cast("long") for w in weights)), F.pmod(place - 1, F.lit(len(weights))) + 1)
    up, down = share
    ranked = sizes.select("source", "source_size", place.alias("place"), weight.alias("weight"))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    # In whole numbers until the one division: ``left`` is the words to share times ``down``.
    left = F.sum("source_size").over(over_all) * up - earlier("cap") * down
    shares = F.sum("weight").over(over_all) - earlier("weight")
    stepped = ranked.select("*", left.alias("left"), (shares * down).alias("shares"), F.row_number().over(rising).alias("step"))
    capped = F.col("cap") / F.col("weight") <= F.col("left") / F.col("shares")
    first = F.min(F.when(~capped, F.struct("step", "left", "shares"))).over(over_all)
    levelled = stepped.select("*", first.alias("first"))
    target = F.when(
        F.col("first").isNull() | (F.col("step") < F.col("first.step")), F.col("cap").cast("double"),
    ).otherwise((F.col("weight") * F.col("first.left")) / F.col("first.shares"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return levelled.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def copies(rate: Column, drawn: Column) -> Column:
    return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _row_key() -> Column:
    return F.xxhash64("source", "doc_id", F.col("text").isNull(), "text")


def _repeated(rows: DataFrame) -> DataFrame:
    """key, n of the keys that several rows have. Counted before the shuffle."""
    return written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "mix-repeated")


def plan(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies: one row per document.

    The text is read once; ids, sizes and draws are stored, as they are read
    for the sums and again for the plan.
    """
    measured = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("draw"), _row_key().alias("key"))
    stored = written(measured, "mix-sizes")
    sums = stored.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sums, **options), "mix-targets")  # its true size decides on a broadcast
    repeated = _repeated(stored)
    marked = lookup_join(stored, repeated, "key")
    columns = ["doc_id", "source", "size", "draw"]
    # Rows that occur once have their draw; the others are read again, numbered and drawn one by one.
    again = docs.withColumn("key", _row_key()).join(repeated, "key", "left_semi").select(
        "doc_id", "source", "text", "key", word_count(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("row"))
    again = numbered(written(again, "mix-copies"), ["key"], ["row"], COPY_PARTS, "copy")
    drawn = marked.where("n IS NULL").select(*columns).unionAll(
        again.select("doc_id", "source", "size", draw(F.col("doc_id"), F.col("text"), F.col("copy")).alias("draw")))
    joined = drawn.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    return joined.drop("of").withColumn("copies", copies(F.col("rate"), F.col("draw"))).drop("draw")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, whole, each as often as it is taken; columns as in ``docs``.

    Two passes over the text: one for the sums, one that emits. Repeated rows
    are stored before they are numbered.
    """
    of, rate, one, key, row, copy = fresh(docs, "_of", "_rate", "_one", "key", "row", "_copy")
    measured = written(docs.select("source", word_count(F.col("text")).alias("size"), _row_key().alias("key")), "mix-sizes")
    sums = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sums, **options), "mix-targets").select(F.col("source").alias(of), F.col("rate").alias(rate))
    repeated = _repeated(measured).select(F.col("key").alias(key))

    def emitted(rows: DataFrame, drawn: Column) -> DataFrame:
        joined = rows.join(targets, F.col("source").eqNullSafe(column(of)))
        times = copies(column(rate), drawn).cast("int")
        return joined.withColumn(one, F.explode(F.array_repeat(F.lit(1), times))).select(*(column(c) for c in docs.columns))

    id_and_text = F.col("doc_id"), F.col("text")
    if repeated.isEmpty():
        return emitted(docs, draw(*id_and_text))
    keyed = docs.withColumn(key, _row_key())
    again = written(keyed.join(repeated, key, "left_semi").withColumn(row, F.monotonically_increasing_id()), "mix-copies")
    counted = numbered(again, [key], [row], COPY_PARTS, copy)
    once = keyed.join(repeated, key, "left_anti")
    return emitted(once, draw(*id_and_text)).unionAll(emitted(counted, draw(*id_and_text, column(copy))))


def mixed_words(docs: DataFrame) -> DataFrame:
    """The digest of the mix: how many words it takes of each document."""
    return plan(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


MIXED_WORDS_SQL = f"""
WITH measured AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('{SEED}/' || coalesce(doc_id::VARCHAR, '') || '/' || coalesce(text, '')
             || CASE WHEN copy > 0 THEN '/' || copy::VARCHAR ELSE '' END), 1, {_DRAW_DIGITS}))::BIGINT::DOUBLE
           / {float(16**_DRAW_DIGITS)!r}::DOUBLE AS draw
  FROM (SELECT *, row_number() OVER (PARTITION BY source, doc_id, text) - 1 AS copy FROM documents)),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight
  FROM measured GROUP BY source),
levels AS (  -- the common level at which all targets together are 150% of all sizes
  SELECT c.source_size * 2.0 / c.weight AS at_cap,
         (3 * (SELECT sum(source_size) FROM sums)::BIGINT - 2 * coalesce(sum(l.source_size * 2), 0)::BIGINT) AS rest,
         2 * ((SELECT sum(weight) FROM sums)::BIGINT - coalesce(sum(l.weight), 0)::BIGINT) AS shares
  FROM sums c LEFT JOIN sums l ON l.source_size * 2.0 / l.weight < c.source_size * 2.0 / c.weight
  GROUP BY c.source_size * 2.0 / c.weight, c.source),
level AS (SELECT rest, shares FROM levels WHERE at_cap > rest::DOUBLE / shares ORDER BY at_cap LIMIT 1),
targets AS (
  SELECT s.source, source_size,
         CASE WHEN level.rest IS NULL OR source_size * 2.0 / weight <= level.rest::DOUBLE / level.shares THEN (source_size * 2)::DOUBLE
              ELSE (weight * level.rest)::DOUBLE / level.shares END AS target
  FROM sums s LEFT JOIN level ON true),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM targets)
SELECT doc_id, size, source_size, target,
       size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken,
       m.source, (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM measured m JOIN rates r ON m.source IS NOT DISTINCT FROM r.source
"""
