"""Spelling variants: near words of a vocabulary by a bit-sliced position index.

*Vocabulary.* Runs of letters of all texts, A-Z as a-z, counted; words of at
least ``least_length`` code points and ``least_count`` occurrences. A run whose
hash with its document's id asks for it loses one letter first, so that the
table holds known slips.

*Groups.* Words of lengths L and L + 1 that differ by one insertion, deletion or
replacement share their first L // 2 code points or their last L - L // 2. Each
word therefore enters four groups: by prefix and by suffix, as one of the
shorter words (base L) and as one of the longer (base L - 1). A pair counts in
its prefix group, and in its suffix group only if the prefixes differ, so never
twice. Groups of more than ``block`` words are dealt into blocks of words; every
word of the group then queries each block.

*Index.* Over the words of a block there is one bitset per (position, letter).
For a query, recurrences over its letters keep, for all words of the block at
once: the words equal so far (zero errors), and the words with one replacement
(positions as they are), one letter more (positions shifted by one ahead) or one
letter less (shifted back). Python's whole numbers are the bitsets, so each step
is a few word-parallel operations. Bitsets of words by length end the search.

A task holds one block's words at a time; queries pass by in sorted order. Only
counts and the best near word leave a task, never pairs.

Nulls: a null text has no words; a null doc_id is an empty text in the hash.
Repeated rows count again. Ties of the best near word go to the smallest by code
point. Words are whole whatever their length. An empty table gives no words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from comptoir.sources.stores import written

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A near word is the form of a word if it occurs at least this often as often.
FORM_RATIO = 5
#: One run in this many loses a letter.
SLIPS = 199
#: Words per block of the index.
BLOCK = 1 << 16
LETTERS = "A-Za-z\\u00C0-\\u00FF"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: counted before and after the shuffle, so frequent words are no load."""
    # Shorter runs give no word that is long enough. A match starts where its run does, so it is the whole run.
    found = F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{least_length},}})"), F.lit(1))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    lower = runs.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    chance = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod("h", F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = lower.withColumn("h", chance).select(F.when(F.col("h") % SLIPS == 0, slipped).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


class PositionIndex:
    """Bitsets over ``words``: bit j stands for the j-th word."""

    def __init__(self, words: list[str]):
        at, lengths = defaultdict(list), defaultdict(list)
        for j, word in enumerate(words):
            lengths[len(word)].append(j)
            for place in enumerate(word):
                at[place].append(j)
        self.words, self._every = words, (1 << len(words)) - 1
        self._at = {place: self._bits(js) for place, js in at.items()}
        self._of_length = {length: self._bits(js) for length, js in lengths.items()}

    def _bits(self, js: list[int]) -> int:
        raw = bytearray(len(self.words) // 8 + 1)
        for j in js:
            raw[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(raw, "little")

    def near(self, word: str, prefix: int) -> tuple[int, int]:
        """(near words, words that share the first ``prefix`` code points), as bitsets.

        The word has that many code points. The second counts only if the first has any. Near words differ by one replacement, one letter more or one less.
        """
        at, none = self._at.get, 0
        equal, replaced, more, less = self._every, none, self._every, none
        shared = equal
        for i, letter in enumerate(word):
            here = at((i, letter), none)
            replaced = replaced & here | equal
            less = less & at((i - 1, letter), none) | equal
            equal &= here
            more = more & at((i + 1, letter), none) | equal
            if i < prefix:
                shared = equal
            if not (replaced or less or more):
                return none, none
        of, m = self._of_length.get, len(word)
        found = replaced & ~equal & of(m, none) | more & of(m + 1, none) | less & of(m - 1, none)
        return found, shared

    def members(self, bits: int) -> Iterator[int]:
        while bits:
            lowest = bits & -bits
            yield lowest.bit_length() - 1
            bits ^= lowest


def _best_near(rows: Iterable[tuple], prefixed: bool, base: int) -> Iterator[tuple]:
    """(word, n_near, best) for the words of one block. rows: (member, word, n), members first."""
    rows = iter(rows)
    members, others = [], ()
    for row in rows:
        if not row[0]:
            others = (row,)
            break
        members.append(row)
    if not members or len(members) == 1 and not others:
        return
    index = PositionIndex([word for _, word, _ in members])
    counts = [n for _, _, n in members]
    shorter = index._of_length.get(base, 0)
    for part in (members, others, rows):
        for _, word, _ in part:
            found, shared = index.near(word, base // 2)
            # Two words of the longer length are a matter of the next base.
            found &= shared if prefixed else ~shared
            if len(word) > base:
                found &= shorter
            if found:
                best = min((-counts[j], index.words[j]) for j in index.members(found))
                yield word, found.bit_count(), -best[0], best[1]


_NEAR = "word string, n_near long, form_n long, form string"


def _near_in_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by group, block and (members first) member."""
    def rows():
        for batch in batches:
            yield from zip(batch.base, batch.prefixed, batch.part, batch.block, batch.member, batch.word, batch.n)

    found: list = []
    for (base, prefixed, *_), block in groupby(rows(), key=lambda row: row[:4]):
        for row in _best_near((row[4:] for row in block), prefixed, base):
            found.append(row)
            if len(found) >= 10_000:
                yield pd.DataFrame(found, columns=["word", "n_near", "form_n", "form"])
                found = []
    yield pd.DataFrame(found, columns=["word", "n_near", "form_n", "form"])


def _groups(words: DataFrame) -> DataFrame:
    """base, prefixed, part (hash of the shared half), word, n: four rows per word."""
    length = F.length("word")

    def group(base: Column, prefixed: bool) -> Column:
        half = F.floor(base / 2).cast("int")
        part = F.substring("word", F.lit(1), half) if prefixed else F.substring("word", length - (base - half) + 1, base - half)
        return F.struct(base.alias("base"), F.lit(prefixed).alias("prefixed"), F.xxhash64(part).alias("part"))

    all_four = F.array(*(group(base, prefixed) for base in (length, length - 1) for prefixed in (True, False)))
    return words.select("word", "n", F.explode(all_four).alias("g")).select("g.*", "word", "n")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, form, form_n: number of near words and the most frequent one; words without near ones are left out."""
    keys, groups = ["base", "prefixed", "part"], _groups(words)
    sizes = groups.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    # At most rows / block groups are larger than a block.
    large = F.broadcast(sizes.where(F.col("size") > block).select(*keys, F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("word"), blocks).cast("int")
    dealt = groups.join(large, keys, "left").select(
        *keys, "word", "n", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    dealt = dealt.withColumn("member", F.col("own") == F.col("block")).drop("own")
    placed = dealt.repartition(*keys, "block").sortWithinPartitions(*keys, "block", F.desc("member"))
    found = placed.select(*keys, "block", "member", "word", "n").mapInPandas(_near_in_groups, _NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), "form")).alias("best")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """word, root of stored (word, form): the end of the chain of forms.

    Chains rise in frequency, so they end. Each round doubles the steps that a
    row has gone.
    """
    last = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = last.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        stepped = last.join(ahead, F.col("root") == F.col("_at"), "left")
        stepped = written(stepped.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        last = stepped.drop("moved")
        if not stepped.where("moved").limit(1).count():
            return last


def variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO, block: int = BLOCK,
) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word of the vocabulary."""
    words = written(vocabulary(docs, least_length, least_count), "vocabulary")
    near = near_words(words, block)
    is_form = F.col("form_n") >= F.col("n") * ratio
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    found = written(joined, "spelling-forms")
    ends = roots(written(found.where("form IS NOT NULL").select("word", "form"), "spelling-links"))
    rooted = found.join(ends, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
