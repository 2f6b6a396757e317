"""Importance resampling towards a target: hashed n-gram gains, Gumbel top-k.

Features of a text are its runs of one to two consecutive words, joined by one
space, repeats counted; a feature's bucket is a CRC of its bytes. A bucket's
gain is the log ratio of its smoothed shares in the target texts and in all
documents. A document's weight is the mean gain of its features, its score the
weight plus Gumbel noise seeded by its id; the highest scores are drawn, which
is sampling without replacement in proportion to the exponents of the weights.

*Interning.* Texts are taken in pieces of about a megabyte. All n-grams of a
piece are spans of one byte buffer; their xxhash64 keys are computed for all at
once and entered in an open-addressed NumPy table. An n-gram that finds its key
in a slot is compared byte by byte with the n-gram that holds the slot, and goes
on to the next slot if they differ. A slot stores the bucket (one CRC per
distinct n-gram) and the count. For the corpus counts, slots are summed by
bucket; for the weights, each occurrence gathers its gain by its slot id.

Tasks give 10,000 sums at most, whatever they read; the gains, 10,000 numbers,
are the only thing that passes the driver. Drawn documents are ranked by a range
partitioning of those above a bar that a count by score gives.

Nulls: a null or empty text has no feature and weight 0; a null doc_id is an
empty text in the noise and last in ties. Repeated rows are drawn one by one;
equal rows have neighbouring ranks. Long texts are cut into pieces between
words, with the word after the cut read ahead, so no feature is lost. Empty
tables have no counts, so all gains are those of the smoothing.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from comptoir.llm.common import column
from comptoir.sources.stores import written

BUCKETS = 10_000
#: Drawn documents, as a fraction (numerator, denominator) of the eligible ones.
SHARE = (25, 100)
LEAST_WORDS = 20
SEED = "7"
#: Bytes of text that are interned at a time.
PIECE_BYTES = 1 << 20
#: Spans longer than this are hashed and compared one by one.
_LONG = 31

#: A-Z as a-z; all that separates words as a space. Bytes of 0x80 and more are letters.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

#: The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


class Spans:
    """Pieces of one byte buffer."""

    def __init__(self, buffer: bytes, start: np.ndarray, length: np.ndarray):
        self.buffer, self.start, self.length = buffer, start, length
        padded = buffer + bytes(16)
        self._bytes = np.frombuffer(padded, np.uint8)
        # The eight (four) bytes from every position on, as one number.
        self._eight = np.ndarray(len(buffer) + 8, "<u8", padded, strides=(1,))
        self._four = np.ndarray(len(buffer) + 8, "<u4", padded, strides=(1,))

    def of(self, i: int) -> bytes:
        return self.buffer[self.start[i]:self.start[i] + self.length[i]]

    def keys(self) -> np.ndarray:
        """The xxhash64 of every span."""
        h = _P5 + self.length.astype(np.uint64)
        short = self.length <= _LONG
        for lane in range(_LONG // 8):
            rows = np.flatnonzero(short & (self.length >= 8 * (lane + 1)))
            word = _turned(self._eight[self.start[rows] + 8 * lane] * _P2, 31) * _P1
            h[rows] = _turned(h[rows] ^ word, 27) * _P1 + _P4
        at = self.start + (self.length & ~7)
        rows = np.flatnonzero(short & (self.length & 4 > 0))
        h[rows] = _turned(h[rows] ^ (self._four[at[rows]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at += self.length & 4
        for k in range(3):
            rows = np.flatnonzero(short & (self.length & 3 > k))
            h[rows] = _turned(h[rows] ^ (self._bytes[at[rows] + k].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(~short):
            h[i] = xxhash.xxh64_intdigest(self.of(i))
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans a[k] and b[k], of equal length, have the same bytes."""
        equal, length = np.ones(len(a), bool), self.length[a]
        for lane in range(-(-_LONG // 8)):
            rows = np.flatnonzero((length > 8 * lane) & (length <= _LONG) & equal)
            if not len(rows):
                break
            differ = self._eight[self.start[a[rows]] + 8 * lane] ^ self._eight[self.start[b[rows]] + 8 * lane]
            beyond = (8 * np.maximum(8 * lane + 8 - length[rows], 0)).astype(np.uint64)
            equal[rows] = differ << beyond == 0  # the first byte is the lowest, so bytes beyond the end leave
        for k in np.flatnonzero(length > _LONG):
            equal[k] = self.of(a[k]) == self.of(b[k])
        return equal


class NgramTable:
    """Open-addressed: each slot holds the first n-gram that claimed it, its bucket and its count."""

    def __init__(self, spans: Spans, keys: np.ndarray | None = None):
        self.spans, n = spans, len(spans.start)
        keys = spans.keys() if keys is None else keys
        size = 1 << max(4, (2 * n).bit_length())
        self.holder = np.full(size, -1, np.int64)
        #: The slot of each occurrence.
        self.slots = np.zeros(n, np.int64)
        slot, waiting = (keys & np.uint64(size - 1)).astype(np.int64), np.arange(n)
        while len(waiting):
            free = waiting[self.holder[slot[waiting]] < 0]
            self.holder[slot[free]] = free  # of several, one stays
            holds = self.holder[slot[waiting]]
            found = keys[holds] == keys[waiting]
            found &= spans.length[holds] == spans.length[waiting]
            rows = np.flatnonzero(found & (holds != waiting))
            found[rows] = spans.same(waiting[rows], holds[rows])
            self.slots[waiting[found]] = slot[waiting[found]]
            waiting = waiting[~found]
            slot[waiting] = (slot[waiting] + 1) & (size - 1)
        self.used = np.flatnonzero(self.holder >= 0)
        self.bucket = np.zeros(size, np.int64)
        first = spans.start[self.holder[self.used]]
        bounds = zip(first.tolist(), (first + spans.length[self.holder[self.used]]).tolist())
        text, crc = spans.buffer, zlib.crc32
        self.bucket[self.used] = np.array([crc(text[a:b]) for a, b in bounds], np.int64) % BUCKETS
        self.count = np.bincount(self.slots, minlength=size)


class Piece:
    """The n-grams of some texts, interned. ``owner`` is the row of each n-gram's text."""

    def __init__(self, parts: list[tuple[int, bytes, bool]]):
        """parts: (row, words joined by one space, whether the last word is only read ahead)"""
        buffer = b" ".join(words for _, words, _ in parts)
        spaces = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 0x20)
        starts, ends = np.append(0, spaces + 1), np.append(spaces, len(buffer))
        counts = np.array([words.count(b" ") + 1 for _, words, _ in parts])
        part = np.repeat(np.arange(len(parts)), counts)
        single = np.ones(len(part), bool)
        single[np.cumsum(counts)[[ahead for _, _, ahead in parts]] - 1] = False
        pair = part[:-1] == part[1:]
        row = np.array([row for row, _, _ in parts])[part]
        self.words = row[single]
        self.owner = np.append(row[single], row[:-1][pair])
        first = np.append(starts[single], starts[:-1][pair])
        self.table = NgramTable(Spans(buffer, first, np.append(ends[single], ends[1:][pair]) - first))


def pieces(texts: Iterable[str | None], most: int = PIECE_BYTES) -> Iterator[Piece]:
    """All texts, as pieces of about ``most`` bytes."""
    parts, size = [], 0
    for row, text in enumerate(texts):
        words = b" ".join(text.encode("utf-8", "surrogatepass").translate(_WORDS).split()) if isinstance(text, str) else b""
        at = 0
        while at < len(words):
            cut = words.find(b" ", at + most)
            # The word after the cut is read ahead for the n-gram over the cut.
            ahead = -1 if cut < 0 else words.find(b" ", cut + 1)
            parts.append((row, words[at:] if ahead < 0 else words[at:ahead], cut >= 0))
            size += len(parts[-1][1])
            at = len(words) if cut < 0 else cut + 1
            if size >= most:
                yield Piece(parts)
                parts, size = [], 0
    if parts:
        yield Piece(parts)


def _bucket_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for piece in pieces(batch.text):
            table = piece.table
            np.add.at(total, table.bucket[table.used], table.count[table.used])
    held = np.flatnonzero(total)
    yield pd.DataFrame({"bucket": held, "n": total[held]})


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features per bucket in all texts. At most 10,000 rows come to the driver."""
    summed = texts.select("text").mapInPandas(_bucket_sums, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for row in summed.collect():
        counts[row.bucket] = row.n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of each bucket, in thousandths, rounded down."""
    s_all, t_all = int(source.sum()), int(target.sum())
    ratio = lambda s, t: float((t + 1) * (s_all + BUCKETS)) / float((s + 1) * (t_all + BUCKETS))
    return np.array([math.floor(1000 * math.log(ratio(int(s), int(t)))) for s, t in zip(source, target)], np.int64)


def text_weights(text: Column, gain: np.ndarray) -> Column:
    """Struct (n_words, n_features, weight) of a text."""
    @F.pandas_udf("n_words long, n_features long, weight long")
    def weighed(texts: pd.Series) -> pd.DataFrame:
        n_words, n_features, total = (np.zeros(len(texts), np.int64) for _ in range(3))
        for piece in pieces(texts):
            table = piece.table
            gathered = gain[table.bucket][table.slots]
            np.add.at(n_words, piece.words, 1)
            np.add.at(n_features, piece.owner, 1)
            np.add.at(total, piece.owner, gathered)
        return pd.DataFrame({"n_words": n_words, "n_features": n_features, "weight": total // np.maximum(n_features, 1)})

    return weighed(text)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def ranked(df: DataFrame, order: list[Column], name: str, purpose: str) -> DataFrame:
    """``df`` with ``name``, its place from 1 in this order, without one task that holds all rows.

    Rows are range-partitioned and stored; the partitions' counts, summed in
    order, shift the places within them. Rows that are equal in all of
    ``order`` are spread over partitions by a last column.
    """
    spread = df.withColumn("_spread", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(*order, F.asc("_spread")).withColumn("_part", F.spark_partition_id())
    stored = written(ranged, purpose)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    shifts = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_spread"))
    return stored.join(shifts, "_part").withColumn(name, place + F.col("_shift")).drop("_part", "_shift", "_spread")


def resampled(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS, seed: str = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null unless it is drawn."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    weighed = docs.select("doc_id", text_weights(F.col("text"), gain).alias("w")).select("doc_id", "w.*")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    stored = written(scored.withColumn("eligible", F.col("n_words") >= least_words).drop("n_words"), "resampling-scores")
    eligible = stored.where("eligible")
    up, down = share
    k = eligible.count() * up // down
    # Scores are whole numbers within the range of logarithms, a few ten thousand of them at most.
    above = F.sum("n").over(Window.orderBy(F.desc("score")))
    by_score = eligible.groupBy("score").agg(F.count(F.lit(1)).alias("n")).withColumn("above", above)
    bar = by_score.where(F.col("above") >= k).agg(F.max("score").alias("bar"))
    reaches = F.col("eligible") & F.col("score").__ge__(bar.scalar()) & F.lit(k > 0)
    marked = stored.withColumn("reaches", F.coalesce(reaches, F.lit(False)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    columns = ["doc_id", "n_features", "weight", "score"]
    top = ranked(marked.where("reaches").select(*columns), order, "place", "resampling-top")
    drawn = top.select(*columns, F.when(F.col("place") <= k, F.col("place")).cast("long").alias("rank"))
    return drawn.unionAll(marked.where("NOT reaches").select(*columns, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, whole; columns as in ``docs``. Ids must tell documents apart."""
    chosen = resampled(docs, target, **options).where("rank IS NOT NULL").select("doc_id")
    return docs.join(written(chosen, "resampling-drawn"), "doc_id", "left_semi").select(*map(column, docs.columns))
