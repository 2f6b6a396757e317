"""Line deduplication over levelled sorted runs of line hashes.

A line's *key* is the line without ASCII white space at both ends, A-Z as a-z;
its hash is the MD5 of the key. Keys of at least ``least_chars`` code points
that occur in at least ``least_docs`` documents lose all their lines except
those of the largest doc_id that holds one.

*Runs.* A run is a Parquet table of (line, n, keeper): hash, documents, largest
doc_id; one row per hash, in hash buckets sorted by hash, so that two runs are
merged, and a batch meets a run, by a merge join without shuffling the run.
Every batch of documents adds its own run at level 0. Two runs of one level are
compacted into one of the next, so there are never more runs than the logarithm
of the batches.

*Batches.* ``LineRuns.unseen`` merge-anti-joins a new batch with the runs (the
lines no earlier batch had), ``add`` gives it a run of its own. ``new_lines``
does both for a stream of batches, where the first holder of a line keeps it.
The rule above needs all counts first, so ``kept_lines`` sweeps twice: all
batches add their runs, then the batches merge-anti-join the runs' common lines.
What the anti-join leaves out is what is dropped; only that is gathered, as line
numbers per text, and joined back to the texts.

*Hot lines.* Lines are counted before they are shuffled. A line with more than
1/10,000 of all lines is looked up in a broadcast table instead of a shuffle:
there are fewer than 10,000 of those, whatever the input.

DataFrame functions only. Nulls: a null or empty text is one empty line, which
stays. A null doc_id is an id of its own, under all others; rows that share an
id, or have none, are one document, and lose or keep a line together. Equal
rows have equal results. A text whose lines all go becomes empty. Empty tables
give no rows. Other columns pass through ``deduplicated`` unchanged.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from comptoir.llm.common import column, fresh
from comptoir.sources.stores import shared_folder, written

LEAST_CHARS = 40
LEAST_DOCS = 5
BATCHES = 3
#: A line with more than this share of all lines is hot; there are at most as many as its inverse.
HOT = 1 / 10_000
WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def hashed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, copy, pos, line: every line whose key is long enough. ``copy`` tells the texts of an id apart."""
    rows = docs.select("doc_id", F.xxhash64(_text()).alias("copy"), F.posexplode(_lines(_text())).alias("pos", "raw"))
    keyed = rows.where(F.length("raw") >= least_chars).withColumn("key", line_key(F.col("raw")))
    found = keyed.where(F.length("key") >= least_chars)
    return found.select("doc_id", "copy", "pos", F.unhex(F.md5("key")).alias("line"))


def line_counts(lines: DataFrame) -> DataFrame:
    """line, n (documents that hold it), keeper (the largest of them): the content of a run."""
    held = lines.select("line", "doc_id").distinct()
    return held.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))


class LineRuns:
    """Runs by level; level k holds at most one run, of about ``2**k`` batches."""

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._folder = shared_folder(spark, "line-runs")
        self._levels: list[str | None] = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for name in self._levels if name]

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The rows of ``lines`` whose line is in no run."""
        return reduce(lambda rest, run: rest.join(run, "line", "left_anti"), self.runs(), lines)

    def add(self, counts: DataFrame) -> None:
        """A run of ``counts`` at level 0, then compaction as far as levels are taken."""
        carried, level = self._write(counts), 0
        while level < len(self._levels) and self._levels[level]:
            older, self._levels[level] = self._levels[level], None
            merged = self._write(self.merge(self.spark.table(older), self.spark.table(carried)))
            self._forget(older, carried)
            carried, level = merged, level + 1
        self._levels += [None] * (level + 1 - len(self._levels))
        self._levels[level] = carried

    @staticmethod
    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        """Two runs as one, by a merge join of their buckets."""
        other = b.select("line", F.col("n").alias("n_b"), F.col("keeper").alias("keeper_b"))
        both = a.join(other, "line", "full")
        n = F.coalesce("n", F.lit(0)) + F.coalesce("n_b", F.lit(0))
        return both.select("line", n.alias("n"), F.greatest("keeper", "keeper_b").alias("keeper"))

    def merged(self) -> DataFrame:
        """All runs as one: a row per line."""
        return reduce(self.merge, self.runs())

    def close(self) -> None:
        """Takes the runs out of the session's catalog."""
        self._forget(*filter(None, self._levels))
        self._levels = []

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = counts.write.format("parquet").bucketBy(self.buckets, "line").sortBy("line")
        writer.option("path", f"{self._folder}/{name}").saveAsTable(name)
        return name

    def _forget(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def new_lines(batches: Iterable[DataFrame], runs: LineRuns, least_chars: int = LEAST_CHARS) -> Iterator[DataFrame]:
    """For a stream of batches of documents, the hashed lines of each that no earlier batch had."""
    for docs in batches:
        lines = written(hashed_lines(docs, least_chars), "line-batch")
        unseen = written(runs.unseen(lines), "line-unseen")  # before the runs change
        runs.add(line_counts(lines))
        yield unseen


def common_lines(lines: DataFrame, batches: int, least_docs: int) -> DataFrame:
    """line, n, keeper of the lines in at least ``least_docs`` documents. ``lines`` has a column ``batch``."""
    runs = LineRuns(lines.sparkSession)
    try:
        for batch in range(batches):
            runs.add(line_counts(lines.where(F.col("batch") == batch)))
        return written(runs.merged().where(F.col("n") >= least_docs), "lines-common")
    finally:
        runs.close()


def dropped_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES, hot: float = HOT,
) -> DataFrame:
    """doc_id, copy, dropped (line numbers from 0): one row per text that loses lines."""
    # By id, so that the rows of one document are in one batch and counted once.
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    # In order of batch within a file, so that reading a batch skips the other pages.
    lines = written(hashed_lines(docs, least_chars).withColumn("batch", batch).sortWithinPartitions("batch"), "lines")
    common = common_lines(lines, batches, least_docs)
    total = lines.count()
    is_hot = F.col("n") > total * hot
    frequent = F.broadcast(common.where(is_hot).select("line", F.col("keeper").alias("hot_keeper"), F.lit(True).alias("is_hot")))
    marked = lines.drop("batch").join(frequent, "line", "left")
    elsewhere = lambda keeper: ~F.col("doc_id").eqNullSafe(F.col(keeper))
    rest = marked.where("is_hot IS NULL").join(common.where(~is_hot).select("line", "keeper"), "line")
    lost = marked.where("is_hot").where(elsewhere("hot_keeper")).select("doc_id", "copy", "pos").unionAll(
        rest.where(elsewhere("keeper")).select("doc_id", "copy", "pos"))
    return lost.groupBy("doc_id", "copy").agg(F.collect_set("pos").alias("dropped"))


def _with_dropped(docs: DataFrame, dropped: str, **rule) -> DataFrame:
    lost = written(dropped_lines(docs, **rule), "lines-dropped")
    of, copy = fresh(docs, "_of", "_copy")
    lost = lost.select(F.col("doc_id").alias(of), F.col("copy").alias(copy), F.col("dropped").alias(dropped))
    same = F.col("doc_id").eqNullSafe(column(of)) & (F.xxhash64(_text()) == column(copy))
    return docs.join(lost, same, "left").drop(of, copy)


def _kept(dropped: Column) -> Column:
    """The text without the lines of these numbers; all in time proportional to the lines."""
    def without(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        return F.array_join(F.transform(places, lambda i: lines[i]), "\n")

    # Bound to a lambda variable, the lines are split once per text.
    return F.when(dropped.isNull(), _text()).otherwise(F.transform(F.array(_lines(_text())), without)[0])


def deduplicated(docs: DataFrame, **rule) -> DataFrame:
    """The documents without the lines that go; columns as in ``docs``, null texts stay null."""
    (dropped,) = fresh(docs, "_dropped")
    marked = _with_dropped(docs, dropped, **rule)
    text = F.when(F.col("text").isNotNull(), _kept(column(dropped)))
    return marked.select(*(text.alias(c) if c == "text" else column(c) for c in docs.columns))


def line_report(docs: DataFrame, **rule) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    marked = _with_dropped(docs.select("doc_id", "text"), "dropped", **rule)
    n_lines = F.length(F.regexp_replace(_text(), "[^\n]+", "")) + 1
    n_dropped = F.coalesce(F.size("dropped"), F.lit(0))
    return marked.select(
        "doc_id", n_lines.cast("long").alias("n_lines"), F.greatest(n_dropped, F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(_kept(F.col("dropped")).cast("binary"), 256).alias("kept_sha256"))


LINE_REPORT_SQL = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM texts),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE length(key) >= 40)
  GROUP BY key HAVING count(*) >= 5),
marked AS (
  SELECT r, k.doc_id, line, pos, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.keeper AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""
