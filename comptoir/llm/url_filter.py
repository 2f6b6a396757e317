"""URL filter over a sorted array of 64-bit digests, in ranges.

A list is a table of (host, path, allow or block). Its entries are dealt by the
leading bits of the xxhash64 of host and path into ranges of a bounded size; a
task sorts each range by digest and packs it into arrays: digests, text offsets,
texts, verdicts. The ranges are a stored table, so a list may be as large as the
pages; no list passes through the driver.

Of the urls, the distinct host suffixes with path prefixes of the stored lengths
are asked. Those that marks of the list rule out go first; the others are routed
to their range, in blocks. A task lays the arrays of one range in an unnamed
scratch file and maps it to memory, finds all asked digests in one vectorised
binary search, and a hit counts only if the stored text is equal.

A host is what stands between the first ``://`` and ``/``, ``?``, ``#`` or the
end, with A-Z in lower case; a path follows up to ``?``, ``#`` or the end. An
entry fits its host and all subdomains where the path starts with its own. The
longest text wins; at equal length the longer host. Of equal entries with
different verdicts ``block`` is kept.

Nulls: a url that is null or has no ``://`` has an empty host and path, fits no
entry and is allowed. Entries without a host fit nothing. Repeated entries count
once, repeated rows are judged alike. Empty pages give no rows, and an empty
list fits nothing. Other columns are not read.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from comptoir.operators.lookups import lookup_join
from comptoir.operators.marks import key_marks, may_hold
from comptoir.sources.stores import written

ALLOW, BLOCK = "allow", "block"
RULES = (
    ("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW),
    ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK),
)
#: By category, what a part of a host label between dashes may be, whole.
WORDS = {
    "adult": ("adult", "adults", "sex", "xxx", "porn", "porno"),
    "gambling": ("bet", "bets", "betting", "casino", "casinos", "gambling", "poker"),
    "drugs": ("pill", "pills", "viagra"),
    "advertising": ("ads", "adserver"),
    "spam": ("spam",),
}
#: Words that mark a label part wherever they stand in it, as no innocent word holds them ("porn" is
#: in Pornic and Pornichet only). The others are in padspace, essex, alphabet, adulthood or spills.
GLUED = ("[^.-]*casino[^.-]*", "[^.-]*poker[^.-]*", "[^.-]*porn([^.i-][^.-]*)?", "[^.-]*viagra[^.-]*")
#: As alternatives of a regular expression that Java and RE2 read alike.
BLOCKED_WORDS = (*sorted(word for words in WORDS.values() for word in words), *GLUED)
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Entries of a range, about; keys that a task looks up at a time.
RANGE_ROWS, ASKED_ROWS = 1 << 16, 1 << 20
_ARRAYS = {"digests": "<u8", "offsets": "<i8", "blocked": "u1", "texts": "u1"}
_PACKED = "`range` int, " + ", ".join(f"{name} binary" for name in _ARRAYS)


class DigestArrays:
    """One range of a list: entries in order of digest, the arrays mapped from a file that has no name."""

    def __init__(self, packed: dict[str, bytes]):
        with tempfile.TemporaryFile() as file:  # the task's own; gone with it
            for name in _ARRAYS:
                file.write(packed[name])
            file.flush()
            at = 0
            for name, kind in _ARRAYS.items():
                count = len(packed[name]) // np.dtype(kind).itemsize
                setattr(self, name, np.memmap(file, kind, "r", at, (count,)) if count else np.zeros(0, kind))
                at += len(packed[name])

    @staticmethod
    def packed(digests: np.ndarray, texts: list[bytes], blocked: np.ndarray) -> dict[str, bytes]:
        order = np.argsort(digests, kind="stable")
        texts = [texts[i] for i in order]
        return {
            "digests": digests[order].astype("<u8").tobytes(), "texts": b"".join(texts),
            "offsets": np.cumsum([0, *map(len, texts)]).astype("<i8").tobytes(), "blocked": blocked[order].astype("u1").tobytes()}

    def find(self, digests: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Place of each text in the range, -1 where it is not stored."""
        found = np.full(len(texts), -1)
        first = np.searchsorted(self.digests, digests, "left")
        after = np.searchsorted(self.digests, digests, "right")
        for i in np.flatnonzero(first < after):  # digests may collide, texts decide
            for place in range(first[i], after[i]):
                if self.texts[self.offsets[place]:self.offsets[place + 1]].tobytes() == texts[i]:
                    found[i] = place
                    break
        return found


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    digests = rows["digest"].to_numpy().astype(np.int64).view(np.uint64)
    packed = DigestArrays.packed(digests, rows["text"].tolist(), rows["blocked"].to_numpy())
    return pd.DataFrame({"range": rows["range"].iloc[:1].to_numpy(), **{name: [packed[name]] for name in _ARRAYS}})


def _look_up(key: tuple, packed: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    if not len(packed) or not len(asked):
        return pd.DataFrame({"key": [], "verdict": []}, dtype=object)
    known = DigestArrays(packed.iloc[0].to_dict())
    texts = asked["text"].tolist()
    found = known.find(asked["digest"].to_numpy().astype(np.int64).view(np.uint64), texts)
    hits = np.flatnonzero(found >= 0)
    return pd.DataFrame({
        "key": [texts[i].decode("utf-8", "surrogatepass") for i in hits],
        "verdict": [BLOCK if blocked else ALLOW for blocked in known.blocked[found[hits]]]}, dtype=object)


def _key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


class UrlList:
    """A stored list. ``entries`` has host, path and verdict; host in lower case."""

    def __init__(self, entries: DataFrame, range_rows: int = RANGE_ROWS):
        known = entries.where("host <> ''").select(
            F.col("host"), F.coalesce("path", F.lit("")).alias("path"), (F.col("verdict") == BLOCK).alias("blocked"))
        merged = known.groupBy("host", "path").agg(F.max("blocked").alias("blocked"))
        stored = written(merged.withColumn("digest", F.xxhash64(_key(F.col("host"), F.col("path")))), "url-list")
        self._bits = max(0, -(-stored.count() // range_rows) - 1).bit_length()
        sizes = stored.agg(
            F.coalesce(F.max(F.length("host")), F.lit(0)).alias("host"), F.coalesce(F.max(F.length("path")), F.lit(0)).alias("path"),
            F.collect_set(F.length("path")).alias("paths")).first()
        #: Path lengths that occur; as many different ones as there are.
        self.longest_host, self.longest_path, self.path_lengths = sizes.host, sizes.path, sorted(sizes.paths)
        rows = stored.select(
            self._range().alias("range"), "digest", _key(F.col("host"), F.col("path")).cast("binary").alias("text"), "blocked")
        self.ranges = written(rows.groupBy("range").applyInPandas(_pack, _PACKED), "url-ranges")
        self._marks = key_marks(stored.select(_key(F.col("host"), F.col("path")).alias("key")))

    def _range(self) -> Column:
        return F.shiftrightunsigned("digest", 64 - self._bits).cast("int") if self._bits else F.lit(0)

    def _keys(self, host: Column, path: Column) -> Column:
        """Array of (key, size, host_size): what entries that fit may be called."""
        labels = F.split(F.substring(host, F.lit(-self.longest_host - 1), F.lit(self.longest_host + 1)), r"\.")
        lengths = F.filter(F.array(*(F.lit(n) for n in self.path_lengths)).cast("array<int>"), lambda n: n <= F.length(path))

        def fitting(labels: Column) -> Column:
            suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
            return F.flatten(F.transform(suffixes, lambda host: F.transform(lengths, lambda n: F.struct(
                _key(host, F.substring(path, F.lit(1), n)).alias("key"), (F.length(host) + n).alias("size"), F.length(host).alias("host_size")))))

        return F.transform(F.array(labels), fitting)[0]

    def _found(self, keys: DataFrame) -> DataFrame:
        """key, verdict of those of the keys that the list has."""
        near = keys.where(may_hold(self._marks, F.col("key"))).distinct().withColumn("digest", F.xxhash64("key"))
        near = written(near.select(F.col("key").cast("binary").alias("text"), "digest", self._range().alias("range")), "url-asked")
        blocks = max(1, -(-near.count() // (ASKED_ROWS << self._bits)))
        asked = near.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)).cast("int"))
        held = self.ranges.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return held.groupBy("range", "block").cogroup(asked.groupBy("range", "block")).applyInPandas(_look_up, "key string, verdict string")

    def judged(self, urls: DataFrame) -> DataFrame:
        """``urls`` (with host and path) and a column ``found``: struct (rule, verdict) of the entry that wins, or null."""
        if not self.path_lengths:
            return urls.withColumn("found", F.lit(None).cast("struct<rule:string,verdict:string>"))
        lead = F.substring("path", F.lit(1), F.lit(self.longest_path))
        placed = urls.withColumn("_at", _key(F.col("host"), lead))
        distinct = written(urls.where("host <> ''").select("host", lead.alias("lead")).distinct(), "url-hosts")
        keys = distinct.select("host", "lead", F.explode(self._keys(F.col("host"), F.col("lead"))).alias("k")).select("host", "lead", "k.*")
        found = written(self._found(keys.select("key")), "url-found")
        hits = lookup_join(keys, found, "key", "inner")
        order = F.struct("size", "host_size", F.replace("key", F.lit("\n"), F.lit("")).alias("rule"), "verdict")
        best = hits.groupBy("host", "lead").agg(F.max(order).alias("best"))
        judged = written(best.select(_key(F.col("host"), F.col("lead")).alias("_at"), F.struct("best.rule", "best.verdict").alias("found")), "url-judged")
        return lookup_join(placed, judged, "_at").drop("_at")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"\A[^?#]*", 0)
    return F.translate(host, _CAPITALS, _SMALL), path


def blocked_hosts(pages: DataFrame, words: tuple[str, ...] = BLOCKED_WORDS) -> DataFrame:
    """host, path, verdict: a sample list, of the hosts among the pages with a label part that is one of the words."""
    host, _ = host_and_path(F.col("url"))
    marked = pages.select(host.alias("host")).where(F.col("host").rlike(rf"(\A|[.-])({'|'.join(words)})([.-]|\Z)")).distinct()
    return without_subdomains(marked).select("host", F.lit("").alias("path"), F.lit(BLOCK).alias("verdict"))


def without_subdomains(hosts: DataFrame) -> DataFrame:
    """The distinct hosts that lie under no other one of them. Suffixes are compared by hash."""
    stored = written(hosts.select("host").distinct(), "url-parents")
    above = F.transform(F.sequence(F.lit(2), F.size("labels")), lambda k: F.xxhash64(F.array_join(F.slice("labels", k, F.size("labels")), ".")))
    labelled = stored.withColumn("labels", F.split("host", r"\.")).where(F.size("labels") > 1)
    parents = labelled.select("host", F.explode(above).alias("hash"))
    under = parents.join(stored.select(F.xxhash64("host").alias("hash")).distinct(), "hash", "left_semi").select("host").distinct()
    return stored.join(under, "host", "left_anti")


def judged_pages(pages: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The rules come first; a url that no rule fits is looked up in ``listed``
    (host, path, verdict; any size). Without one a sample list is made from the
    pages' own hosts by ``WORDS``.
    """
    host, path = host_and_path(F.col("url"))
    parsed = written(pages.select("page_id", host.alias("host"), path.alias("path")), "urls")
    rules = UrlList(pages.sparkSession.createDataFrame(list(RULES), "host string, path string, verdict string"))
    ruled = rules.judged(parsed).select("page_id", "host", "path", "found.rule", "found.verdict")
    ruled = written(ruled, "urls-ruled")
    known = UrlList(blocked_hosts(pages) if listed is None else listed)
    judged = known.judged(ruled.where("verdict IS NULL").select("page_id", "host", "path"))
    by_list = judged.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.coalesce("found.verdict", F.lit(ALLOW)).alias("verdict"))
    return ruled.where("verdict IS NOT NULL").unionAll(by_list)


_FITS = "(u.host = e.host OR ends_with(u.host, '.' || e.host)) AND u.host <> '' AND starts_with(u.path, e.path)"
JUDGED_PAGES_SQL = f"""
WITH rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '\\A[^/?#]*') AS raw FROM rests),
u AS (
  SELECT row_number() OVER () AS row, page_id, translate(raw, '{_CAPITALS}', '{_SMALL}') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '\\A[^?#]*') AS path FROM hosts),
rules(host, path, action) AS (VALUES {', '.join(map(str, RULES))}),
listed AS (
  SELECT DISTINCT host, '' AS path FROM u
  WHERE regexp_matches(host, '(\\A|[.-])({'|'.join(BLOCKED_WORDS)})([.-]|\\z)')),
ruled AS (
  SELECT row, arg_max(e.host || e.path, length(e.host || e.path)) AS rule, arg_max(e.action, length(e.host || e.path)) AS action
  FROM u JOIN rules e ON {_FITS} GROUP BY row),
blocked AS (SELECT DISTINCT row FROM u JOIN listed e ON {_FITS})
SELECT page_id, host, path, rule,
       CASE WHEN rule IS NOT NULL THEN action WHEN row IN (SELECT row FROM blocked) THEN '{BLOCK}' ELSE '{ALLOW}' END AS verdict
FROM u LEFT JOIN ruled USING (row)
"""
