"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, seeded by its code point. An
n-gram is the product (binding) of its letters' vectors, each rotated
(permuted) by its distance from the n-gram's end. A text is the sum (bundle) of
its n-grams, a language the sum of its texts at unit length, and a text's
language the one whose prototype has the largest cosine with it.

Letters are Unicode letters in lower case; any run of other characters is one
boundary. Training reads all labelled rows: each task bundles its rows and
leaves one vector per language, so only ``languages x DIMENSIONS`` sums reach
the driver.

Nulls: a text that is null or has no letter is ``und`` with score 0, as is
every text if no labelled text has a letter. Rows without language do not
train. Ties go to the language first in order. An empty table gives no rows.
Other columns are not read. The prototypes are broadcast: four kilobytes for each
distinct value of lang.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DIMENSIONS = 1024
N = 3
UNKNOWN = "und"
FOLDS = 5
#: Characters, and texts, that are bundled at a time, so that a batch's matrices stay small.
CHUNK_CHARS, CHUNK_TEXTS = 100_000, 256
#: n-grams whose vectors are in memory at a time.
BLOCK = 4096
_UNIT = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Per code point its lower-case letter, 0 for what is no letter."""
    found = np.zeros(sys.maxunicode + 1, np.int32)
    for code in range(sys.maxunicode + 1):
        character = chr(code)
        if character.isalpha():
            low = character.lower()
            found[code] = ord(low) if len(low) == 1 else code
    return found


@cache
def _letter_vector(code: int) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=code)).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return bits * np.int8(2) - np.int8(1)


def _vectors(grams: np.ndarray) -> np.ndarray:
    """One row per n-gram (letters in a row of ``grams``)."""
    codes, at = np.unique(grams, return_inverse=True)
    alphabet = np.stack([_letter_vector(int(c)) for c in codes])
    at = at.reshape(grams.shape)
    bound = np.ones((len(grams), DIMENSIONS), np.int8)
    for place in range(N):
        bound *= np.roll(alphabet, N - 1 - place, axis=1)[at[:, place]]
    return bound.astype(np.float32)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK_CHARS or i + 1 - first >= CHUNK_TEXTS:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _bundles(texts: list[str | None]) -> np.ndarray:
    """One row per text, of zeros if it has no letter."""
    bundled = np.zeros((len(texts), DIMENSIONS), np.float32)
    codes = [np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32) for text in texts]
    gap = np.zeros(N - 1, np.uint32)
    joined = _letters()[np.concatenate([part for c in codes for part in (gap, c, gap[:1])])]
    owner = np.repeat(np.arange(len(texts)), [len(c) + N for c in codes])
    kept = np.ones(len(joined), bool)  # a run of boundaries counts as one
    kept[1:] = (joined[1:] != 0) | (joined[:-1] != 0) | (owner[1:] != owner[:-1])
    joined, owner = joined[kept].astype(np.int64), owner[kept]
    if len(joined) < N:
        return bundled
    last = len(joined) - N + 1
    grams = sum(joined[i:i + last] << (21 * (N - 1 - i)) for i in range(N))
    # n-grams of one text that hold a letter in the middle
    inside = (owner[:last] == owner[N - 1:]) & (joined[1:last + 1] != 0)
    grams, owner = grams[inside], owner[:last][inside]
    if not len(grams):
        return bundled
    known, at = np.unique(grams, return_inverse=True)
    letters = np.stack([known >> (21 * (N - 1 - i)) & 0x1FFFFF for i in range(N)], axis=1)
    for start in range(0, len(known), BLOCK):
        here = letters[start:start + BLOCK]
        chosen = slice(None) if len(known) <= BLOCK else (at >= start) & (at < start + BLOCK)
        cells = owner[chosen] * len(here) + (at[chosen] - start)
        counts = np.bincount(cells, minlength=len(texts) * len(here)).astype(np.float32)
        bundled += counts.reshape(len(texts), len(here)) @ _vectors(here)
    return bundled


def bundles(texts: list[str | None]) -> np.ndarray:
    """Unit vectors of the texts; a row of zeros for a text without a letter."""
    parts = [_bundles(texts[a:b]) for a, b in _chunks(texts)]
    all_rows = np.concatenate(parts) if parts else np.zeros((0, DIMENSIONS), np.float32)
    length = np.linalg.norm(all_rows, axis=1, keepdims=True)
    return all_rows / np.where(length == 0, 1, length)


def _bundled_languages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        rows = np.rint(bundles(list(batch["text"])) * _UNIT).astype(np.int64)  # whole numbers: any order sums alike
        for lang in batch["lang"].unique():
            total = rows[(batch["lang"] == lang).to_numpy()].sum(axis=0)
            sums[lang] = sums[lang] + total if lang in sums else total
    if sums:
        yield pd.DataFrame({"lang": list(sums), "bundle": [list(v) for v in sums.values()]})


class Profiles:
    """Prototypes of languages: names in order, one unit vector each."""

    def __init__(self, languages: list[str], prototypes: np.ndarray):
        self.languages, self.prototypes = languages, prototypes

    @classmethod
    def fit(cls, labelled: DataFrame) -> Profiles:
        """From all rows of ``labelled`` (text, lang) in which both are present."""
        rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
        summed = rows.mapInPandas(_bundled_languages, "lang string, bundle array<long>")
        flat = summed.select("lang", F.posexplode("bundle").alias("at", "value"))
        sums = flat.groupBy("lang", "at").agg(F.sum("value").alias("value"))
        found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("bundle")).collect()
        vectors = {r["lang"]: np.array([x["value"] for x in r["bundle"]], np.float64) for r in found}
        vectors = {lang: v for lang, v in sorted(vectors.items()) if v.any()}
        stacked = [v / np.linalg.norm(v) for v in vectors.values()]
        return cls(list(vectors), np.array(stacked, np.float32).reshape(len(stacked), DIMENSIONS))

    def identify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        rows = bundles(texts)
        cosines = rows @ self.prototypes.T
        best = cosines.argmax(axis=1) if len(texts) else np.zeros(0, int)
        lettered = rows.any(axis=1)
        names = [self.languages[i] if ok else UNKNOWN for i, ok in zip(best, lettered)]
        scores = np.where(lettered, cosines[np.arange(len(texts)), best], 0)
        return names, np.clip(scores.astype(np.float64), 0, 1)

    def column(self, spark: SparkSession, text: Column) -> Column:
        """Struct (lang, score) of a text column."""
        model = spark.sparkContext.broadcast(self)  # languages x DIMENSIONS floats

        @F.pandas_udf("lang string, score double")
        def identified(texts: pd.Series) -> pd.DataFrame:
            names, scores = model.value.identify([t if isinstance(t, str) else None for t in texts])
            return pd.DataFrame({"lang": names, "score": scores})

        return identified(text)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by FOLDS; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def fitted(docs: DataFrame) -> Profiles:
    return Profiles.fit(docs.where(~held_out(F.col("doc_id"))))


def document_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the other folds, applied to every text."""
    found = fitted(docs).column(docs.sparkSession, F.col("text"))
    known = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("found"))
    return known.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


#: The cosine of vectors that have nothing in common varies by this much around 0, whatever the texts' lengths.
NOISE = DIMENSIONS**-0.5
#: A text whose cosine is no more than the noise may give is in no learned language.
LEAST_COSINE = 3 * NOISE


def in_known_language(docs: DataFrame) -> DataFrame:
    """The documents without those that no learned language resembles: texts without
    a letter, and texts that have next to no n-gram in common with any prototype,
    as those in an unknown script. If no language could be learned all stay."""
    profiles = fitted(docs)
    if not profiles.languages:
        return docs
    found = profiles.column(docs.sparkSession, F.col("text"))
    return docs.where((found["lang"] != UNKNOWN) & (found["score"] >= LEAST_COSINE))
