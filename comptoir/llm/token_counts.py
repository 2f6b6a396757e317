"""Token counts of the sections of a document, from one encoding of the whole text.

A text is encoded once. Tokens of a byte-level vocabulary spell the text's
bytes, so their lengths, summed up, are their byte spans, and the leading bytes
of characters turn those into character spans. The spans are then interval-
joined with the text's sections by binary search. A token that crosses a
boundary goes, by ``rule``, to

* ``majority``: the section that holds most of its characters, the earliest of equals;
* ``first``: the section that holds its first character.

A character spelled by several tokens belongs to the span of each.

Sections are lines, each with its line break, so they cover the text. The
counts of a text's sections add up to its tokens. A null or empty text has one
empty section without tokens. Rows are counted one by one; repeated rows repeat,
and an empty table gives no rows.
"""

from __future__ import annotations

import base64
import os
from functools import cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Ranks of a byte-level vocabulary, one base64 token and its id per line: a path on the driver.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The Spark setting that names another one.
SETTING = "comptoir.vocabulary"
#: Fixed value: the pattern that cuts a text before this vocabulary encodes it.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("majority", "first")


class Vocabulary:
    def __init__(self, file: str, pattern: str = PATTERN):
        with open(file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding("shipped", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character, and the one after the last, of each token. Lone surrogates count as U+FFFD."""
        raw = text.encode("utf-8", "replace") if text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace").encode()
        ids = np.array(self._encoding.encode_ordinary(raw.decode()), np.int64)
        ends = np.cumsum(self._bytes[ids])
        character = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # of each byte, from 1
        if not len(ids):
            return ids, ids
        return character[ends - self._bytes[ids]] - 1, character[ends - 1]


@cache
def _shipped(name: str) -> Vocabulary:
    return Vocabulary(SparkFiles.get(name))


def lines(text: str) -> np.ndarray:
    """First character of each line; a break at the end starts no line."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.append(0, np.flatnonzero(codes == ord("\n")) + 1)
    return starts if len(starts) == 1 or starts[-1] < len(codes) else starts[:-1]


def allocated(first: np.ndarray, after: np.ndarray, starts: np.ndarray, length: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that each section gets, and how many of its tokens cross a boundary.

    Sections are intervals ``starts[i]`` to ``starts[i + 1]`` (at last ``length``).
    """
    ends = np.append(starts[1:], length)
    section = np.searchsorted(starts, first, "right") - 1
    crossing = after > ends[section]
    if rule == "majority":
        for token in np.flatnonzero(crossing):
            last = np.searchsorted(starts, after[token] - 1, "right")
            here = np.arange(section[token], last)
            held = np.minimum(ends[here], after[token]) - np.maximum(starts[here], first[token])
            section[token] = here[held.argmax()]
    return (np.bincount(section, minlength=len(starts)), np.bincount(section[crossing], minlength=len(starts)))


def section_tokens(text: Column, spark: SparkSession, vocabulary: str | None = None, rule: str = "majority") -> Column:
    """Array of (start, end, n_tokens, n_crossing), one element per section, in order."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    vocabulary = vocabulary or spark.conf.get(SETTING, VOCABULARY)
    spark.sparkContext.addFile(vocabulary)  # to every executor, once
    name = os.path.basename(vocabulary)

    @F.pandas_udf("start array<int>, `end` array<int>, n_tokens array<long>, n_crossing array<long>")
    def counted(texts: pd.Series) -> pd.DataFrame:
        known, rows = _shipped(name), []
        for text in texts:
            text = text if isinstance(text, str) else ""
            starts = lines(text)
            rows.append((starts, np.append(starts[1:], len(text)), *allocated(*known.spans(text), starts, len(text), rule)))
        return pd.DataFrame(rows, columns=["start", "end", "n_tokens", "n_crossing"])

    found = counted(text)
    return F.arrays_zip(*(found[c].alias(c) for c in ("start", "end", "n_tokens", "n_crossing")))


def document_sections(docs: DataFrame, vocabulary: str | None = None, rule: str = "majority") -> DataFrame:
    """doc_id, section (from 0), start, end, n_tokens, n_crossing: one row per section of every text."""
    sections = section_tokens(F.col("text"), docs.sparkSession, vocabulary, rule)
    rows = docs.select("doc_id", sections.alias("found")).select("doc_id", F.posexplode("found").alias("section", "found"))
    return rows.select("doc_id", "section", "found.*")
