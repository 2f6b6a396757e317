"""Sets of hashed word shingles: batches of texts in, one flat array of 64-bit numbers out."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

WORDS = 5
#: Distinct words whose hashes a worker remembers.
REMEMBERED = 1 << 18
#: Odd multipliers that tie a word to its place in the shingle.
_PLACES = np.array([pow(0x9E3779B97F4A7C15, 2 * i + 1, 2**64) | 1 for i in range(WORDS)], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_hashes = _Hashes()


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers under which all bits depend on all bits."""
    x = values + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, bounds): the set of text i is ``tokens[bounds[i]:bounds[i + 1]]``, in order.

    A set holds the distinct shingles of five words; a text of fewer words has
    its whole sequence as one; a null text and one without words have none.
    Words are separated by ASCII white space, A-Z count as a-z. A shingle is
    a 64-bit hash of its words, so sets are equal up to hash collisions.
    """
    hashes = _hashes.__getitem__
    parts, counts = [], []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
        counts.append(len(words))
        parts.append(np.fromiter(map(hashes, words), np.uint64, len(words)))
    n = np.array(counts, np.int64)
    hashed = np.concatenate([*parts, np.zeros(WORDS - 1, np.uint64)])
    starts = np.cumsum(n) - n
    last = len(hashed) - WORDS + 1
    summed = hashed[:last] * _PLACES[0]
    for i in range(1, WORDS):
        summed += hashed[i:i + last] * _PLACES[i]
    shingles = np.where(n >= WORDS, n - WORDS + 1, 0)
    owner = np.repeat(np.arange(len(n)), shingles)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    values = mixed(summed[starts[owner] + within])
    short = np.flatnonzero((n > 0) & (n < WORDS))
    whole = [sum(int(hashed[starts[i] + k]) * int(_PLACES[k]) for k in range(n[i])) + int(n[i]) for i in short]
    owner = np.concatenate([owner, short])
    values = np.concatenate([values, mixed(np.array([w % 2**64 for w in whole], np.uint64), 1)])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    owner, values = owner[new], values[new]
    return values, np.searchsorted(owner, np.arange(len(n) + 1))
