from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from comptoir.llm import spelling
from llm.cases import frame, odd_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, least_length=6, least_count=5) -> Counter:
    found: Counter = Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return Counter({w: n for w, n in found.items() if len(w) >= least_length and n >= least_count})


def without_one(word):
    return {word[:i] + word[i + 1:] for i in range(len(word))}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    shorter, longer = sorted((a, b), key=len)
    return len(longer) - len(shorter) == 1 and shorter in without_one(longer)


def by_hand(rows, **bounds):
    """Every word against every other word that shares it, or a word with one letter less."""
    n, by_part = counted(rows, **bounds), {}
    for w in n:
        for part in without_one(w) | {w}:
            by_part.setdefault(part, set()).add(w)
    found = {}
    for w in n:
        others = set().union(*(by_part[p] for p in without_one(w) | {w})) - {w}
        near = [v for v in others if is_near(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        found[w] = (best if best and n[best] >= 5 * n[w] else None, len(near))
    rows = []
    for w, (form, n_near) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        rows.append((w, form, root, n[w], n_near, n[form] if form else None))
    return sorted(rows)


def got(frame_, **options):
    return sorted(tuple(r) for r in spelling.variants(frame_, **options).select("word", "form", "root", "n", "n_near", "form_n").collect())


def slips(seed: int, texts: int):
    """Words with all kinds of slips: at both ends, doubled letters, accents, chains of forms."""
    pick = random.Random(seed)
    bases = ["banana", "aaaaaa", "aaaaaaa", "préféré", "ÉCOLES", "Straßen", "committee", "abcabcabc", "zzyzzyzz", "×÷×÷×÷"]
    def slip(w):
        i, c = pick.randrange(len(w) + 1), pick.choice("abcéz")
        return pick.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])
    rows = []
    for i in range(texts):
        words = []
        for _ in range(60):
            w = pick.choice(bases)
            for _ in range(pick.choice([0, 0, 0, 1, 1, 2, 3])):
                w = slip(w)
            words.append(pick.choice([w, w.upper(), w.capitalize()]))
        rows.append((i, pick.choice([" ", "-", "1", "ā", "\n"]).join(words), "en", "a"))
    return rows


@pytest.mark.parametrize("block", [spelling.BLOCK, 7])
def test_like_every_word_against_every_other(spark, block):
    rows = slips(1, 150) + odd_rows() + [(None, "banana " * 500, None, None)] * 2
    rows += [(500, "wordaa " * 140 + "wordab " * 27 + "wordbb " * 5, "en", "a")]
    expected = by_hand(rows)
    assert any(form and root != form for _, form, root, *_ in expected) and max(r[4] for r in expected) > 20
    assert got(frame(spark, rows), block=block) == expected


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert got(docs) == by_hand([(r.doc_id, r.text) for r in docs.collect()])


def test_other_bounds(spark):
    rows = slips(2, 30)
    assert got(frame(spark, rows), least_length=2, least_count=1) == by_hand(rows, least_length=2, least_count=1)


def test_the_index_of_one_block():
    """Against the definition, for words at all lengths and letters beyond the first plane."""
    pick = random.Random(3)
    words = sorted({"".join(pick.choice("ab😀") for _ in range(pick.randint(1, 6))) for _ in range(400)})
    index = spelling.PositionIndex(words)
    for w in [*words, "abab😀ab", "c"]:
        found, shared = index.near(w, 2)
        assert [words[j] for j in index.members(found)] == [v for v in words if v != w and is_near(w, v)]
        if found and len(w) >= 2:
            assert [words[j] for j in index.members(shared)] == [v for v in words if v[:2] == w[:2]]


def test_long_words_and_empty_tables(spark):
    long = "ab" * 5000
    rows = [(i, f"{long} {long}x {'b' + long[1:]} {long}", "en", "a") for i in range(60)]
    assert got(frame(spark, rows)) == by_hand(rows)
    assert got(frame(spark, rows).limit(0)) == [] and got(frame(spark, [(1, None, None, None)])) == []


def test_long_chains_end(spark):
    links = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(40)], "word string, form string")
    assert {r.root for r in spelling.roots(links).collect()} == {"w040"}
