from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np

from comptoir.llm import language
from llm.cases import frame, odd_rows, text

ALPHABETS = {"aa": "abcdeab", "bb": "vwxyzea", "cc": "ghijkea"}


def made(n, first=0):
    pick = np.random.default_rng(first + 1)
    rows = []
    for i in range(first, first + n):
        lang = sorted(ALPHABETS)[i % 3]
        words = ["".join(pick.choice(list(ALPHABETS[lang]), pick.integers(2, 6))) for _ in range(30)]
        rows.append((i, " ".join(words), lang, "s"))
    return rows


def slow_bundle(t):
    """One n-gram after the other."""
    letters = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in t).split()) + " "
    vector = lambda c: language._letter_vector(0 if c == " " else ord(c)).astype(float)
    total = np.zeros(language.DIMENSIONS)
    for i in range(len(letters) - 2):
        if letters[i + 1] != " ":
            total += np.roll(vector(letters[i]), 2) * np.roll(vector(letters[i + 1]), 1) * vector(letters[i + 2])
    return total


def test_bundles_are_sums_of_bound_ngrams():
    texts = ["Hello, World", "a", "é ü 12 ab", "", None, "...", "x y", "long " * 400]
    got = language.bundles(texts)
    for row, t in zip(got, texts):
        wanted = slow_bundle(t or "")
        length = np.linalg.norm(wanted)
        assert np.allclose(row, wanted / length if length else wanted, atol=1e-5), t


def test_chunks_do_not_change_bundles(monkeypatch):
    texts = [text(i, 50) for i in range(40)] + [None, ""]
    whole = language.bundles(texts)
    monkeypatch.setattr(language, "CHUNK_CHARS", 500)
    monkeypatch.setattr(language, "BLOCK", 16)
    assert np.allclose(whole, language.bundles(texts), atol=1e-5)


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r for r in language.document_languages(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    tested = [(r.lang, got[r.doc_id].lang_pred) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([a == b for a, b in tested]) > 0.9
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = made(120)
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s) for i, t, lang, s in rows]
    a, b = (sorted(map(repr, language.document_languages(frame(spark, r)).collect())) for r in (rows, wrong))
    assert a == b


def test_odd_rows(spark):
    rows = odd_rows()
    got = language.document_languages(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (301, 302, 305, 306):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in ("en", "fr", "de", "es") and 0 <= r.score <= 1
    assert language.document_languages(frame(spark, rows).limit(0)).count() == 0
    unlabelled = frame(spark, [(i, t, None, s) for i, t, _, s in rows])
    assert {r.lang_pred for r in language.document_languages(unlabelled).collect()} == {"und"}


def test_filter_keeps_clean_documents(spark):
    """Texts in scripts that no label teaches go at every length; those in a learned language stay."""
    pick, clean = random.Random(2), made(150)
    script = lambda first, n: "".join(chr(first + pick.randrange(24)) if pick.random() < 0.85 else " " for _ in range(n))
    foreign = [(1000 + i, "x" + script((0x430, 0x3B1, 0x4E00, 0x5D0)[i % 4], 4 + 3 * i)[1:], None, "s") for i in range(200)]
    rows = clean + foreign + [(902, "!!!", "aa", "s"), (905, None, "aa", "s")]
    kept = language.in_known_language(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i, *_ in clean} <= ids and not {902, 905} & ids
    stayed = [i for i, *_ in foreign if i in ids]
    assert len(stayed) <= 0.03 * len(foreign), stayed


def test_filter_keeps_all_if_nothing_was_learned(spark):
    rows = [(i, t, None, s) for i, t, _, s in made(20)]
    assert language.in_known_language(frame(spark, rows)).count() == 20


def test_many_short_texts_take_little_memory():
    texts = [None, "", *(f"{i:09}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(10_000))]
    tracemalloc.start()
    rows = language.bundles(texts)
    assert rows.shape == (10_002, language.DIMENSIONS) and tracemalloc.get_traced_memory()[1] < 250e6
    tracemalloc.stop()


def test_no_labels_no_language(spark):
    assert language.Profiles.fit(frame(spark, odd_rows()).limit(0)).languages == []
