from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

from comptoir.llm import resampling
from llm.cases import frame, odd_rows, text

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(t):
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    return len(words), words + [" ".join(p) for p in zip(words, words[1:])]


def by_hand(rows, targets, share=(25, 100), least=20):
    """(doc_id, n_features, weight, score, rank) of every row."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = Counter(), Counter()
    for counts, texts in ((s, [r[1] for r in rows]), (t, targets)):
        for one in texts:
            counts.update(map(bucket, features(one)[1]))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000))))
    found = []
    for i, one, *_ in rows:
        n, all_of = features(one)
        weight = sum(gain(bucket(f)) for f in all_of) // len(all_of) if all_of else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        found.append([i, len(all_of), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    eligible = sorted((r for r in found if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for place, r in enumerate(eligible[:len(eligible) * share[0] // share[1]]):
        r[4] = place + 1
    return sorted((tuple(r[:5]) for r in found), key=repr)


def got(spark, rows, targets, **options):
    target = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], "item_id long, text string")
    return sorted((tuple(r) for r in resampling.resampled(frame(spark, rows), target, **options).collect()), key=repr)


def some_rows():
    rows = odd_rows() + [(1000 + i, text(i % 40, 10 + i % 37) + " Über-ÜBER x1 é", "en", "a") for i in range(300)]
    rows += [(2000, text(3, 50), "en", "a")] * 30 + [(None, text(4, 30), None, None)] * 9 + [(2001, "a" * 5000 + " b " + "中" * 50, "en", "a")]
    return rows


def test_like_a_dictionary(spark):
    rows, targets = some_rows(), [text(i, 40) for i in range(5)] + ["", None, "one"]
    assert got(spark, rows, targets) == by_hand(rows, targets)
    assert got(spark, rows, targets, share=(1, 1), least_words=0) == by_hand(rows, targets, (1, 1), 0)


def test_whole_table(spark, folder):
    docs, items = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark"))
    expected = by_hand([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in items.collect()])
    assert sorted((tuple(r) for r in resampling.resampled(docs, items).collect()), key=repr) == expected


def test_empty_tables(spark):
    rows = some_rows()[:60]
    assert got(spark, rows, []) == by_hand(rows, [])
    assert got(spark, [], ["a b"]) == []
    blank = [(1, None, None, None), (2, "", None, None), (3, "...", None, None)]
    assert got(spark, blank, ["a"]) == by_hand(blank, ["a"])


def test_pieces_lose_no_feature():
    """Cut anywhere, the pieces of a text have its features, and each gathers its own gain."""
    texts = [text(1, 200), None, "", "a" * 300 + " b c " + "d" * 90, "x", text(2, 3)]
    gain = np.arange(10_000)
    for most in (1, 7, 64, 1 << 20):
        counts, sums = Counter(), Counter()
        for piece in resampling.pieces(texts, most):
            table = piece.table
            for i, slot in enumerate(table.slots):
                counts[piece.owner[i], table.spans.of(i).decode()] += 1
                sums[piece.owner[i]] += gain[table.bucket[slot]]
            assert table.count.sum() == len(table.slots)
        assert counts == Counter((row, f) for row, t in enumerate(texts) for f in features(t)[1])
        assert all(sums[row] == sum(zlib.crc32(f.encode()) % 10_000 for f in features(t)[1]) for row, t in enumerate(texts))


def test_keys_are_xxhash64():
    pick = random.Random(5)
    buffer = pick.randbytes(3000)
    start = np.array([pick.randrange(2900) for _ in range(2000)])
    length = np.array([i % 45 for i in range(2000)])
    spans = resampling.Spans(buffer, start, length)
    assert spans.keys().tolist() == [xxhash.xxh64_intdigest(buffer[a:a + n]) for a, n in zip(start, length)]


def test_equal_keys_do_not_merge_ngrams():
    """All keys equal: only the bytes tell n-grams apart, at every length."""
    pick = random.Random(6)
    buffer = "".join(pick.choice("ab") for _ in range(600)).encode()
    length = np.array([1 + i % 40 for i in range(900)])
    start = np.array([pick.randrange(len(buffer) - n) for n in length])
    spans = resampling.Spans(buffer, start, length)
    table = resampling.NgramTable(spans, np.full(900, 12345, np.uint64))
    slot_of: dict = {}
    for i in range(900):
        assert slot_of.setdefault(spans.of(i), table.slots[i]) == table.slots[i]
    assert len(set(slot_of.values())) == len(slot_of) == len(table.used)


def test_drawn_documents_are_whole(spark):
    rows, targets = some_rows(), [text(i, 40) for i in range(5)]
    docs = frame(spark, rows)
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    drawn = resampling.drawn_documents(docs, target)
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} == {r[0] for r in by_hand(rows, targets) if r[4]} - {None}
