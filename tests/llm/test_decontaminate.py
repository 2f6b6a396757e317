from __future__ import annotations

import re

import duckdb
import pytest

from comptoir.llm import decontaminate
from llm.cases import frame, odd_rows, text, words


def shingles(t):
    w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows, items):
    docs: dict = {}
    for i, t, *_ in rows:
        docs.setdefault(i, set()).update(shingles(t))
    found = {}
    for item, t in items:
        mine = shingles(t)
        for i, s in docs.items():
            if i is not None and mine and 4 * len(mine & s) >= 3 * len(mine):
                found[i, item] = (len(mine), len(mine & s))
    return found


def test_short_items_in_long_documents(spark):
    passages = [text(900 + i, n) for i, n in enumerate((3, 5, 8, 14, 30, 59))]
    items = list(enumerate(passages)) + [(90, None), (91, ""), (92, passages[4]), (93, "a b")]
    rows = odd_rows()
    rows += [(2000 + i, f"{text(i, 4000)} {p.upper()}, {text(50 + i, 3000)}", "en", "x") for i, p in enumerate(passages)]
    cut = words(905, 59)
    rows += [(3000 + k, f"{text(k, 500)} {' '.join(cut[:59 - k])} {text(k + 1, 500)}", "en", "x") for k in range(0, 30, 3)]
    rows += [(4000, cut[0] + " " + cut[1], "en", "x")]
    benchmark = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, n int, hash int")
    got = decontaminate.contained_items(frame(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in got} == expected(rows, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})

    docs = frame(spark, rows)
    kept = decontaminate.without_items(docs, benchmark)
    assert kept.columns == docs.columns
    held = {i for i, _ in expected(rows, items)}
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(i) for i, *_ in rows if i not in held)


def test_null_and_repeated_ids(spark):
    """The filter goes by texts; the report by ids, null among them, as the SQL twin does."""
    a, b, c, d = (text(700 + i, 30) for i in range(4))
    within = lambda k, passage: f"{text(k, 200)} {passage} {text(k + 50, 200)}"
    items = [(1, a), (1, b), (None, c), (None, d), (2, text(710, 30))]
    dirty = [(10, within(1, a)), (None, within(2, b)), (11, within(3, c)), (12, within(4, a + " " + b)), (None, within(5, c + " " + d)), (13, within(6, text(710, 30)))]
    half = words(710, 30)
    clean = [(13, text(8, 300)), (None, text(9, 300)), (14, None), (None, None), (15, within(10, " ".join(half[:15]))), (15, within(11, " ".join(half[15:])))]
    docs = frame(spark, [(*row, "en", "x") for row in dirty + clean])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.without_items(docs, benchmark).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept))) == sorted(map(repr, clean))

    connection = duckdb.connect()
    for name, rows in (("documents", dirty + clean), ("benchmark", items)):
        connection.execute(f"CREATE TABLE {name} ({'doc_id' if name == 'documents' else 'item_id'} BIGINT, text VARCHAR)")
        connection.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    twin = connection.execute(decontaminate.CONTAINED_ITEMS_SQL).fetchall()
    got = decontaminate.contained_items(docs, benchmark).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, twin))
    assert {(12, 1), (None, None), (13, 2), (15, 2)} <= {(r.doc_id, r.item_id) for r in got}


def test_a_sentence_that_items_share_forms_no_pairs(spark):
    """Items and documents that all begin alike: candidates are the pairs that are right, and few others."""
    opening = "once upon a time there was a very old king"
    items = [(i, f"{opening} {text(5000 + i, 20 + i % 40)}") for i in range(300)]
    rows = [(i, f"{opening} {text(9000 + i, 300)} {items[i][1] if i % 10 == 0 else ''}", "en", "x") for i in range(300)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    every = decontaminate.item_shingles(benchmark).cache()
    candidates = decontaminate._candidates(frame(spark, rows), every)
    assert {(r.doc, r.item) for r in candidates.collect()} == {(i, i) for i in range(0, 300, 10)}
    got = decontaminate.contained_items(frame(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in got} == expected(rows, items)


@pytest.mark.parametrize("limit", [0, decontaminate.BROADCAST_ROWS])
def test_items_made_from_one_form(spark, monkeypatch, limit):
    """Items that differ in some words, so that most sketches hold shared shingles; with and without broadcasts."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    form = words(77, 60)
    items = [(i, " ".join(form[:10 + i % 20] + words(600 + i, i % 12) + form[10 + i % 20:25 + i])) for i in range(36)]
    rows = [(1000 + i, f"{text(i, 50)} {items[i % 36][1]} {text(i + 1, 50)}", "en", "x") for i in range(80)] + odd_rows()
    rows += [(500 + k, " ".join(form[:12 + 3 * k]), "en", "x") for k in range(16)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contained_items(frame(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in got} == expected(rows, items)
    kept = decontaminate.without_items(frame(spark, rows), benchmark)
    held = {i for i, _ in expected(rows, items)}
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(i) for i, *_ in rows if i not in held)


def test_each_partition_has_its_own_bound(spark):
    """A containing document holds ``agree`` of a sketch even if it misses all the shingles that it may."""
    items = spark.createDataFrame([(n, text(n, n + 4)) for n in range(1, 70)], "item_id long, text string")
    for r in decontaminate.item_shingles(items).where("rank = 1").collect():
        assert (r.n, r.needed) == (r.item_id, -(-3 * r.n // 4))
        assert r.agree == max(1, 2 ** (r.n.bit_length() - 1) // 4) <= r.needed


def test_empty_tables(spark):
    docs, items = frame(spark, odd_rows()), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contained_items(docs.limit(0), items).count() == 0
    assert decontaminate.contained_items(docs, items.limit(0)).count() == 0
    assert decontaminate.without_items(docs, items.limit(0)).count() == docs.count()
