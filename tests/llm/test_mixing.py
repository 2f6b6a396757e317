from __future__ import annotations

import re

import duckdb

from comptoir.llm import mixing
from llm.cases import frame, odd_rows, text


def targets_by_rounds(sizes: dict, weights=mixing.WEIGHTS, share=1.5, most=2) -> dict:
    """Shares by weight, capped, the excess shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, share * sum(sizes.values()), set(names)
    while free:
        each = left / sum(weight[s] for s in free)
        over = {s for s in free if each * weight[s] >= most * sizes[s]}
        if not over:
            return target | {s: each * weight[s] for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


def sizes_of(rows):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    found: dict = {}
    for _, t, _, source in rows:
        found[source] = found.get(source, 0) + count(t)
    return found


def test_targets_and_takes(spark):
    rows = odd_rows() + [(1000 + i, text(i, 40), "en", f"s{i % 7}") for i in range(700)]
    got = mixing.mixed_words(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, expected = sizes_of(rows), targets_by_rounds(sizes_of(rows))
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    for i in range(7):
        assert abs(taken[f"s{i}"] - expected[f"s{i}"]) < 0.15 * expected[f"s{i}"]
    again = mixing.mixed_words(frame(spark, rows).repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_repeated_rows_are_drawn_one_by_one(spark):
    """1,000 rows of three texts without id: one draw for each text would miss the target by up to a third."""
    rows = [(None, text(i % 3, 4), "en", "c") for i in range(1000)] + [(i, text(i, 9), "en", "ab"[i % 2]) for i in range(2000)]
    rows += [(7, "one", "en", "c"), (7, "one", "en", None)] * 40
    docs = frame(spark, rows)
    got = mixing.mixed_words(docs).collect()
    taken = sum(r.taken for r in got if r.source == "c")
    target = next(r.target for r in got if r.source == "c")
    assert len(got) == len(rows) and 1 < target / sizes_of(rows)["c"] < 2 and abs(taken - target) < 0.03 * target
    again = mixing.mixed_words(frame(spark, rows[::-1]).repartition(3)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    planned = sorted(repr((r.doc_id, r.source, r["size"])) for r in mixing.plan(docs).collect() for _ in range(r.copies))
    mixed = sorted(repr((r.doc_id, r.source, len(r.text.split()))) for r in mixing.mix(docs).collect())
    assert planned == mixed

    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, s) for i, t, _, s in rows])
    result = connection.execute(mixing.MIXED_WORDS_SQL)
    names = [c[0] for c in result.description]
    assert sorted(repr([r[c] for c in names]) for r in got) == sorted(repr(list(row)) for row in result.fetchall())


def test_emitted_documents_are_those_of_the_plan(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    planned = [r.doc_id for r in mixing.plan(docs).collect() for _ in range(r.copies)]
    assert sorted(map(repr, planned)) == sorted(repr(r.doc_id) for r in mixed.collect())


def test_empty_tables_and_sources(spark):
    docs = frame(spark, odd_rows())
    assert mixing.mixed_words(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    blank = frame(spark, [(1, None, None, "a"), (2, "", None, None)])
    assert [(r.size, r.target, r.taken) for r in mixing.mixed_words(blank).collect()] == [(0, 0.0, 0)] * 2
