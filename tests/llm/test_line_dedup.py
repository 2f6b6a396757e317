from __future__ import annotations

import hashlib
import random

import pytest

from comptoir.llm import line_dedup
from conftest import final_plan
from llm.cases import frame, odd_rows, text

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least_chars=40, least_docs=5):
    """(doc_id, n_lines, n_dropped, digest) of every row, from one dictionary."""
    key = lambda line: line.strip(WHITE).translate(LOWER)
    holders: dict = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(i)
    keeper = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= least_docs}
    found = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if key(line) not in keeper or keeper[key(line)] == i]
        found.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(found, key=repr)


def shared_lines():
    """A line in every text, lines at the bounds of length and frequency, forms of one line, repeats in a text."""
    common = "This line Stands in all of the documents here"
    at, under = "x" * 39 + "É", "y" * 39
    rows = []
    for i in range(60):
        lines = [text(i, 12), f"{common}\t", f" \x0b{common.upper()}", at, under]
        if i % 12 == 3:  # five documents
            lines.append("a line that occurs in five documents of the table")
        if i % 15 == 4:  # four documents
            lines += ["a line that occurs in four documents of the table"] * 3
        random.Random(i).shuffle(lines)
        rows.append((i, "\n".join(lines), "en", "a"))
    rows += [(60 + i, common + "\n" + common, "en", "a") for i in range(5)] + [(7, rows[7][1], "en", "a")] * 3
    rows += [(None, common + "\nother", "en", "a")] * 6 + [(8, "another text of eight\n" + common, None, None)]
    rows += [(90, "\n".join([common, text(1, 3000), *["z" * 50] * 2000]), "en", "a"), (91, "\n", "en", "a"), (92, "é" * 40, "en", "a")]
    return rows + odd_rows()


def report(spark, rows, **rule):
    return sorted((tuple(r) for r in line_dedup.line_report(frame(spark, rows), **rule).collect()), key=repr)


@pytest.mark.parametrize("rule", [{}, {"batches": 1}, {"batches": 7, "hot": 1.0}, {"hot": 0.0}])
def test_like_one_dictionary(spark, rule):
    rows = shared_lines()
    assert report(spark, rows, **rule) == by_hand(rows)


def test_other_bounds(spark):
    rows = shared_lines()
    assert report(spark, rows, least_chars=39, least_docs=4) == by_hand(rows, 39, 4)


def test_texts_come_out_whole(spark):
    rows = shared_lines()
    docs = frame(spark, rows)
    got = line_dedup.deduplicated(docs)
    assert got.columns == docs.columns
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted(((r.doc_id, digest(r.text)) for r in got.collect()), key=repr) == sorted(((i, d) for i, _, _, d in by_hand(rows)), key=repr)
    assert got.where("doc_id = 302").first().text is None


def test_empty_and_blank_tables(spark):
    docs = frame(spark, odd_rows())
    assert line_dedup.line_report(docs.limit(0)).count() == 0
    assert report(spark, [(1, None, None, None), (2, "", None, None)]) == by_hand([(1, None), (2, "")])


def test_a_stream_of_batches(spark):
    """The first batch that holds a line has it; later ones do not."""
    runs, seen, tables = line_dedup.LineRuns(spark, 4), set(), spark.catalog.listTables()
    batches = [[(10 * b + i, "\n".join(text(s, 15) for s in (i, 100 * b + i, 7 + b))) for i in range(9)] for b in range(5)]
    frames = [spark.createDataFrame(rows, "doc_id long, text string") for rows in batches]
    for rows, got in zip(batches, line_dedup.new_lines(frames, runs)):
        lines = [(i, p, line) for i, t in rows for p, line in enumerate(t.split("\n")) if len(line) >= 40]
        assert {(r.doc_id, r.pos) for r in got.collect()} == {(i, p) for i, p, line in lines if line not in seen}
        seen |= {line for _, _, line in lines}
    assert len(runs.runs()) == 2  # five batches: 101 in binary
    assert runs.merged().count() == len(seen)
    runs.close()
    assert spark.catalog.listTables() == tables


def test_runs_are_merged_without_a_shuffle(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    runs = line_dedup.LineRuns(spark, 4)
    for k in (0, 1, 2):
        runs.add(spark.range(k * 50, k * 50 + 100).selectExpr("unhex(md5(cast(id as string))) AS line", "1L AS n", "id AS keeper"))
    larger, smaller = reversed(runs.runs())
    plan = final_plan(line_dedup.LineRuns.merge(larger, smaller))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert "Exchange" not in final_plan(runs.unseen(larger))
    runs.close()
