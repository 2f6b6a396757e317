from __future__ import annotations

import base64
from collections import defaultdict

import pytest

from comptoir.llm import token_counts
from llm.cases import frame, odd_rows

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def encoder():
    known = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    known.encode_special_tokens = True
    return known


def by_character(encoder, text: str, rule: str) -> list[int]:
    """Counts per line, from the offsets of another implementation, character by character."""
    line, at = [], 0
    for c in text:
        line.append(at)
        at += c == "\n"
    counts = defaultdict(int)
    for a, b in encoder.encode(text, add_special_tokens=False).offsets:
        held = defaultdict(int)
        for i in range(a, b):
            held[line[i]] += 1
        counts[line[a] if rule == "first" else max(held, key=lambda k: (held[k], -k))] += 1
    return [counts[k] for k in range(max(line, default=0) + 1)]


TEXTS = ["", "one", "a\nb\n", "\n\n\nx\n", "é\nü  \n\n  word", "中文😀\n\n😀", "tab\t\n\n\n\n  end", "a \n \n b"]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_counts_agree_with_another_tokenizer(spark, folder, encoder, rule):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").limit(100).collect()]
    docs = frame(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    got = defaultdict(dict)
    for r in token_counts.document_sections(docs, rule=rule).collect():
        got[r.doc_id][r.section] = r
    for i, text in enumerate(texts):
        sections = [got[i][k] for k in sorted(got[i])]
        assert [s.n_tokens for s in sections] == by_character(encoder, text, rule), text
        assert "".join(text[s.start:s.end] for s in sections) == text
        assert all(a.end == b.start for a, b in zip(sections, sections[1:]))


def test_odd_rows(spark):
    rows = odd_rows()
    got = token_counts.document_sections(frame(spark, rows)).collect()
    assert len(got) == sum(max(1, len((t or "").splitlines() if "\x0b" not in (t or "") else (t or "").split("\n"))) for _, t, *_ in rows)
    assert [r.n_tokens for r in got if r.doc_id == 302] == [0]
    assert token_counts.document_sections(frame(spark, rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        token_counts.document_sections(frame(spark, rows), rule="other")


def test_a_token_over_a_boundary(spark):
    import numpy as np

    first, after, starts = np.array([0, 3]), np.array([3, 6]), np.array([0, 2, 4])
    assert token_counts.allocated(first, after, starts, 6, "majority")[0].tolist() == [1, 0, 1]
    assert token_counts.allocated(first, after, starts, 6, "first")[0].tolist() == [1, 1, 0]
    assert token_counts.allocated(first, after, starts, 6, "first")[1].tolist() == [1, 1, 0]


def test_vocabulary_covers_all_bytes():
    with open(token_counts.VOCABULARY, "rb") as lines:
        single = {base64.b64decode(line.split()[0]) for line in lines}
    assert all(bytes([b]) in single for b in range(256))
