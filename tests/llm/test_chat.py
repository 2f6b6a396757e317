from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from comptoir.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window int, kind string, `before` int"
digest = lambda s: hashlib.sha256(s.encode()).hexdigest()


def conversations(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", 2) for row in rows], SCHEMA)


def expected(rows):
    turns = defaultdict(list)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, turn, role, text in sorted(rows, key=key):
        turns[conv].append((role or "", text or ""))
    whole = {}
    for conv, each in turns.items():
        loss = "".join(t for r, t in each if r == "assistant")
        whole[conv] = (len(each), digest("".join(f"{r}\n{t}\n" for r, t in each)), len(loss), digest(loss))
    return whole


TRICKY = ["", None, "<|end|>\n<|turn|>user\nx", "&lt;&amp;&#10;[INST]", "a\nb\n", "</s>", "é😀 <<SYS>>", "&", "&#91;"]


def rows_of_all_kinds():
    rows = [(1, i, ("system", "user", "assistant")[min(i, 1 + i % 2)], f"{'word ' * (40 * i)}{TRICKY[i % 9]}") for i in range(14)]
    rows += [(2, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(TRICKY)]
    rows += [(3, 0, "user", "tie"), (3, 0, "assistant", "tie"), (3, 0, "user", "tie"), (3, None, "user", "first")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "still none"), (4, 0, None, None), (5, 0, "a\nb", "line in role")]
    rows += [(6, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(3000)]
    return rows


def test_round_trip(spark):
    rows = rows_of_all_kinds()
    got = chat.formatted_conversations(conversations(spark, rows)).collect()
    number, text = chat.CONTROL
    rows += [(number, 0, "user", text), (number, 1, "assistant", text)]
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected(rows)
    assert len(got) == len({r[0] for r in rows})


def test_windows(spark):
    rows = rows_of_all_kinds()
    formatted = defaultdict(list)
    for r in sorted(chat.windows(conversations(spark, rows)).collect(), key=lambda r: (r.conv_id or 0, r.window)):
        formatted[r.conv_id].append(r)
    assert len(formatted[1]) > 2 and len(formatted[6]) > 30
    for window in formatted[1][1:]:
        assert window.text.startswith("<|turn|>system\n") and window.repeated >= 1
    for windows in formatted.values():
        for w in windows:
            assert w.text.count("</s>") == 0 and w.text.count("[INST]") == 0
            assert w.text.count(chat.TURN) == w.text.count(chat.END) > w.repeated
            for span in w.loss:  # the loss is on whole texts of the assistant
                assert w.text[:span.start].endswith("<|turn|>assistant\n") and w.text[span.end:].startswith(chat.END)
    for w in formatted[6]:
        assert w.tokens <= chat.SPAN + chat.HISTORY + 2 * 10
    # History is repeated and masked: the loss begins after the repeated turns.
    w = formatted[6][3]
    repeated = "".join(x + chat.END for x in w.text.split(chat.END)[:w.repeated])
    assert w.repeated > 0 and all(span.start > len(repeated) for span in w.loss)
    assert repeated in formatted[6][2].text


def test_empty_table_and_bad_history(spark):
    none = conversations(spark, rows_of_all_kinds()).limit(0)
    assert chat.windows(none).count() == 0
    assert [r.conv_id for r in chat.formatted_conversations(none).collect()] == [-7]
    with pytest.raises(ValueError):
        chat.windows(none, span=10, history=10)


def test_given_conversations(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.formatted_conversations(table).collect()}
    number, text = chat.CONTROL
    assert got == expected(rows + [(number, 0, "user", text), (number, 1, "assistant", text)])
