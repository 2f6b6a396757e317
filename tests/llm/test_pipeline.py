"""The pipeline against a plain version, stage by stage, on a small table with planted cases."""

from __future__ import annotations

import corpus_pipeline
from comptoir.llm import language, mixing
from llm.cases import edited, frame, text, words
from llm.test_decontaminate import expected as held_items
from llm.test_ngram_join import brute
from llm.test_sharding import checked


def planted():
    base = words(1, 150)
    rows = [(i, text(100 + i, 60), "en", f"s{i % 3}") for i in range(200)]
    rows += [(300 + i, edited(base, [7 * i]), "en", "hot") for i in range(8)]
    rows += [(400 + i, text(100, 60), "en", "hot") for i in range(5)]
    rows += [(500, f"{text(8, 200)} {text(77, 40)} {text(9, 200)}", "en", "s1"), (501, "!!", "en", "s1"), (502, None, None, None)]
    return rows


def test_stages_do_their_work(spark, tmp_path):
    rows = planted()
    folder = str(tmp_path)
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    items = [(1, text(77, 40)), (2, text(78, 20))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = rows
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{number}")
        before, docs = docs, spark.read.parquet(f"{folder}/{number}")
        ids = sorted(r.doc_id for r in docs.collect())
        if name == "language_id":
            names, scores = language.fitted(before).identify([t for _, t, *_ in kept])
            kept = [r for r, name_, score in zip(kept, names, scores) if name_ != "und" and score >= language.LEAST_COSINE]
            assert len(kept) > 180
            assert ids == sorted(i for i, *_ in kept) and {501, 502} & set(ids) == set()
        elif name == "near_duplicates":
            groups = [eval(x) for x in brute(kept)]
            first = {i for i, _, c in groups if i == c}
            kept = [r for r in kept if r[0] in first]
            assert ids == sorted(first) and len([i for i in ids if 300 <= i < 308]) == 1 and not [i for i in ids if 400 <= i < 405]
        elif name == "decontamination":
            held = {i for i, _ in held_items(kept, items)}
            assert held == {500}
            kept = [r for r in kept if r[0] not in held]
            assert ids == sorted(i for i, *_ in kept)
        elif name == "mix":
            times = {r.doc_id: r.copies for r in mixing.plan(before).collect()}
            kept = [r for r in kept for _ in range(times[r[0]])]
            assert ids == sorted(i for i, *_ in kept)
        else:
            checked(kept, docs.collect())
        if name != "shard":
            assert docs.columns == before.columns
    assert number == 4
    assert corpus_pipeline.run(spark, folder).count() == len(kept)
