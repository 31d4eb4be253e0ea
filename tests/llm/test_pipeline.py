"""The corpus pipeline stage by stage on a small table with odd rows."""

from __future__ import annotations

import random

import corpus_pipeline as P
from newslens.llm.simhash import simhash


def test_stages_on_odd_rows(spark, tmp_path):
    rng = random.Random(12)
    vocab = {"en": ["the", "thing", "other", "with", "that", "oak"], "fr": ["été", "que", "leçon", "dans", "où", "vous"]}
    rows = []
    for i in range(120):
        lang = "en" if i % 3 else "fr"
        words = [f"{w}{rng.choice('aeiou')}{rng.choice('bdgk')}" for w in rng.choices(vocab[lang], k=80)]
        rows.append((i, " ".join(words), lang, f"src{i % 5}", 0))
    item = "one benchmark passage of some length that nobody should train on at all"
    rows += [
        (200, rows[4][1], "en", "src1", 0), (201, rows[4][1].upper(), "en", "src1", 0),
        (202, rows[5][1] + " " + item, "en", "src2", 0), (203, None, "en", "src2", 0), (204, "", None, None, None),
        (205, "12 34 --", "en", "src0", 0), (206, rows[6][1] + " end of it", None, None, None), (7, rows[7][1], "en", "src2", 0),
        (None, "no id here", "en", "src0", 0),
    ]
    sf_dir = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "'x' AS lang_pred", "1 AS component_id", "2 AS tokens", "3 AS hash")
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    texts = {r[0]: r[1] for r in rows}

    after, current = {}, spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in P.STAGES:
        out = stage(spark, current, sf_dir)
        out.write.parquet(f"{sf_dir}/{name}")
        current = spark.read.parquet(f"{sf_dir}/{name}")
        after[name] = current.collect()
        if name != "tokens":
            assert current.columns == list(P.COLUMNS)
            assert all(r.text == texts[r.doc_id] for r in after[name])
    ids = {name: sorted(r.doc_id for r in found) for name, found in after.items()}
    assert set(ids["language"]) == {r[0] for r in rows if r[0] is not None and r[0] not in (203, 204, 205)}
    assert {r.lang for r in after["language"] if r.doc_id == 206} <= {"en", "fr"}

    fps = {d: simhash(texts[d].encode()) for d in set(ids["language"])}
    label = {d: d for d in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 4:
                    label[a] = min(label[a], label[b])
    assert ids["near_duplicates"] == sorted({d for d in fps if label[d] == d})
    assert 200 not in ids["near_duplicates"] and 201 not in ids["near_duplicates"]

    assert ids["decontamination"] == [d for d in ids["near_duplicates"] if item not in texts[d]]
    assert 202 not in ids["decontamination"]
    assert set(ids["mix"]) < set(ids["decontamination"]) and len(ids["mix"]) > 0.7 * len(ids["decontamination"])
    assert ids["tokens"] == ids["mix"]
    at = 0
    for r in sorted(after["tokens"], key=lambda r: r.doc_id):
        assert r.start == at
        at += r.n_tokens


def test_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
