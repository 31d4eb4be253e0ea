"""Toxicity by compression distance: held-out accuracy and odd rows."""

from __future__ import annotations

import random
import zlib

from newslens.llm.tables import table
from newslens.llm.toxicity import fit, toxicity, windows


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = {r.doc_id: r for r in toxicity(docs, labels).collect()}
    assert len(scored) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(scored[i], y) for i, y in truth.items() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in held) and len(held) > 50
    assert sum(r.predicted == y for r, y in held) / len(held) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored.values())


def test_odd_rows_and_tables(spark):
    rng = random.Random(3)
    plain = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(300):
        words = rng.choices(plain, k=60)
        if i % 4 == 0:
            for place in rng.sample(range(60), 6):
                words[place] = rng.choice(("DESPICABLE", "abominable"))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(900, None), (901, ""), (None, rows[0][1]), (0, rows[0][1]), (902, "vile rotten " + "w1 " * 30000)]
    labels += [(1, 0), (None, 1), (5, None), (7777, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "0 AS label")
    known = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "'x' AS text")
    got = toxicity(docs, known).collect()
    assert len(got) == len(rows)
    right = sum(r.predicted == int(r.doc_id % 4 == 0) for r in got if r.doc_id is not None and r.doc_id < 300)
    assert right >= 290
    empty = {r.doc_id: r.score for r in got if r.doc_id in (900, 901)}
    assert empty[900] == empty[901] < 0.5
    none = toxicity(docs, known.limit(0)).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity(docs.limit(0), known).count() == 0


def test_windows_cover_every_word():
    assert b" ".join(windows(b"A b  c\td", 3)).split() == [b"a", b"b", b"c", b"d"]
    assert windows(b" ") == []
    assert fit([], [], 0.0).scores([b"x"]).tolist() == [0.0]
