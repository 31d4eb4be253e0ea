"""Contained benchmark items against a plain search."""

from __future__ import annotations

import random
import re


from newslens.llm.decontaminate import containments, item_sketches
from newslens.llm.tables import table


def grams(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    if len(words) < 5:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(docs, items):
    held, out = [(d, grams(t)) for d, t in docs if d is not None], {}
    for item, text in items:
        wanted = grams(text)
        for doc, has in held:
            share = len(wanted & has) / len(wanted) if wanted else 0
            if item is not None and share >= 0.8:
                out[doc, item] = max(share, out.get((doc, item), 0))
    return sorted((*k, v) for k, v in out.items())


def test_hard_cases(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 4, 5, 6, 20, 35, 36, 60])))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "!?"), (None, "w1 w2 w3 w4 w5 w6"), (3, "another text of item three here"), (103, "a b c d e " * 10)]
    docs = []
    for i in range(150):
        words = rng.choices(vocab, k=rng.randint(0, 300))
        _, item = rng.choice(items[:40])
        part = item.split()
        for _ in range(rng.randint(0, 3)):
            part[rng.randrange(len(part))] = "changed"
        at = rng.randint(0, len(words))
        docs.append((i, " ".join([*words[:at], *(w.upper() + "," for w in part), *words[at:]])))
    docs += [(500, None), (501, ""), (None, items[5][1]), (502, items[5][1]), (502, items[5][1]), (502, "other"), (503, "x " * 60000 + items[9][1]), (504, "A b c d e a b c d e")]
    left = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS hash", "3 AS item", "'w' AS words")
    right = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'w' AS words")
    got = sorted(map(tuple, containments(left, right).collect()))
    assert got == plain(docs, items)
    assert len(got) > 50
    assert containments(left.limit(0), right).count() == 0
    assert containments(left, right.limit(0)).count() == 0


def test_sketch_is_longer_than_what_may_be_missing(spark):
    rows = [(n, " ".join(f"x{n}y{i}" for i in range(n + 4))) for n in range(1, 130)]
    df = spark.createDataFrame(rows, "item long, text string")
    sizes = {r.item: r["count"] for r in item_sketches(df).groupBy("item").count().collect()}
    for n, size in sizes.items():
        assert min(n, n // 5 + 1) <= size <= 2 * n // 5 + 1, n


def test_given_documents(spark):
    docs, items = (table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "benchmark"))
    got = sorted(map(tuple, containments(docs, items).collect()))
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got


def test_candidates_are_never_broadcast(spark, tmp_path):
    """Their files are far smaller than they are: an item's shingles stand there once for many rows."""
    path = str(tmp_path / "docs")
    text = " ".join(f"w{i}" for i in range(40))
    spark.createDataFrame([(i, text) for i in range(50)], "doc_id long, text string").write.parquet(path)
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    found = containments(spark.read.parquet(path), items)
    assert found.count() == 50
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=merge)" in plan
