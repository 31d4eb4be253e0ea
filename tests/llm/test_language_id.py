"""Language identification: gradients, held-out accuracy and odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np

from newslens.llm import language_id as L
from newslens.llm.tables import table


def test_gradients_are_the_numerical_ones():
    rng = np.random.default_rng(0)
    model = L.LanguageModel(["a", "b", "c"], {k: v.astype(np.float64) for k, v in L._start(3, rng).items()})
    pieces, labels = [b"abcb", b"c", b"ba", b"abcab", b"cc"], np.array([0, 1, 2, 1, 0])
    _, grads = L.gradients(model, pieces, labels)
    for name, value in model.weights.items():
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in value.shape)
            if name.startswith("table"):
                at = (int(rng.choice([97, 98, 99])), at[1])
            kept = value[at]
            losses = []
            for shift in (1e-2, -1e-2):
                value[at] = kept + shift
                losses.append(L.gradients(model, pieces, labels)[0])
            value[at] = kept
            assert abs((losses[0] - losses[1]) / 2e-2 - grads[name][at]) < 2e-3


def test_pooling_is_the_mean_over_all_bytes():
    model = L.LanguageModel(["a", "b"], L._start(2, np.random.default_rng(1)))
    texts = [b"One two two " + b"x" * 100, b"", b"two"]
    words = [t.lower().split() for t in texts]
    plain = [np.concatenate([model.label(w) for w in ws]).mean(axis=0) if ws else np.zeros(2) for ws in words]
    assert np.allclose(model.predict(texts), plain, atol=1e-5)
    assert np.allclose(model.predict(texts), plain, atol=1e-5)


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert set(got) == set(truth)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in set(held)) for i in truth)
    assert sum(got[i].lang_pred == truth[i] for i in held) / len(held) >= 0.97


def test_odd_rows_and_tables(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["aba", "bab"] if i % 2 else ["xyx", "yxy"], k=20)), "ab" if i % 2 else "xy") for i in range(80)]
    rows += [(500, None, "ab"), (501, "", None), (502, "123 ²!", "xy"), (None, "aba bab", None), (503, "aba " * 40000, None), (504, "z" * 100000, None), (1, rows[1][1], "ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "true AS held_out")
    got = L.identify(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3
    assert by_id[503].lang_pred == by_id[None].lang_pred == "ab"
    assert all(0 <= r.score <= 1 for r in got)
    assert L.identify(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in L.identify(docs.selectExpr("doc_id", "text", "CAST(null AS string) AS lang")).collect()} == {"und"}
    one = L.identify(docs.where("lang = 'ab'")).collect()
    assert {r.lang_pred for r in one} == {"ab", "und"}
