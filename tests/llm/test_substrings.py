"""Repeated passages against brute force, and the index against plain counting."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark import cloudpickle

from newslens.llm import substrings as S
from newslens.llm.fm_index import FMIndex, WaveletMatrix
from newslens.llm.tables import table
from newslens.session import written


def test_wavelet_matrix_counts():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 37, 1000)
    tree = WaveletMatrix(symbols, 36)
    for c in range(37):
        at = rng.integers(0, 1001, 20)
        below = tree.down(np.full(20, c), at) - tree.down(np.full(20, c), np.zeros(20, np.int64))
        assert below.tolist() == [(symbols[:i] == c).sum() for i in at]


@pytest.mark.parametrize("sigma", [1, 2, 50])
def test_backward_search_finds_all_places(sigma):
    rng = np.random.default_rng(sigma)
    symbols = np.append(rng.integers(1, sigma + 1, 400), 0)
    index = FMIndex(symbols, 5)
    starts = np.arange(396)
    matched, low, high = index.repeats(starts, 5)
    text = symbols.tolist()
    for s in starts:
        places = {i for i in range(396) if text[i : i + 5] == text[s : s + 5]}
        if len(places) > 1:
            assert matched[s] == 5 and set(index.order[low[s] : high[s]].tolist()) == places
        else:
            ends = [n for n in range(1, 6) if sum(text[i : i + n] == text[s + 5 - n : s + 5] for i in range(401)) > 1]
            assert matched[s] == max(ends, default=0) < 5


def plain(rows):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    order = lambda d: (d is not None, d or 0)
    first = {}
    for d, ws in words:
        for i in range(len(ws) - 19):
            key = tuple(ws[i : i + 20])
            first[key] = min(first.get(key, (order(d), i)), (order(d), i))
    out = []
    for d, ws in words:
        gone = set()
        for i in range(len(ws) - 19):
            if first[tuple(ws[i : i + 20])] < (order(d), i):
                gone.update(range(i, i + 20))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def some_rows():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(300)] + ["été", "X", "x"]
    passages = [rng.choices(vocab, k=n) for n in (19, 20, 21, 40, 90, 200)]
    rows = []
    for i in range(120):
        words = rng.choices(vocab, k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            part = rng.choice(passages)
            a = rng.randrange(len(part))
            words[at:at] = part[a:] if rng.random() < 0.4 else part
        rows.append((rng.randint(-50, 5000) * 2, " \n".join(words)))
    rows += [(7001 + 2 * i, rows[3 + i % 4][1]) for i in range(12)]
    rows += [(9001, "and " * 500), (9003, "a b " * 300), (9005, None), (9007, ""), (None, rows[8][1]), (9009, "long " * 20000)]
    rows += [(9011, rows[20][1]), (9011, rows[20][1]), (9013, rows[21][1]), (9013, "other " + rows[22][1])]
    return rows


@pytest.mark.parametrize("hot", [S.HOT, 0])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "SHARD_WORDS", 3000)
    rows = some_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rid", "2 AS place", "3 AS words")
    got = sorted(map(tuple, S.remove_repeats(df.repartition(4)).collect()), key=repr)
    assert got == plain(rows)
    assert S.remove_repeats(df.limit(0)).count() == 0


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, S.remove_repeats(docs).collect()), key=repr) == plain(rows)


def test_passage_at_the_border_of_many_segments_fills_no_shard(spark, monkeypatch):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(300):
        before, after = ([f"u{rng.randrange(10**9)}" for _ in range(rng.randint(20, 30))] for _ in range(2))
        rows.append((i * 3 if i % 50 else None, " ".join(before + passage + after)))
    index_shard = S.index_shard

    def bounded(texts, places, starts):
        assert len(texts) <= 40, f"{len(texts)} rows in one shard"
        return index_shard(texts, places, starts)

    monkeypatch.setattr(S, "HOT", 40)
    monkeypatch.setattr(S, "SHARD_WORDS", 1)
    monkeypatch.setattr(S, "index_shard", bounded)
    cloudpickle.register_pickle_by_value(S)  # workers get the module as it is patched here
    try:
        got = sorted(map(tuple, S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()), key=repr)
    finally:
        cloudpickle.unregister_pickle_by_value(S)
    assert got == plain(rows)
    assert sum(r[2] for r in got) == 299 * 60


def test_words_of_segments_move_once_and_lone_segments_are_not_indexed(spark, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(f"u{rng.randrange(10**9)}" for _ in range(60)) for _ in range(20)]
    rows = [(7 * i % 400 + 1, texts[i % 20]) for i in range(100)]
    tables = []

    def noted(df, name):
        tables.append(name)
        return written(df, name)

    def none(texts, places, starts):
        raise AssertionError(f"{len(texts)} segments were indexed, none shares its anchor")

    monkeypatch.setattr(S, "written", noted)
    monkeypatch.setattr(S, "index_shard", none)
    cloudpickle.register_pickle_by_value(S)  # workers get the module as it is patched here
    try:
        got = sorted(map(tuple, S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()), key=repr)
    finally:
        cloudpickle.unregister_pickle_by_value(S)
    assert got == plain(rows) and sum(r[2] for r in got) == 80 * 60
    assert sorted(tables) == ["hot", "segments"]
