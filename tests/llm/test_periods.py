from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from newslens.llm import periods


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """Every maximal stretch of each period, tried one period after the other."""
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if end > start and length >= max(6, 4 * q) and (start, length) not in found:
                found[start, length] = q
            start = max(end, start) + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def plain_row(doc_id, text) -> tuple:
    words = periods_split(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    first = (None,) * 4 if best is None else (best[1], -best[0], best[2], -1000 * best[0] // best[2])
    return (doc_id, len(runs), *first, _sha(lines), _sha(kept))


def periods_split(text) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def random_words(rng: random.Random) -> list[str]:
    words: list[str] = []
    for _ in range(rng.randrange(1, 6)):
        phrase = [rng.choice("abc"[: rng.randrange(1, 4)]) for _ in range(rng.randrange(1, 9))]
        words += (phrase * rng.randrange(1, 7))[: rng.randrange(1, 40)]
    return words


def test_runs_equal_the_plain_search():
    rng = random.Random(5)
    cases = [random_words(rng) for _ in range(1500)]
    cases += [["a"] * n for n in range(12)] + [[], ["a", "b"] * 500, list("abaab") * 40]
    found = periods.collapse([" ".join(c).encode() for c in cases])
    for words, one in zip(cases, found, strict=True):
        assert [tuple(r) for r in one.runs.tolist()] == plain_runs(words), words
        assert one.words == len(words)


def test_groups_do_not_meet(monkeypatch):
    cases = [b"x y x y x y", b"x y x y", b"", b"z z z z z z z"] * 20
    together = periods.collapse(cases)
    monkeypatch.setattr(periods, "GROUP_WORDS", 1)
    alone = periods.collapse(cases)
    assert [f.runs.tolist() for f in together] == [f.runs.tolist() for f in alone]
    assert not len(together[0].runs) and together[3].runs.tolist() == [[0, 7, 1]]


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    values = rng.permutation(300)
    wavelet = periods.WaveletMatrix(values)
    low = rng.integers(0, 300, 500)
    high = low + 1 + rng.integers(0, 300, 500) % (300 - low)
    bound = rng.integers(0, 300, 500)
    below = wavelet.below(low, high, bound)
    rank = rng.integers(0, 1 << 30, 500) % (high - low)
    smallest = wavelet.smallest(low, high, rank)
    for i in range(500):
        part = values[low[i] : high[i]]
        assert below[i] == (part < bound[i]).sum()
        assert smallest[i] == np.sort(part)[rank[i]]


def test_query_equals_the_plain_search(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(random_words(rng)), "x", 1) for i in range(250)]
    rows += [(i, None, None, None) for i in range(250, 300)] + [(i, " \t\n", "x", 1) for i in range(300, 340)]
    rows += [(None, "a b a b a b a b", "x", 1), (7, rows[7][1], "x", 1), (400, "né x " * 3000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")
    found = periods.periodic_digests(docs.repartition(3)).collect()
    key = lambda row: tuple("" if v is None else str(v) for v in row)
    assert sorted(map(tuple, found), key=key) == sorted((plain_row(r[0], r[1]) for r in rows), key=key)


def test_texts_and_spans(spark):
    docs = spark.createDataFrame([(1, "say no no no no no no more", "d")], "doc_id long, text string, lang string")
    row = periods.periodic_runs(docs).first()
    assert (row.n_words, row.collapsed) == (8, "say no more")
    assert [tuple(r) for r in row.runs] == [(1, 6, 1)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periods.periodic_digests(docs).collect() == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    found = {tuple(r) for r in periods.periodic_digests(docs).collect()}
    short = [r for r in rows if len(r.text or "") < 8000]
    assert len(found) == len(rows) and len(short) > 100
    assert {plain_row(r.doc_id, r.text) for r in short} <= found


@pytest.mark.parametrize("n", [1, 5, 6, 7, 64])
def test_one_word_over_and_over(n):
    (found,) = periods.collapse([b"w " * n])
    assert found.runs.tolist() == ([[0, n, 1]] if n >= 6 else [])
    assert found.collapsed == (b"w" if n >= 6 else b" ".join([b"w"] * n))
