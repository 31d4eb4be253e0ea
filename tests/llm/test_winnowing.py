"""Winnowing and next-document edits against plain versions."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from newslens.llm.winnowing import (
    GRAM,
    WINDOW,
    _window_minima,
    edited,
    fingerprints,
    gram_hashes,
    likeness,
    near_edits,
    winnow,
)


def plain_winnow(data, gram, window):
    hashes = gram_hashes(data, gram).tolist()
    assert len({data[i : i + gram] for i in range(len(hashes))}) <= len(set(hashes)) + 3
    picked = []
    size = min(window, len(hashes))
    for i in range(len(hashes) - size + 1):
        part = hashes[i : i + size]
        place = i + max(j for j in range(size) if part[j] == min(part))
        if not picked or picked[-1] != place:
            picked.append(place)
    return [hashes[p] for p in picked], picked


@pytest.mark.parametrize("window", [1, 2, 3, 7, 32])
def test_winnow_is_the_plain_one(window):
    rng = random.Random(window)
    for size in (24, 25, 40, 300, 70000 if window == 7 else 500):
        data = bytes(rng.choices(b"ab ", k=size))
        hashes, positions = winnow(data, 24, window)
        assert (hashes.tolist(), positions.tolist()) == plain_winnow(data, 24, window)


def test_ties_take_the_rightmost():
    hashes, positions = winnow(b"a" * 60, 24, 8)
    assert positions.tolist() == list(range(7, 37)) and len(set(hashes.tolist())) == 1
    assert _window_minima(np.arange(5, dtype=np.uint64), 5).tolist() == [0]


def test_shared_passage_is_always_found():
    rng = random.Random(1)
    passage = bytes(rng.choices(b"abcdefg ", k=GRAM + WINDOW - 1))
    for _ in range(50):
        a, b = (bytes(rng.choices(b"xyz", k=rng.randint(0, 90))) for _ in range(2))
        assert set(winnow(a + passage)[0]) & set(winnow(passage + b)[0])


def test_short_texts_are_like_their_edit():
    rng = random.Random(2)
    for size in range(2 * (GRAM + WINDOW - 1), 120):
        text, after = ("".join(rng.choices("abcdefghijklmnop ", k=size)) for _ in range(2))
        sets = [np.unique(winnow(t.encode())[0]) for t in (text, edited(text, after), after)]
        assert likeness(sets[0], sets[1]) > likeness(sets[0], sets[2])


def plain(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        other = text[: len(text) - half] + after[:half]
        sets = [set(winnow(t.encode())[0].tolist()) for t in (text, other, after)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        out.append((doc, len(text), hashlib.sha256(other.encode()).hexdigest(), *near))
    return sorted(out, key=repr)


def test_near_edits_against_brute_force(spark):
    rng = random.Random(9)
    words = ["été", "日本", "alpha", "beta", "🙂", "c", "delta epsilon"]
    rows = [(i * 3, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(-40, 40)]
    rows += [(1006, "twice"), (1006, "twice"), (1007, None), (1008, ""), (None, "no id"), (None, None), (300, "x" * 40000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS bucket", "2 AS place")
    got = near_edits(df).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got), key=repr) == plain(rows)
    by_text = {}
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is not None:
            assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


@pytest.mark.parametrize("rows", [[], [(1, "alone " * 30)], [(None, None)]])
def test_tiny_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_edits(df).collect()
    assert len(got) == len(rows)
    assert all(r.near_next == 1.0 for r in got)
    assert fingerprints(df).count() == len(rows)
