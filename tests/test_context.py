"""The scorer in context against a plain reading of each text, word by word."""

from __future__ import annotations

import random

import pytest

from newslens.functions.lexicon import default_phrases, phrase_table
from newslens.operators.context import score_in_context

ROWS = [
    ("good", 70, 60, False), ("bad", -70, 65, False), ("not good enough", -35, 40, False), ("fake news", -60, 70, False),
    ("news", 10, 5, False), ("so so", -5, 55, False), ("not", -50, 100, True), ("very", 130, 130, True),
    ("so", 120, 110, True), ("hardly ever", -30, 90, True),
]


def cut(value: int) -> int:
    return abs(value) // 100 * (1 if value >= 0 else -1)


def plain(text, rows=ROWS) -> tuple[float, float]:
    table = {tuple(p.split(" ")): (pol, sub, m) for p, pol, sub, m in rows}
    words = (text if text is not None else "none").split()
    at, pol, sub, n, by = 0, 0, 0, 0, (100, 100)
    while at < len(words):
        for size in (3, 2, 1):
            found = table.get(tuple(words[at : at + size])) if at + size <= len(words) else None
            if found:
                break
        if not found:
            at, by = at + 1, (100, 100)
            continue
        scaled = cut(found[0] * by[0]), cut(found[1] * by[1])
        at += size
        if found[2]:
            by = tuple(max(-1000, min(1000, v)) for v in scaled)
        else:
            pol, sub, n, by = pol + max(-100, min(100, scaled[0])), sub + max(0, min(100, scaled[1])), n + 1, (100, 100)
    return (pol / (n * 100), sub / (n * 100)) if n else (0.0, 0.0)


def scores(spark, texts, phrases, parts=3):
    posts = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(parts)
    return {r.id: (r.polarity, r.subjectivity) for r in score_in_context(posts, phrases, ["id"]).collect()}


CASES = [
    "good", "not good", "very good", "not very good", "very not good", "not x good", "not good enough", "very not good enough",
    "fake news", "not fake news", "fake good news", "so so", "so so so good", "so so good", "hardly ever bad", "not not bad", "",
    None, "nothing known", "very", "very very very very very very very very very very very very good", "Very, GOOD! not-bad",
]


@pytest.mark.parametrize("broadcast", [True, False])
def test_texts_equal_the_plain_reading(spark, request, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    rng = random.Random(4)
    vocab = [w for p, *_ in ROWS for w in p.split()] + ["x", "y"]
    texts = CASES + [" ".join(rng.choices(vocab, k=rng.randrange(1, 60))) for _ in range(200)]
    found = scores(spark, texts, phrase_table(spark, ROWS))
    cleaned = [t if t not in ("Very, GOOD! not-bad",) else "very good not bad" for t in texts]
    assert found == {i: plain(t) for i, t in enumerate(cleaned)}


def test_repeats_of_a_text_change_nothing(spark):
    phrases = phrase_table(spark, ROWS)
    posts = spark.createDataFrame([("a", "not very good news")] * 5 + [("b", "bad")], "k string, text string")
    found = {r.k: (r.polarity, r.subjectivity) for r in score_in_context(posts.repartition(4), phrases, ["k"]).collect()}
    assert found == {"a": plain("not very good news"), "b": plain("bad")}


def test_negation_turns_and_intensity_raises(spark):
    found = scores(spark, ["good", "not good", "very good", "fake news", "hate"], default_phrases(spark))
    assert found[1][0] < 0 < found[0][0] < found[2][0]
    assert found[3] == (-0.6, 0.7)


def test_no_posts(spark):
    assert scores(spark, [], phrase_table(spark, ROWS), 1) == {}
