"""Boosted trees against a plain version, and on odd tables."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from newslens.operators import boosting
from newslens.operators.boosting import BoostedTrees, Settings, fit_boosted
from newslens.plans import training

SCHEMA = "label string, features array<double>"


def plain_margins(rows, targets, asked, settings):
    """Margins of `asked` after boosting on `rows`: every cut tried, one node at a time."""
    own, out = [0.0] * len(rows), [0.0] * len(asked)
    for _ in range(settings.rounds):
        p = [1 / (1 + math.exp(-m)) for m in own]
        g = [a - y for a, y in zip(p, targets, strict=True)]
        h = [a * (1 - a) for a in p]

        def weight(ids, of):
            return sum(of[i] for i in ids)

        def split(ids, others, depth):
            total_g, total_h = weight(ids, g), weight(ids, h)
            best = (settings.min_gain, None)
            for f in range(len(rows[0])) if depth else ():
                for cut in sorted({row[f] for row in rows})[:-1]:
                    low = [i for i in ids if rows[i][f] <= cut]
                    low_g, low_h = weight(low, g), weight(low, h)
                    if min(low_h, total_h - low_h) < settings.min_curvature:
                        continue
                    gain = (
                        low_g**2 / (low_h + settings.penalty)
                        + (total_g - low_g) ** 2 / (total_h - low_h + settings.penalty)
                        - total_g**2 / (total_h + settings.penalty)
                    )
                    if gain > best[0]:
                        best = (gain, (f, cut))
            if best[1] is None:
                value = -settings.rate * total_g / (total_h + settings.penalty)
                for i in ids:
                    own[i] += value
                for i in others:
                    out[i] += value
                return
            f, cut = best[1]
            split([i for i in ids if rows[i][f] <= cut], [i for i in others if asked[i][f] <= cut], depth - 1)
            split([i for i in ids if rows[i][f] > cut], [i for i in others if asked[i][f] > cut], depth - 1)

        split(list(range(len(rows))), list(range(len(asked))), settings.depth)
    return out


def test_margins_equal_the_plain_ones(spark):
    rng = random.Random(4)
    rows = [[float(rng.randrange(9)), rng.randrange(50) / 7, float(rng.randrange(3))] for _ in range(160)]
    targets = [int((x[0] > 4) != (x[1] > 3) if rng.random() < 0.8 else x[2] > 1) for x in rows]
    settings = Settings(rounds=6, depth=3)
    data = [("b" if y else "a", x) for x, y in zip(rows, targets, strict=True)]
    model = fit_boosted(spark.createDataFrame(data, SCHEMA).repartition(5), settings)
    asked = [[rng.uniform(-1, 10), rng.uniform(-1, 8), rng.uniform(-1, 3)] for _ in range(80)] + rows
    assert len(model.trees) == settings.rounds
    got = model.margins(np.array(asked))[:, 0]
    assert got == pytest.approx(plain_margins(rows, targets, asked, settings), abs=1e-4)


def test_partitions_do_not_change_the_trees(spark):
    rng = random.Random(8)
    data = [(rng.choice("ab"), [float(rng.randrange(20)) for _ in range(4)]) for _ in range(300)]
    df = spark.createDataFrame(data, SCHEMA)
    made = [fit_boosted(df.repartition(n), Settings(rounds=5)) for n in (1, 6)]
    assert made[0] == made[1]


def test_three_labels_on_a_board_that_no_plane_divides(spark, tmp_path):
    data = [("abc"[(x + 2 * y) % 3], [float(x), float(y)]) for x in range(6) for y in range(5) for _ in range(6)]
    df = spark.createDataFrame(data, SCHEMA)
    model = fit_boosted(df, Settings(rounds=12))
    rows = model.predict(df).collect()
    assert sum(r.label == r.prediction for r in rows) == len(rows)
    model.save(spark, str(tmp_path / "trees"))
    assert BoostedTrees.load(spark, str(tmp_path / "trees"), model.labels) == model


def test_odd_tables(spark):
    rows = [("a", [1.0]), (None, [2.0]), ("b", None), ("a", [3.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    one = fit_boosted(df)
    assert [r.prediction for r in one.predict(df).collect()] == ["a", "a", None, "a"]
    none = fit_boosted(df.limit(0))
    assert {r.prediction for r in none.predict(df).collect()} == {None}
    flat = spark.createDataFrame([("a", [1.0])] * 10 + [("b", [1.0])] * 30, SCHEMA)
    model = fit_boosted(flat, Settings(rounds=4))
    assert {len(tree.value) for made in model.trees for tree in made} == {1}
    assert {r.prediction for r in model.predict(flat).collect()} == {"b"}


def test_voter_is_learnt_saved_and_loaded_with_the_others(spark, tmp_path):
    data = [(f"l{i}", "fake" if (i % 6 < 2) != (i // 6 % 6 < 4) else "real", [i % 6, i // 6 % 6]) for i in range(216)]
    rows = spark.createDataFrame(data, "link string, label string, features array<bigint>")
    models = training.fit_models(rows, ("xgb",))
    models.save(str(tmp_path / "set"))
    loaded = training.ModelSet.load(spark, str(tmp_path / "set"))
    found = training.predict_all(loaded, rows).collect()
    assert len(found) == len(data) and all(r.label == r.prediction for r in found)


def test_a_pass_follows_only_the_trees_that_are_new(monkeypatch):
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 9, (60, 3)).astype(np.uint8)
    targets = (rows[:, 0] > rng.integers(0, 9, 60)).astype(int)
    followed, leaves = [], boosting.Tree.leaves

    def counted(tree, values):
        followed.append(len(followed))
        return leaves(tree, values)

    def passes(name):
        return lambda done, growing, nodes: boosting._sums((name(), rows, targets), done, growing, nodes, 9)

    settings = Settings(rounds=12, depth=2, min_curvature=0.1)
    names = iter(map(str, range(10_000)))
    plain = boosting.grow(passes(lambda: "never met " + next(names)), 1, settings)
    monkeypatch.setattr(boosting.Tree, "leaves", counted)
    kept = boosting.grow(passes(lambda: "one"), 1, settings)
    assert kept == plain and len(kept) == 12
    # A growing tree once a level, a finished one once in all; before, every finished one in every pass.
    assert len(followed) <= 12 * 2 + 12
    monkeypatch.setattr(boosting, "_AT_HAND_BYTES", 0)
    assert boosting.grow(passes(lambda: "two"), 1, settings) == plain and not boosting._at_hand
