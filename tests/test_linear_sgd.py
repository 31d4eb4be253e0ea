"""Descent on the hinge: against a solver's optimum on overlapping classes, and on odd tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from newslens.operators import linear_sgd
from newslens.operators.linear_sgd import LinearModel, fit_linear

SCHEMA = "label string, features array<double>"


def overlapping(n=800, width=6, seed=5):
    """Classes that overlap, on features whose scales differ a hundredfold."""
    rng = np.random.default_rng(seed)
    sides = np.where(rng.random(n) < 0.4, 1.0, -1.0)
    values = rng.normal(size=(n, width)) + 0.6 * sides[:, None] * (np.arange(width) % 2 == 0)
    values = np.rint(values * 10.0 ** np.linspace(1, 3, width)) + 50
    return sides, values


def objective(weights, bias, sides, values):
    return np.maximum(0, 1 - sides * (values @ weights + bias)).mean() + 1e-4 / 2 * weights @ weights


def as_rows(sides, values):
    return [("real" if s > 0 else "fake", list(map(float, v))) for s, v in zip(sides, values)]


def test_objective_within_a_hundredth_of_the_solver(spark):
    sides, values = overlapping()
    df = spark.createDataFrame(as_rows(sides, values), SCHEMA)
    model = fit_linear(df)
    vectors = df.select(array_to_vector("features").alias("features"), (F.col("label") == "real").cast("double").alias("label"))
    solved = LinearSVC(regParam=1e-4, standardization=True, maxIter=40).fit(vectors)
    own = objective(model.weights[0], model.bias[0], sides, values)
    other = objective(solved.coefficients.toArray(), solved.intercept, sides, values)
    assert own <= 1.01 * other, (own, other)
    assert 0.2 < own < 0.7  # the classes do overlap


def test_result_does_not_depend_on_how_rows_are_stored(spark, monkeypatch):
    monkeypatch.setattr(linear_sgd, "_BLOCK_ROWS", 200)
    rows = as_rows(*overlapping(600))
    short = linear_sgd.Settings(epochs=5)
    a = fit_linear(spark.createDataFrame(rows, SCHEMA).repartition(1), short)
    b = fit_linear(spark.createDataFrame(rows[::-1], SCHEMA).repartition(7), short)
    assert np.allclose(a.weights, b.weights, rtol=1e-9, atol=0) and np.allclose(a.bias, b.bias)


def test_copies_weigh_as_many_rows(spark, monkeypatch):
    """A third of the rows is one row over and over; several blocks."""
    monkeypatch.setattr(linear_sgd, "_BLOCK_ROWS", 300)
    sides, values = overlapping(900)
    sides, values = np.append(sides, np.ones(450)), np.vstack([values, np.repeat(values[:1], 450, axis=0)])
    model = fit_linear(spark.createDataFrame(as_rows(sides, values), SCHEMA))
    vectors = spark.createDataFrame(as_rows(sides, values), SCHEMA).select(
        array_to_vector("features").alias("features"), (F.col("label") == "real").cast("double").alias("label"))
    solved = LinearSVC(regParam=1e-4, standardization=True, maxIter=40).fit(vectors)
    other = objective(solved.coefficients.toArray(), solved.intercept, sides, values)
    assert objective(model.weights[0], model.bias[0], sides, values) <= 1.02 * other


def test_three_labels_save_and_load(spark, tmp_path):
    rows = [(f"c{i % 3}", [40.0 * (i % 3 == j % 3) + (i * (j + 1)) % 5 for j in range(6)]) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = fit_linear(df)
    model.save(spark, str(tmp_path / "model"))
    again = LinearModel.load(spark, str(tmp_path / "model"), model.labels)
    for one in (model, again):
        assert all(r.label == r.prediction for r in one.predict(df).collect())


@pytest.mark.parametrize("rows, expected", [
    ([], [None, None]),
    ([("a", [1.0, 2.0]), (None, [3.0, 1.0]), ("b", None)], ["a", None]),
    ([("a", [1.0, 7.0]), ("b", [5.0, 7.0]), ("b", [5.0, 7.0])], ["b", None]),
])
def test_odd_tables(spark, rows, expected):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS times", "2 AS place")
    asked = spark.createDataFrame([(0, [6.0, 7.0]), (1, None)], "id int, features array<double>")
    found = fit_linear(df).predict(asked).orderBy("id").collect()
    assert [r.prediction for r in found] == expected
