"""Recall of the hashed search against the exact one, and its odd rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newslens import queries as Q
from newslens.operators import near_hash as N


def _found(spark, rows, queries, **options):
    index = N.fit_hashed(spark.createDataFrame(rows, "id long, label string, features array<double>"), **options)
    asked = spark.createDataFrame(queries, "q long, features array<double>")
    return {r.q: r.prediction for r in index.predict(asked, "q").collect()}


def _nearest(rows, queries):
    vectors = np.array([r[2] for r in rows])
    return {q: rows[int(((vectors - np.array(v)) ** 2).sum(axis=1).argmin())][1] for q, v in queries}


@pytest.mark.parametrize("bucket_rows", [4096, 40])
def test_recall(spark, bucket_rows):
    """Labels are the ids, so a label is right only for the very nearest row. With small buckets most are dealt on."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 16))
    vectors = (centres[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 16))).round(4)
    rows = [(i, str(i), v.tolist()) for i, v in enumerate(vectors)]
    queries = [(i, (v + 0.05 * rng.normal(size=16)).tolist()) for i, v in enumerate(vectors[::20])]
    found, truth = _found(spark, rows, queries, bucket_rows=bucket_rows), _nearest(rows, queries)
    assert set(found) == set(truth)
    recall = sum(found[q] == truth[q] for q in truth) / len(truth)
    assert recall >= 0.9, recall


def test_recall_on_the_table(spark):
    """Of the distinct nearest rows of sf0.01's embeddings, at least nine in ten are found."""
    sf_dir = "/root/testdata/sf0.01"
    rows = Q._embeddings(spark, sf_dir).withColumn("label", F.col("vec_id").cast("string")).drop("vec_id")
    train = [(int(r.label), r.label, r.features) for r in rows.where("NOT is_test").collect()]
    asked = [(int(r.label), r.features) for r in rows.where("is_test").collect()]
    found, truth = _found(spark, train, asked), _nearest(train, asked)
    recall = sum(found[q] == truth[q] for q in truth) / len(truth)
    print("recall", recall, len(truth))
    assert recall >= 0.9, recall


def test_odd_rows(spark):
    rows = [(2, "b", [0.0, 0.0]), (1, "a", [0.0, 0.0]), (3, "c", [9.0, 9.0]), (4, "d", None)]
    queries = [(1, [0.1, 0.0]), (2, [1e6, 1e6]), (3, None), (4, [9.0, 9.1]), (4, [9.0, 9.1])]
    assert _found(spark, rows, queries) == {1: "a", 2: "c", 3: None, 4: "c"}
    assert _found(spark, [], queries) == {1: None, 2: None, 3: None, 4: None}
    assert _found(spark, rows, []) == {}


def test_cut_buckets_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(600, 8)).round(2)
    rows = [(i, str(i), v.tolist()) for i, v in enumerate(vectors)]
    queries = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    whole = _found(spark, rows, queries)
    monkeypatch.setattr(N, "BLOCK_ROWS", 50)
    monkeypatch.setattr(N, "BLOCK_QUERIES", 7)
    assert _found(spark, rows, queries) == whole


def test_pairs_do_not_leave_their_place():
    """Of all rows that meet a query in a block only the nearest goes on, of equal ones that of least id."""
    names = ["table", "bucket", "row_block", "query_block", "asks", "id", "label", "features", "query"]
    rows = [(0, 7, 0, 0, False, float(i), str(i), np.array([i // 2, 0.0]), None) for i in range(200)]
    asked = [(0, 7, 0, 0, True, None, None, np.array([i, 0.2]), float(i)) for i in range(50)]
    alone = [(0, 8, 0, 0, True, None, None, np.array([1.0, 0.0]), 99.0)]
    every = pd.DataFrame(rows + asked + alone, columns=names)
    found = pd.concat(N._meet(iter([every[:90], every[90:220], every[220:]])))
    assert list(found["query"]) == list(range(50)) and list(found["id"]) == [2 * i for i in range(50)]
