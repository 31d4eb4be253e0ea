from __future__ import annotations

import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from newslens import constants as C
from newslens.functions.lexicon import lexicon_table
from newslens.operators import forest, nearest
from newslens.operators.boosting import Settings
from newslens.plans import scoring, training

QUICK = ("knn", "lr", "decisionTree", "naiveBayes", "sgd")


def made_features(spark, n=160):
    """Two classes that differ in where their histograms lie."""
    rng = random.Random(1)
    data, labels = [], []
    for i in range(n):
        fake = i % 3 == 0
        text = [rng.randrange(4) + (9 if fake and j < 3 else 0) for j in range(12)]
        user = [rng.randrange(4) + (0 if fake or j > 4 else 7) for j in range(23)]
        data.append((f"l{i}", text, rng.randrange(5), user))
        labels.append((f"l{i}", "fake" if fake else "real"))
    labels += [("l1", None), ("nowhere", "fake")]
    schema = "link string, textFeatures array<bigint>, retweets bigint, userFeatures array<bigint>"
    return (
        spark.createDataFrame(data, schema),
        spark.createDataFrame(labels, "news_url string, credibility string"),
    )


@pytest.fixture(scope="module")
def models(spark):
    return training.train_models(*made_features(spark), voters=QUICK)


def test_models_tell_the_classes_apart(models):
    assert models.labels == ["fake", "real"]
    assert set(models.accuracy) == set(QUICK)
    assert all(value > 0.85 for value in models.accuracy.values()), models.accuracy


def test_forest_and_boosting_parameters(spark):
    made = training._estimators(200)
    forest, boosted = made["randomForest"], training._BOOSTED
    assert forest.getNumTrees() == 100 and forest.getFeatureSubsetStrategy() == "sqrt"
    assert (boosted.rounds, boosted.depth, boosted.rate, boosted.penalty) == (100, 6, 0.3, 1.0)
    assert made["lr"].getRegParam() == 1 / 200


def test_forest_fits_and_is_repeatable(spark):
    features, labels = made_features(spark, 90)
    rows = training.training_set(features, labels)
    train, test = rows.where(~F.col("is_test")), rows.where("is_test")
    found = []
    for _ in range(2):
        forest = training.fit_models(train, ["randomForest"])
        found.append(sorted(training.predict_all(forest, test).collect()))
    assert found[0] == found[1]
    assert sum(r.label == r.prediction for r in found[0]) / len(found[0]) > 0.85


def test_save_and_load(spark, tmp_path, models):
    features, _ = made_features(spark)
    vectors = training.assemble(features)
    models.save(str(tmp_path / "models"))
    again = training.ModelSet.load(spark, str(tmp_path / "models"))
    assert again.labels == models.labels and again.accuracy == models.accuracy
    before = sorted(training.predict_all(models, vectors).collect())
    assert sorted(training.predict_all(again, vectors).collect()) == before
    assert len(before) == 160 * len(QUICK)


def test_a_folder_with_models_is_not_overwritten(tmp_path, models):
    path = str(tmp_path / "models")
    models.save(path)
    with pytest.raises(Exception, match="(?i)exists"):
        models.save(path)


def test_three_labels_with_every_voter_but_the_forest(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(training, "_BOOSTED", Settings(rounds=3))
    data = [(f"l{i}", f"c{i % 3}", [40 * (i % 3 == j % 3) + (i * (j + 1)) % 5 for j in range(6)]) for i in range(150)]
    df = spark.createDataFrame(data, "link string, label string, features array<bigint>")
    voters = [v for v in C.VOTERS if v != "randomForest"]
    fitted = training.fit_models(df, voters)
    fitted.save(str(tmp_path / "models"))
    again = training.ModelSet.load(spark, str(tmp_path / "models"))
    for models in (fitted, again):
        found = training.predict_all(models, df).collect()
        assert len(found) == 150 * 6 and all(r.label == r.prediction for r in found)


def test_accuracy_table_flags_the_unreported_model(spark, models):
    features, labels = made_features(spark)
    rows = training.training_set(features, labels)
    table = training.accuracy_table(models, rows).collect()
    assert {r.model: r.reported for r in table} == {m: m != "sgd" for m in QUICK}


def test_every_labelled_row_is_learned_from(spark):
    n = C.TRAINING_CAP + 500
    features = F.array(*[F.floor(F.col("id") / 10**j) % 10 for j in range(5)])
    label = F.when(F.col("id") % 4 == 0, "fake").otherwise("real")
    rows = spark.range(n).select(F.concat(F.lit("l"), "id").alias("link"), label.alias("label"), features.alias("features"))
    models = training.fit_models(rows, ["knn", "naiveBayes"])
    assert models.fitted["knn"].train.count() == n
    means = rows.groupBy("label").agg(F.avg(F.col("features")[3]).alias("mean")).orderBy("label").collect()
    assert models.fitted["naiveBayes"].theta.toArray()[:, 3] == pytest.approx([r["mean"] for r in means], abs=1e-12)


def test_large_tables_vote_as_small_ones(spark, models, monkeypatch):
    features, _ = made_features(spark)
    vectors = training.assemble(features)
    before = sorted(training.predict_all(models, vectors).collect())
    monkeypatch.setattr(nearest, "TABLE_ROWS", 10)
    assert sorted(training.predict_all(models, vectors).collect()) == before


def test_a_forest_of_many_rows_is_grown_in_parts(spark, monkeypatch, tmp_path):
    features, labels = made_features(spark, 90)
    rows = training.training_set(features, labels)
    train, test = rows.where(~F.col("is_test")), rows.where("is_test")
    monkeypatch.setattr(forest, "WHOLE_ROWS", 10)
    monkeypatch.setattr(forest, "PART_ROWS", 40 * train.count())
    fitted = training.fit_models(train, ["naiveBayes", "randomForest"])
    parts = [forest.RandomForestClassificationModel.load(p) for p in fitted.fitted["randomForest"].paths]
    # Small trees: all that are left are grown with the second part.
    assert [p.getNumTrees for p in parts] == [40, 60]
    assert len({t.toDebugString for p in parts for t in p.trees}) > 60
    fitted.save(str(tmp_path / "models"))
    again = training.ModelSet.load(spark, str(tmp_path / "models"))
    found = sorted(training.predict_all(fitted, test).collect())
    assert sorted(training.predict_all(again, test).collect()) == found
    assert sum(r.label == r.prediction for r in found) / len(found) > 0.85
    # The label of most votes over all trees.
    vector = training.with_vector(test).select("link", "vector").collect()
    votes = {r.link: sum(p.predictRaw(r.vector).toArray() for p in parts) for r in vector}
    assert {r.link: fitted.labels[votes[r.link].argmax()] for r in found} == {r.link: r.prediction for r in found if r.model == "randomForest"}


def test_training_cap(spark):
    features, labels = made_features(spark)
    assert training.training_set(features, labels, cap=50).count() == 50


def test_score_links(spark, models):
    posts = spark.createDataFrame(
        [("a", "1", "good", 2), ("b", "1", "bad", 1), ("c", "9", "good", 1)],
        "link string, tweet_id string, text string, retweets int",
    )
    users = spark.createDataFrame(
        [("1", 5, 1, 10, True, 4)],
        "tweetid string, followers_count int, friends_count int, account_age int, "
        "verified boolean, statuses_count int",
    )
    lexicon = lexicon_table(spark, [("good", 50, 60), ("bad", -50, 60)])
    got = {r.link: r for r in scoring.score_links(posts, users, lexicon, models).collect()}
    assert set(got) == {"a", "b"}
    for r in got.values():
        assert r.fake_votes + r.real_votes == len(QUICK)
        assert r.credibility == ("fake" if r.fake_votes > r.real_votes else "real")
        assert "sgd" not in r.model_result and set(r.accuracy) == {
            C.ACCURACY_KEY[m] for m in QUICK if m != "sgd"
        }
    only = spark.createDataFrame([("b",)], "link string")
    one = scoring.score_links(posts, users, lexicon, models, only).collect()
    assert [r.link for r in one] == ["b"]
    none = spark.createDataFrame([("zz",)], "link string")
    assert scoring.score_links(posts, users, lexicon, models, none).collect() == []


def test_python_voters_share_a_worker(spark, monkeypatch):
    """One step of a task, and so one Python process, however many models work there; rows are those of each alone."""
    monkeypatch.setattr(training, "_BOOSTED", Settings(rounds=3))
    data = [(f"l{i}", f"c{i % 2}", [9 * (i % 2) + (i * (j + 1)) % 12 for j in range(6)]) for i in range(120)]
    df = spark.createDataFrame(data, "link string, label string, features array<bigint>")
    models = training.fit_models(df, ["knn", "xgb", "naiveBayes"])
    both = training.predict_all(models, df)
    assert both._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    asked = df.unionByName(df.limit(1).withColumns({"link": F.lit("none"), "features": F.lit(None).cast("array<bigint>")}))
    found = {(r.link, r.model): r.prediction for r in training.predict_all(models, asked.where("link <> 'none'")).collect()}
    for name in ("knn", "xgb"):
        alone = {r.link: r.prediction for r in models.fitted[name].predict(asked).collect()}
        assert alone.pop("none") is None
        assert alone == {link: label for (link, model), label in found.items() if model == name}


def test_vectors_at_hand_are_not_made_again(spark, models):
    """Verdicts from given vectors are those from the posts, of which nothing is read then."""
    lexicon = lexicon_table(spark, [("good", 50, 60), ("bad", -50, 60)])
    posts = spark.createDataFrame(
        [("a", "1", "good", 2), ("b", "1", "bad", 1)], "link string, tweet_id string, text string, retweets int"
    )
    users = spark.createDataFrame(
        [("1", 5, 1, 10, True, 4)],
        "tweetid string, followers_count int, friends_count int, account_age int, verified boolean, statuses_count int",
    )
    made = scoring.score_links(posts, users, lexicon, models)
    vectors = training.assemble(scoring.link_features(posts, users, lexicon)).localCheckpoint()
    given = scoring.score_links(posts, users, lexicon, models, vectors=vectors)
    assert sorted(given.collect()) == sorted(made.collect()) and made.count() == 2
    assert "tweet_id" not in given._jdf.queryExecution().optimizedPlan().toString()


def test_workers_find_the_package_from_any_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from newslens.operators.nearest import fit_nearest
from newslens.session import local_session
spark = local_session(2)
train = spark.createDataFrame([(1, [0.0], "a"), (2, [9.0], "b")], "id long, features array<double>, label string")
asked = spark.createDataFrame([([8.0],), ([1.0],)], "features array<double>")
print([r.prediction for r in fit_nearest(train).predict(asked).collect()])
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_CONNECT_MODE_ENABLED")}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120
    )
    assert "['b', 'a']" in done.stdout, done.stderr[-2000:]
