"""Labelled vectors to seven fitted models and their hold-out accuracy."""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    NaiveBayes,
    NaiveBayesModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens import constants as C
from newslens.operators.boosting import BoostedTrees, Settings, fit_boosted
from newslens.operators.forest import ForestParts, fit_parts, trees_at_once
from newslens.operators.labels import label_features
from newslens.operators.linear_sgd import LinearModel, fit_linear
from newslens.operators.nearest import NearestNeighbour, fit_nearest
from newslens.operators.sampling import cap_rows, stratified_split
from newslens.operators.votes import model_accuracy
from newslens.plans.features import assemble
from newslens.session import enable_checkpoints, written

# Trees grow until pure, as far as Spark allows; at most one leaf for each training row.
_MAX_DEPTH = 30
_MAX_BINS = 128
# Partitions of the training rows follow from their number alone: by a hash of the link and in its order, as
# bagging draws per partition.
_TRAIN_PARTITIONS = 4
_PARTITION_ROWS = 20_000
_BOOSTED = Settings(rounds=100, depth=6, rate=0.3, penalty=1.0)


def _estimators(rows: int) -> dict[str, Estimator]:
    """Estimator per voter; nearest neighbour, boosted trees and the stochastic linear model are fitted apart."""
    common = {"featuresCol": "vector", "labelCol": "index"}
    tree = {"maxBins": _MAX_BINS, "seed": C.SEED, "cacheNodeIds": True, "checkpointInterval": 10}
    return {
        # L2 with C = 1: the penalty is shared out over the rows, as the loss is a mean.
        "lr": LogisticRegression(
            regParam=1.0 / max(1, rows), elasticNetParam=0.0, standardization=False, **common
        ),
        "decisionTree": DecisionTreeClassifier(maxDepth=_MAX_DEPTH, **tree, **common),
        "randomForest": RandomForestClassifier(
            numTrees=C.FOREST_TREES,
            bootstrap=True,
            featureSubsetStrategy="sqrt",
            maxDepth=_MAX_DEPTH,
            **tree,
            **common,
        ),
        "naiveBayes": NaiveBayes(modelType="gaussian", **common),
    }


_MODEL_CLASSES = {
    kind.__name__: kind
    for kind in (
        DecisionTreeClassificationModel,
        LogisticRegressionModel,
        NaiveBayesModel,
        RandomForestClassificationModel,
    )
}


@dataclass
class ModelSet:
    """Fitted models by voter name, the labels they predict, and their hold-out accuracy."""

    labels: list[str]
    fitted: dict[str, Model | NearestNeighbour | BoostedTrees | LinearModel | ForestParts]
    accuracy: dict[str, float] = field(default_factory=dict)

    def save(self, path: str) -> None:
        """Into a folder that holds no model set yet; an existing one raises."""
        spark = SparkSession.active()
        kinds = {name: type(model).__name__ for name, model in self.fitted.items()}
        parts = {name: len(model.paths) for name, model in self.fitted.items() if isinstance(model, ForestParts)}
        facts = {"labels": self.labels, "models": kinds, "accuracy": self.accuracy, "parts": parts}
        text = spark.range(0, 1, 1, 1).select(F.lit(json.dumps(facts)).alias("value"))
        text.write.text(f"{path}/facts")
        for name, model in self.fitted.items():
            if isinstance(model, NearestNeighbour):
                model.train.write.parquet(f"{path}/{name}")
            elif isinstance(model, BoostedTrees | LinearModel):
                model.save(spark, f"{path}/{name}")
            elif isinstance(model, ForestParts):
                model.save(f"{path}/{name}")
            else:
                model.write().save(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ModelSet:
        facts = json.loads(spark.read.text(f"{path}/facts").first().value)
        fitted = {}
        for name, kind in facts["models"].items():
            if kind == NearestNeighbour.__name__:
                fitted[name] = NearestNeighbour(spark.read.parquet(f"{path}/{name}"))
            elif kind == BoostedTrees.__name__:
                fitted[name] = BoostedTrees.load(spark, f"{path}/{name}", facts["labels"])
            elif kind == LinearModel.__name__:
                fitted[name] = LinearModel.load(spark, f"{path}/{name}", facts["labels"])
            elif kind == ForestParts.__name__:
                fitted[name] = ForestParts.load(f"{path}/{name}", facts["labels"], facts["parts"][name])
            else:
                fitted[name] = _MODEL_CLASSES[kind].load(f"{path}/{name}")
        return cls(facts["labels"], fitted, facts["accuracy"])


def with_vector(df: DataFrame) -> DataFrame:
    """Adds `vector`, the form Spark ML takes, beside the integer array `features`."""
    return df.withColumn("vector", array_to_vector(F.col("features").cast("array<double>")))


def fit_models(
    train: DataFrame,
    voters: Iterable[str] = C.VOTERS,
    parallelism: int = 4,
) -> ModelSet:
    """Fits each voter on (link, label, features), on all labelled rows that have a vector.

    Every fit passes over its rows many times, so they are written to the shared
    folder once, as vectors; fits run side by side, as each alone leaves executors idle between its
    steps. Trees grow until pure and the driver holds those that it grows, so a forest of many rows is grown in parts.
    """
    voters = list(voters)
    spark = train.sparkSession
    enable_checkpoints(spark)
    usable = train.where(F.col("label").isNotNull() & F.col("features").isNotNull())
    known = written(with_vector(usable), "training")
    count = known.count()
    partitions = max(_TRAIN_PARTITIONS, -(-count // _PARTITION_ROWS))
    known = known.repartition(partitions, "link").sortWithinPartitions("link")
    indexer = StringIndexer(
        inputCol="label", outputCol="index", stringOrderType="alphabetAsc"
    ).fit(known)
    rows = indexer.transform(known)
    estimators = _estimators(count)

    def fit(name: str):
        if name == "knn":
            return fit_nearest(known, key="link")
        if name == "xgb":
            return fit_boosted(known, _BOOSTED)
        if name == "sgd":
            return fit_linear(known)
        if name == "randomForest" and trees_at_once(count) < C.FOREST_TREES:
            return fit_parts(estimators[name], rows, list(indexer.labels), trees_at_once(count))
        model = estimators[name].fit(rows)
        for output in ("rawPredictionCol", "probabilityCol"):
            if model.hasParam(output):
                model.set(model.getParam(output), "")
        return model.setPredictionCol(f"_{name}")

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        jobs = {name: pool.submit(inheritable_thread_target(spark)(fit), name) for name in voters}
        fitted = {name: job.result() for name, job in jobs.items()}
    return ModelSet(list(indexer.labels), fitted)


def predict_wide(models: ModelSet, df: DataFrame) -> DataFrame:
    """`df`, which has `link` and `features`, with `predictions`: a map from voter to label.

    All models work on a row in one pass; the input is read once, not once per model.
    """
    names = F.array(*[F.lit(label) for label in models.labels])
    kept = df.columns
    # A nearest-neighbour table too large for the workers answers by joins, a large forest part by part.
    apart = {
        f"_{n}": m for n, m in models.fitted.items()
        if isinstance(m, ForestParts) or isinstance(m, NearestNeighbour) and not m.is_table()
    }
    for name, model in apart.items():
        df = model.predict(df, name)
    # Models that work in Python share one step, and so one worker of a task.
    python = {
        f"_{n}": m.prediction(df.sparkSession)
        for n, m in models.fitted.items() if isinstance(m, NearestNeighbour | BoostedTrees) and f"_{n}" not in apart
    }
    out = with_vector(df.withColumns(python))
    votes = []
    for name, model in models.fitted.items():
        if f"_{name}" in python or f"_{name}" in apart:
            vote = F.col(f"_{name}")
        elif isinstance(model, LinearModel):
            out = model.predict(out, f"_{name}")
            vote = F.col(f"_{name}")
        else:
            out = model.transform(out).drop("rawPrediction")
            vote = F.element_at(names, F.col(f"_{name}").cast("int") + 1)
        votes += [F.lit(name), vote]
    return out.select(*kept, F.create_map(*votes).alias("predictions"))


def predict_all(models: ModelSet, df: DataFrame) -> DataFrame:
    """(link, model, prediction), and label where `df` has one: one row per model."""
    kept = [c for c in ("link", "label") if c in df.columns]
    # A plain explode would have Spark ask first whether the map is empty, and so have every model work twice.
    exploded = F.explode_outer("predictions") if models.fitted else F.explode("predictions")
    return predict_wide(models, df).select(*kept, exploded.alias("model", "prediction"))


def accuracy_table(models: ModelSet, test: DataFrame) -> DataFrame:
    """(model, accuracy, reported): the share of right predictions; one model is not reported."""
    return model_accuracy(predict_all(models, test)).withColumn(
        "reported", ~F.col("model").isin(*C.UNREPORTED)
    )


def training_set(
    features: DataFrame, labels: DataFrame, cap: int | None = None
) -> DataFrame:
    """(link, label, features, is_test), written to the shared folder; unlabelled rows dropped.

    All rows, unless the caller asks for the first `cap` in hash order.
    """
    labelled = written(label_features(assemble(features), labels), "labelled")
    if cap is not None:
        labelled = cap_rows(labelled, cap)
    return stratified_split(labelled)


def train_models(
    features: DataFrame,
    labels: DataFrame,
    voters: Iterable[str] = C.VOTERS,
    cap: int | None = None,
    parallelism: int = 4,
) -> ModelSet:
    """Split, fit and measure: the model set that scoring needs."""
    rows = training_set(features, labels, cap)
    models = fit_models(rows.where(~F.col("is_test")), voters, parallelism)
    table = accuracy_table(models, rows.where("is_test"))
    models.accuracy = {row.model: row.accuracy for row in table.collect()}  # one row per model
    return models
