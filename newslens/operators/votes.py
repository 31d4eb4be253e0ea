"""Accuracy, majority vote and verdict over predictions in long form (link, model, prediction)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens import constants as C


def model_accuracy(predictions: DataFrame) -> DataFrame:
    """(model, accuracy): the share of rows whose prediction equals their label; null is wrong."""
    hit = F.coalesce((F.col("prediction") == F.col("label")).cast("double"), F.lit(0.0))
    return predictions.groupBy("model").agg(F.avg(hit).alias("accuracy"))


def _credibility(fake: Column, real: Column) -> Column:
    """fake only if it has more votes; ties and other labels give real."""
    return F.when(fake > real, C.FAKE).otherwise(C.REAL)


def _vote_counts() -> list[Column]:
    return [
        F.count_if(F.col("prediction") == C.FAKE).alias("fake_votes"),
        F.count_if(F.col("prediction") == C.REAL).alias("real_votes"),
    ]


def majority_vote(predictions: DataFrame) -> DataFrame:
    """(link, credibility, fake_votes, real_votes)."""
    return (
        predictions.groupBy("link")
        .agg(*_vote_counts())
        .withColumn("credibility", _credibility(F.col("fake_votes"), F.col("real_votes")))
    )


def accuracy_map(accuracy: Mapping[str, float]) -> Column:
    """The reported accuracies as a map column, under their names in the accuracy map."""
    entries = [
        part
        for model in C.VOTERS
        if model in accuracy and model not in C.UNREPORTED
        for part in (F.lit(C.ACCURACY_KEY[model]), F.lit(float(accuracy[model])))
    ]
    empty = F.create_map().cast("map<string,double>")
    return F.create_map(*entries) if entries else empty


def verdict(predictions: DataFrame, accuracy: Mapping[str, float] | None = None) -> DataFrame:
    """(link, credibility, fake_votes, real_votes, model_result, accuracy).

    All seven models vote; six are reported. A link's results are one conditional maximum per
    model, so rows of a link meet as partial aggregates, never as a list.
    """
    reported = [m for m in C.VOTERS if m not in C.UNREPORTED]
    of_model = [
        F.max(F.when(F.col("model") == m, F.col("prediction"))).alias(f"_{m}") for m in reported
    ]
    entries = [part for m in reported for part in (F.lit(m), F.col(f"_{m}"))]
    return (
        predictions.groupBy("link")
        .agg(*_vote_counts(), *of_model)
        .select(
            "link",
            _credibility(F.col("fake_votes"), F.col("real_votes")).alias("credibility"),
            "fake_votes",
            "real_votes",
            F.create_map(*entries).alias("model_result"),
            accuracy_map(accuracy or {}).alias("accuracy"),
        )
    )


def verdict_of_row(
    results: DataFrame, accuracy: Mapping[str, float], column: str = "predictions"
) -> DataFrame:
    """The same verdict where a row holds all votes of its link in a map: nothing is shuffled."""
    votes = F.map_values(column)
    fake = F.size(F.filter(votes, lambda v: v == C.FAKE)).cast("bigint")
    real = F.size(F.filter(votes, lambda v: v == C.REAL)).cast("bigint")
    shown = F.map_filter(F.col(column), lambda model, _: ~model.isin(*C.UNREPORTED))
    return results.select(
        "link",
        _credibility(fake, real).alias("credibility"),
        fake.alias("fake_votes"),
        real.alias("real_votes"),
        shown.alias("model_result"),
        accuracy_map(accuracy).alias("accuracy"),
    )
