"""Linear classifier by averaged mini-batch descent on the hinge loss.

Equal rows are counted before they move, so a group of copies is one row with a weight. Tasks hold blocks of
distinct rows; in an epoch each starts from the same weights, takes the same number of steps on batches that it
draws in proportion to the rows' weights, and hands back the mean of where it has been. The driver mixes these
means by the blocks' weights, holds nothing but the models, and measures each mean of epochs over all rows in
the pass that follows. The one with the least objective is the model.

Steps are taken on centred values of unit spread, which makes one rate fit all features; the penalty and the
result are those of the values as given. More than two labels: one separator for each against the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.session import ship_package, written

_BLOCK_ROWS = 20_000
# A row of more than one in so many of a block is cut: at most _PIECES more rows a block.
_PIECES = 10
_MODEL_SCHEMA = "part int, bias double, weights array<double>"


@dataclass(frozen=True)
class Settings:
    penalty: float = 1e-4  # half of it times the squared weights, without the bias
    epochs: int = 80
    batch: int = 16
    steps: int = 200  # of every task in an epoch
    rate: float = 1.0
    patience: int = 12  # epochs without a gain of a thousandth
    seed: int = 3


@dataclass
class Block:
    values: np.ndarray  # rows by features, then a constant 1
    signs: np.ndarray  # rows by separators, -1 or 1
    weights: np.ndarray


def losses(block: Block, model: np.ndarray) -> np.ndarray:
    """Sum of the hinge of every separator over the rows of a block."""
    return block.weights @ np.maximum(0, 1 - block.signs * (block.values @ model.T))


def walk(block: Block, model: np.ndarray, shrink: np.ndarray, rate: float, settings: Settings, seed: list[int]) -> np.ndarray:
    """Mean of the models of one epoch's steps from `model`; `shrink` is the penalty of each value."""
    rng = np.random.default_rng(seed)
    ends = np.cumsum(block.weights)
    draws = np.searchsorted(ends, rng.random((settings.steps, settings.batch)) * ends[-1], "right")
    model, total = model.copy(), np.zeros_like(model)
    for drawn in np.minimum(draws, len(ends) - 1):
        values, signs = block.values[drawn], block.signs[drawn]
        wrong = signs * (signs * (values @ model.T) < 1)
        model = (model + rate / settings.batch * (wrong.T @ values)) / (1 + rate * shrink)
        total += model
    return total / settings.steps


def descend(epoch, separators: int, shrink: np.ndarray, settings: Settings) -> np.ndarray:
    """The best mean model, where `epoch(asked, start, rate, number)` gives (losses of `asked`, mean of walks).

    Losses are means over all rows. The mean of epochs starts anew whenever their number has doubled, so that the
    first steps are forgotten. Every separator keeps its own best.
    """
    current = np.zeros((separators, len(shrink)))
    asked, best = current, current.copy()
    least = np.full(separators, np.inf)
    still, summed, count, anew = 0, np.zeros_like(current), 0, 1
    for number in range(settings.epochs + 1):
        rate = settings.rate / len(shrink) / np.sqrt(1 + number)
        lost, current = epoch(asked, current, rate, number)
        objective = lost + (asked**2 @ shrink) / 2
        still = 0 if (objective < 0.999 * least).any() else still + 1
        better = objective < least
        best[better], least[better] = asked[better], objective[better]
        if still >= settings.patience:
            break
        if number + 1 >= 2 * anew:
            summed, count, anew = np.zeros_like(current), 0, number + 1
        summed, count = summed + current, count + 1
        asked = summed / count
    return best


@dataclass
class LinearModel:
    """Separators by label: one for two labels, which is positive for the second; else one for each."""

    labels: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """`df`, which has an array column `features`, with a label; null for a null vector or no labels.

        The label of the largest margin, the first of equals; of two, the second if the margin is positive.
        """
        if not self.labels:
            return df.withColumn(output, F.lit(None).cast("string"))
        there = F.col("features").isNotNull()
        if len(self.labels) == 1:
            return df.withColumn(output, F.when(there, F.lit(self.labels[0])))
        margins = [
            F.aggregate(
                F.zip_with(F.col("features").cast("array<double>"), F.array(*map(F.lit, row)), lambda x, w: x * w),
                F.lit(float(bias)), lambda total, x: total + x,
            )
            for row, bias in zip(self.weights.tolist(), self.bias.tolist(), strict=True)
        ]
        if len(self.labels) == 2:
            chosen = F.when(margins[0] > 0, self.labels[1]).otherwise(self.labels[0])
        else:
            made = F.array(*margins)
            chosen = F.element_at(F.array(*map(F.lit, self.labels)), F.array_position(made, F.array_max(made)).cast("int"))
        return df.withColumn(output, F.when(there, chosen))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, float(b), list(map(float, w))) for i, (b, w) in enumerate(zip(self.bias, self.weights, strict=True))]
        spark.createDataFrame(rows, _MODEL_SCHEMA).coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, labels: list[str]) -> LinearModel:
        # One row a separator.
        rows = spark.read.schema(_MODEL_SCHEMA).parquet(path).orderBy("part").collect()
        return cls(labels, np.array([row.weights for row in rows]), np.array([row.bias for row in rows]))


def fit_linear(train: DataFrame, settings: Settings | None = None) -> LinearModel:
    """A model of the rows (label, features) that have both; all vectors are of one length.

    Rows may be any number; equal ones are one row with their count. Without rows there are no labels and every
    prediction is null; with one label all rows get it. Draws depend on the rows alone, not on how they are stored.
    """
    settings = settings or Settings()
    spark = train.sparkSession
    ship_package(spark)
    rows = written(
        train.where(F.col("label").isNotNull() & F.col("features").isNotNull())
        .groupBy(F.col("label").cast("string").alias("label"), F.col("features").cast("array<double>").alias("features"))
        .agg(F.count("*").alias("times")),
        "linear",
    )
    facts = rows.groupBy("label").agg(  # one row a label
        F.max(F.size("features")).alias("width"), F.count("*").alias("rows"), F.sum("times").alias("times")
    ).collect()
    labels = sorted(row.label for row in facts)
    if len(labels) < 2:
        return LinearModel(labels, np.zeros((0, 0)), np.zeros(0))
    width, whole = max(row.width for row in facts), float(sum(row.times for row in facts))
    value = [F.col("features")[i] for i in range(width)]
    # Two passes: a difference of large sums would lose a small spread.
    means = rows.agg(*[F.sum(v * F.col("times")) / whole for v in value]).first()
    spreads = rows.agg(*[F.sum((v - m) ** 2 * F.col("times")) / whole for v, m in zip(value, means, strict=True)]).first()
    centre, spread = np.array(means), np.sqrt(np.array(spreads))
    spread[spread == 0] = 1.0
    shrink = np.append(settings.penalty / spread**2, 0.0)
    targets = labels[1:] if len(labels) == 2 else labels

    def block(part: pd.DataFrame) -> Block:
        # In one order, however the rows came.
        held = sorted((tuple(x), label, n) for x, label, n in zip(part["features"], part["label"], part["times"], strict=True))
        values = (np.array([x for x, _, _ in held]) - centre) / spread
        signs = np.array([[1.0 if label == target else -1.0 for target in targets] for _, label, _ in held])
        return Block(np.column_stack([values, np.ones(len(held))]), signs, np.array([float(n) for _, _, n in held]))

    tasks = -(-sum(row.rows for row in facts) // _BLOCK_ROWS)
    # The number of blocks follows from the rows, and a row's block from its values.
    # A row that would be much of its block is shared out over blocks, or their walks would lead apart.
    pieces = F.least(F.lit(tasks), F.ceil(F.col("times") * F.lit(_PIECES * tasks / whole))).cast("int")
    place = F.pmod(F.xxhash64("features", "label") + F.col("piece"), F.lit(tasks)).cast("int")
    dealt = (
        rows.withColumn("pieces", pieces)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("features", "label", (F.col("times") / F.col("pieces")).alias("times"), place.alias("place"))
        .repartitionByRange(tasks, "place").persist()
    )

    def epoch(asked: np.ndarray, start: np.ndarray, rate: float, number: int) -> tuple[np.ndarray, np.ndarray]:
        def one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts = list(batches)
            # A task may hold several places, or none; a block is one place, whatever the task.
            for _, part in pd.concat(parts).groupby("place") if parts else ():
                b = block(part)
                share = b.weights.sum() / whole
                seed = [settings.seed, number, len(b.weights), int(b.weights.sum())]
                mean = share * walk(b, start, shrink, rate, settings, seed)
                yield pd.DataFrame({"lost": [losses(b, asked) / whole], "mean": [mean.ravel()]})

        # One row a block: the size of the models for each _BLOCK_ROWS rows. Sorted, as sums depend on the order.
        found = sorted(dealt.mapInPandas(one, "lost array<double>, mean array<double>").collect())
        lost, means = (sum(np.array(row[i]) for row in found) for i in (0, 1))
        return lost, means.reshape(start.shape)

    best = descend(epoch, len(targets), shrink, settings)
    dealt.unpersist()
    weights = best[:, :-1] / spread
    return LinearModel(labels, weights, best[:, -1] - weights @ centre)
