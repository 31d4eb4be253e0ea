"""Boosted trees by gradients and curvatures of the logistic loss.

Values are put into bins once. Each level of each tree is one pass over the binned rows: every task sums
gradients and curvatures of its rows by (node, feature, bin), the sums are added up in a tree of tasks,
and the driver, which holds nothing but those sums and the trees, takes the cut of each node whose
regularised gain is largest. Two labels share one tree a round, more have one tree each.

The margins of a row follow from the trees made so far. A worker keeps those of the blocks it met last and
adds what later trees give; what it does not have it works out from all trees, so a task that is lost is
run again from the stored rows. Gradients are summed as whole numbers, which makes the
sums, and so the trees, the same in whatever order the tasks end.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.session import ship_package, written

# Gradients and curvatures are at most 1: sums of 2^29 rows stay exact in a double.
_SCALE = float(1 << 24)
# A root that is not cut and moves margins by less than this has nothing left to learn.
_STILL = 1e-6
# Rows that make a task of a pass worth starting: small files of fewer are read together.
_BLOCK_ROWS = 20_000
# At most so many bins a feature, so that one fits a byte.
BINS = 255
_TREE_SCHEMA = "round int, part int, node int, feature int, cut double, left int, right int, value double"


@dataclass
class Tree:
    """Nodes by number, the root first; a leaf has feature -1. Up to the cut a row goes left."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, start in zip((self.feature, self.cut, self.left, self.right), (-1, 0.0, 0, 0), strict=True):
            column.append(start)
        self.value.append(value)
        return len(self.value) - 1

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """Node that each row ends in."""
        feature, cut, left, right = map(np.array, (self.feature, self.cut, self.left, self.right))
        at = np.zeros(len(rows), np.int64)
        moving = np.flatnonzero(feature[at] >= 0)
        while len(moving):
            node = at[moving]
            at[moving] = np.where(rows[moving, feature[node]] <= cut[node], left[node], right[node])
            moving = moving[feature[at[moving]] >= 0]
        return at


@dataclass(frozen=True)
class Settings:
    rounds: int = 100
    depth: int = 6
    rate: float = 0.3
    penalty: float = 1.0  # on the squared value of a leaf
    min_curvature: float = 1.0  # of the rows on either side of a cut
    min_gain: float = 1e-6


def _add(out: np.ndarray, trees: list[list[Tree]], rows: np.ndarray) -> np.ndarray:
    for made in trees:
        for part, tree in enumerate(made):
            out[:, part] += np.array(tree.value)[tree.leaves(rows)]
    return out


def _margins(trees: list[list[Tree]], rows: np.ndarray, parts: int) -> np.ndarray:
    return _add(np.zeros((len(rows), parts)), trees, rows)


# In a worker: (number of rounds, margins) of the blocks met last.
_at_hand: OrderedDict[str, tuple[int, np.ndarray]] = OrderedDict()
_AT_HAND_BYTES = 16 << 20


def _margins_so_far(name: str, done: list[list[Tree]], rows: np.ndarray, parts: int) -> np.ndarray:
    """`_margins`, where only the trees that the worker has not added before are followed."""
    made, out = _at_hand.pop(name, (0, None))
    if out is None or made > len(done):
        made, out = 0, np.zeros((len(rows), parts))
    _at_hand[name] = len(done), _add(out, done[made:], rows)
    while sum(held.nbytes for _, held in _at_hand.values()) > _AT_HAND_BYTES:
        _at_hand.popitem(last=False)
    return out


def slopes(margins: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss by margin: logistic for one margin, softmax for more."""
    if margins.shape[1] == 1:
        p = 1 / (1 + np.exp(-np.clip(margins, -60, 60)))
        return p - targets[:, None], p * (1 - p)
    p = np.exp(margins - margins.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    return p - (np.arange(margins.shape[1]) == targets[:, None]), np.minimum(1, 2 * p * (1 - p))


def _sums(block: tuple[str, np.ndarray, np.ndarray], done: list[list[Tree]], growing: list[Tree],
          open_nodes: list[list[int]], bins: int) -> np.ndarray:
    """[gradient or curvature, node, feature, bin] over the rows of a block; nodes part by part."""
    name, rows, targets = block
    width = rows.shape[1]
    g, h = (np.rint(x * _SCALE) for x in slopes(_margins_so_far(name, done, rows, len(growing)), targets))
    out, offsets = [], np.arange(width) * bins
    for part, (tree, nodes) in enumerate(zip(growing, open_nodes, strict=True)):
        place = np.full(len(tree.value), -1)
        place[nodes] = np.arange(len(nodes))
        slot = place[tree.leaves(rows)]
        here = slot >= 0
        cells = (slot[here, None] * (width * bins) + offsets + rows[here]).ravel()
        out.append([
            np.bincount(cells, np.repeat(x[here, part], width), len(nodes) * width * bins) for x in (g, h)
        ])
    return np.concatenate(out, axis=1).reshape(2, -1, width, bins)


def best_cuts(sums: np.ndarray, settings: Settings) -> list[tuple[float, int, int]]:
    """(gain, feature, bin) of each node's best cut, the first of equals; gain 0 if none is allowed."""
    g, h = np.cumsum(sums, axis=3) / _SCALE
    whole_g, whole_h = g[..., -1:], h[..., -1:]
    gains = (
        g**2 / (h + settings.penalty)
        + (whole_g - g) ** 2 / (whole_h - h + settings.penalty)
        - whole_g**2 / (whole_h + settings.penalty)
    )
    gains[(h < settings.min_curvature) | (whole_h - h < settings.min_curvature)] = 0.0
    flat = gains.reshape(len(gains), -1)
    best = flat.argmax(axis=1)
    return [(float(flat[i, b]), *map(int, divmod(b, gains.shape[2]))) for i, b in enumerate(best)]


def grow(pass_over, parts: int, settings: Settings) -> list[list[Tree]]:
    """Trees, with bin numbers for cuts, where `pass_over(done, growing, open)` gives the sums of a level.

    The sums on either side of a cut are those of its children, so only nodes that may be cut are passed
    over. Stops early where the rows have too little curvature left for a cut of any root, or no root moves.
    """
    done: list[list[Tree]] = []

    def value(g: float, h: float) -> float:
        return -settings.rate * g / (h + settings.penalty)

    for _ in range(settings.rounds):
        growing = [Tree() for _ in range(parts)]
        open_nodes = [[tree.add(0.0)] for tree in growing]
        spent = True
        for level in range(settings.depth):
            sums = pass_over(done, growing, open_nodes)
            cuts = best_cuts(sums, settings)
            following: list[list[int]] = []
            at = 0
            for tree, nodes in zip(growing, open_nodes, strict=True):
                opened = []
                for node in nodes:
                    g, h = (float(x[at, 0].sum()) / _SCALE for x in sums)
                    if level == 0:
                        tree.value[node] = value(g, h)
                        spent = spent and h < 2 * settings.min_curvature
                    gain, feature, cut = cuts[at]
                    if gain > settings.min_gain:
                        low_g, low_h = (float(x[at, feature, : cut + 1].sum()) / _SCALE for x in sums)
                        tree.feature[node], tree.cut[node] = feature, cut
                        sides = []
                        for side_g, side_h in ((low_g, low_h), (g - low_g, h - low_h)):
                            sides.append(tree.add(value(side_g, side_h)))
                            if side_h >= 2 * settings.min_curvature:
                                opened.append(sides[-1])
                        tree.left[node], tree.right[node] = sides
                    at += 1
                following.append(opened)
            open_nodes = following
            if not any(open_nodes):
                break
        if spent or all(len(tree.value) == 1 and abs(tree.value[0]) < _STILL for tree in growing):
            break
        done.append(growing)
    return done


@dataclass
class BoostedTrees:
    """A fitted model; a row's label is that of its largest margin, the first of equals."""

    labels: list[str]
    trees: list[list[Tree]]

    def margins(self, rows: np.ndarray) -> np.ndarray:
        return _margins(self.trees, rows, 1 if len(self.labels) == 2 else len(self.labels))

    def choose(self, rows: np.ndarray) -> np.ndarray:
        margins = self.margins(rows)
        index = (margins[:, 0] > 0).astype(int) if len(self.labels) == 2 else margins.argmax(axis=1)
        return np.array(self.labels, dtype=object)[index]

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """`df`, which has an array column `features`, with a label; null for a null vector or no labels."""
        return df.withColumn(output, self.prediction(df.sparkSession))

    def prediction(self, spark: SparkSession) -> Column:
        """The label as a column: one worker of a task answers several such columns of one step."""
        ship_package(spark)
        shipped = spark.sparkContext.broadcast(self)  # bounded by rounds and depth

        @F.pandas_udf("string")
        def label(batch: pd.Series) -> pd.Series:
            model = shipped.value
            found = pd.Series([None] * len(batch), dtype=object)
            there = batch.notna().to_numpy()
            if model.labels and there.any():
                found[there] = model.choose(np.array(batch[there].to_list(), np.float64))
            return found

        return label(F.col("features").cast("array<double>"))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (number, part, node, *values)
            for number, made in enumerate(self.trees)
            for part, tree in enumerate(made)
            for node, values in enumerate(zip(tree.feature, tree.cut, tree.left, tree.right, tree.value, strict=True))
        ]
        spark.createDataFrame(rows, _TREE_SCHEMA).coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, labels: list[str]) -> BoostedTrees:
        trees: list[list[Tree]] = []
        # As many rows as the trees have nodes, which rounds and depth bound.
        for row in spark.read.schema(_TREE_SCHEMA).parquet(path).orderBy("round", "part", "node").collect():
            if row.part == 0 and row.node == 0:
                trees.append([])
            if row.node == 0:
                trees[-1].append(Tree())
            tree = trees[-1][-1]
            node = tree.add(row.value)
            tree.feature[node], tree.cut[node] = row.feature, row.cut
            tree.left[node], tree.right[node] = row.left, row.right
        return cls(labels, trees)


def _cuts(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Cut values of every feature: up to `bins` - 1 quantiles, one pass over the rows."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[
        F.percentile_approx(F.col("features")[i], shares, 10 * bins).alias(f"c{i}") for i in range(width)
    ]).first()
    return [np.unique(np.array(values or [], np.float64)) for values in found]


def fit_boosted(
    train: DataFrame, settings: Settings | None = None, bins: int = BINS
) -> BoostedTrees:
    """A model of the rows (label, features) that have both; all vectors are of one length.

    Rows may be any number: they are binned and stored once, then passed over once a level. Without
    rows there are no labels and every prediction is null; with one label all rows get it. `bins` is at most 255;
    a feature with no more distinct values than that is cut at each of them that is frequent enough to be a
    quantile.
    """
    settings = settings or Settings()
    spark = train.sparkSession
    ship_package(spark)
    rows = train.where(F.col("label").isNotNull() & F.col("features").isNotNull()).select(
        F.col("label").cast("string").alias("label"), F.col("features").cast("array<double>").alias("features")
    )
    facts = rows.groupBy("label").agg(  # one row a label
        F.max(F.size("features")).alias("width"), F.count("*").alias("rows")
    ).collect()
    labels = sorted(row.label for row in facts)
    if len(labels) < 2:
        return BoostedTrees(labels, [])
    cuts = _cuts(rows, max(row.width for row in facts), bins)
    index = {label: i for i, label in enumerate(labels)}

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = np.array(batch["features"].to_list(), np.float64).reshape(len(batch), len(cuts))
            cells = np.stack(
                [np.searchsorted(c, values[:, i], "left") for i, c in enumerate(cuts)], axis=1
            ).astype(np.uint8)
            yield pd.DataFrame({
                "target": batch["label"].map(index).astype("int32"), "cells": [row.tobytes() for row in cells]
            })

    stored = written(rows.mapInPandas(binned, "target int, cells binary"), "binned")

    def block(part: Iterable) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        part = list(part)
        if part:
            cells = np.frombuffer(b"".join(bytes(row.cells) for row in part), np.uint8)
            # A name for this reading: a block that is read again may hold its rows in another order.
            yield uuid.uuid4().hex, cells.reshape(len(part), -1), np.array([row.target for row in part])

    tasks = -(-sum(row.rows for row in facts) // _BLOCK_ROWS)
    blocks = stored.coalesce(tasks).rdd.mapPartitions(block).persist()
    parts = 1 if len(labels) == 2 else len(labels)

    def pass_over(done: list[list[Tree]], growing: list[Tree], open_nodes: list[list[int]]) -> np.ndarray:
        # The trees go with the task: a broadcast of its own would take longer than a pass over few rows.
        return blocks.map(lambda b: _sums(b, done, growing, open_nodes, bins)).treeReduce(np.add)

    trees = grow(pass_over, parts, settings)
    blocks.unpersist()
    for made in trees:
        for tree in made:
            tree.cut = [
                float(cuts[f][int(c)]) if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.cut, strict=True)
            ]
    return BoostedTrees(labels, trees)
