"""Toxic documents by compression distance between two zstandard dictionaries.

One dictionary is trained on windows of ordinary text. The other is trained on the toxic side: on
the words of toxic documents that these hold significantly more often than ordinary ones do. A
window is compressed twice, with the ordinary dictionary and with both; because the two
compressors share the ordinary content, the bytes saved come from toxic text alone. The savings
over all windows of a document give four numbers, and a logistic curve, calibrated on labelled
documents that took no part in training the dictionaries, makes them a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.tables import held_out, text_bytes

WINDOW = 6
LEVEL = 3
ORDINARY_BYTES = 64_000
TOXIC_BYTES = 4_000
# Bounds of the labelled sample: documents of each class, and the length of each.
SAMPLE = 3_000
SAMPLE_CHARS = 40_000
# A word is telling if its document rates differ by so many standard errors.
TELLING = 5.5
IF_NONE_TELLING = 20


def windows(data: bytes, size: int = WINDOW) -> list[bytes]:
    """All windows of `size` words, the last one shorter, lower-cased, with space around."""
    words = data.lower().split()
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


def _dictionary(size: int, samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _telling_words(toxic: list[bytes], ordinary: list[bytes]) -> set[bytes]:
    rates = [Counter(), Counter()]
    for counter, texts in zip(rates, (toxic, ordinary), strict=True):
        for text in texts:
            counter.update(set(text.lower().split()))
    n1, n0 = len(toxic), len(ordinary)
    scores = {}
    for word, a in rates[0].items():
        b = rates[1][word]
        both = (a + b) / (n1 + n0)
        error = math.sqrt(max(both * (1 - both), 1e-9) * (1 / n1 + 1 / n0))
        scores[word] = (a / n1 - b / n0) / error
    telling = {word for word, score in scores.items() if score >= TELLING}
    if not telling:
        ranked = sorted(scores, key=lambda word: (-scores[word], word))
        telling = {word for word in ranked[:IF_NONE_TELLING] if scores[word] > 0}
    return telling


def _raw(content: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    kind.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=kind, write_content_size=False, write_checksum=False,
        write_dict_id=False,
    )


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray  # of the features, the last one constant
    share: float  # of toxic rows; the score where there is nothing to compare

    def features(self, texts: Iterator[bytes]) -> np.ndarray:
        """Largest saving, sum of the three largest, mean, mean above noise; 1."""
        alone, both = _raw(self.ordinary).compress, _raw(self.ordinary + self.toxic).compress
        rows = []
        for text in texts:
            pieces = windows(text)
            if not pieces:
                rows.append((0.0, 0.0, 0.0, 0.0, 1.0))
                continue
            saved = np.fromiter(
                (len(alone(piece)) - len(both(piece)) for piece in pieces), np.float64, len(pieces)
            )
            top = np.sort(saved)[-3:]
            rows.append((top[-1], top.sum(), saved.mean(), np.maximum(saved - 2, 0).mean(), 1.0))
        return np.array(rows, np.float64).reshape(-1, 5)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(texts), self.share)
        logits = np.clip(self.features(iter(texts)) @ self.weights, -500, 500)
        return 1 / (1 + np.exp(-logits))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights by Newton's method."""
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + ridge * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(toxic: list[bytes], ordinary: list[bytes], share: float) -> ToxicityModel:
    """Dictionaries from two thirds of the labelled texts, the curve from the other third.

    `share` of all labelled rows is toxic; it corrects for a sample with other shares.
    """
    if len(toxic) < 3 or len(ordinary) < 3:
        return ToxicityModel(b"", b"", np.zeros(0), share)
    parts = [([t for i, t in enumerate(x) if i % 3], x[::3]) for x in (toxic, ordinary)]
    (toxic_train, toxic_rest), (ordinary_train, ordinary_rest) = parts
    telling = _telling_words(toxic_train, ordinary_train)
    bad = [b" " + w + b" " for text in toxic_train for w in text.lower().split() if w in telling]
    good = [piece for text in ordinary_train for piece in windows(text, 6)]
    if not bad or not good:
        return ToxicityModel(b"", b"", np.zeros(0), share)
    model = ToxicityModel(
        _dictionary(ORDINARY_BYTES, good), _dictionary(TOXIC_BYTES, bad), np.zeros(5), share
    )
    x = model.features(iter(toxic_rest + ordinary_rest))
    y = np.r_[np.ones(len(toxic_rest)), np.zeros(len(ordinary_rest))]
    model.weights = _logistic(x, y)
    sampled = len(toxic_rest) / len(y)
    model.weights[-1] += math.log(share / (1 - share)) - math.log(sampled / (1 - sampled))
    return model


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> ToxicityModel:
    """A model from labelled documents outside the held-out fold.

    At most SAMPLE documents of either class, those with the least hashes, and none longer than
    SAMPLE_CHARS, reach the driver. Null labels and ids teach nothing; a document with several
    labels is toxic if one says so.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(~held_out("doc_id", folds, fold))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("label"))
    )
    counts = {row.label: row["count"] for row in known.groupBy("label").count().collect()}
    order = F.xxhash64("doc_id", F.lit(11))
    picked = [known.where(F.col("label") == y).orderBy(order, "doc_id").limit(SAMPLE) for y in (0, 1)]
    # Never more than 2 * SAMPLE rows of two numbers.
    sample = F.broadcast(picked[0].union(picked[1]))
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"),
                    F.length(F.coalesce("text", F.lit(""))).alias("chars"))
        .where(F.col("chars") <= SAMPLE_CHARS)
        .join(sample, "doc_id")
        .groupBy("doc_id", "label").agg(F.min("data").alias("data"))
        .withColumn("order", order)
        .select("order", "doc_id", "label", "data")
        .collect()
    )
    rows.sort(key=lambda row: (row.order, row.doc_id))
    texts = [[bytes(row.data) for row in rows if row.label == y] for y in (0, 1)]
    total = sum(counts.values())
    return fit(texts[1], texts[0], counts.get(1, 0) / total if total else 0.0)


def score(docs: DataFrame, model: ToxicityModel, folds: int = 5, fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; a null text counts as empty."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores([value.as_py() for value in batch.column(2)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64()),
                 pa.array((found >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"), held_out("doc_id", folds, fold).alias("held"),
        text_bytes().alias("data"),
    )
    return rows.mapInArrow(scores, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document scored by a model of the labelled ones outside the held-out fold.

    Without enough labels of both classes the score is the share of toxic ones (0 if there are
    none). Rows without an id are scored and never held out; repeated rows are answered as often
    as they occur; other columns are not read; empty tables give an empty result.
    """
    return score(docs, train(docs, labels))
