"""Exact 1-nearest-neighbour by Euclidean distance; of equally near rows the smallest id wins.

Every labelled row counts. A small table goes to every executor and queries stream past it. Of a larger one
nothing goes through the driver: distinct queries that equal a row are answered by a join, and blocks of the
others meet blocks of rows, of which only a query's nearest row goes on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.operators.sampling import cap_rows
from newslens.session import ship_package, written

# Numbers held at once while comparing a batch.
_WORK = 250_000
# A table of at most so many rows goes to every executor whole.
TABLE_ROWS = 16_384
# Rows, and queries, of a block.
BLOCK_ROWS = 32_768


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.to_list(), dtype=np.float64)


def _nearest_rows(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each query's nearest row, the first of equals.

    A product of matrices tells which rows may be nearest, within the error of its sums. Of these the differences
    are squared and added dimension by dimension: no cancellation, and exact on integers. What is
    not a number is nearest.
    """
    index = np.empty(len(queries), dtype=np.int64)
    best = np.empty(len(queries), dtype=np.float64)
    step = max(1, _WORK // max(1, len(rows)))
    with np.errstate(invalid="ignore", over="ignore"):
        norms, lengths = (np.square(x).sum(axis=1) for x in (rows, queries))
        reach = 16 * (rows.shape[1] + 4) * np.finfo(np.float64).eps * (np.sqrt(lengths) + np.sqrt(norms.max())) ** 2
        for start in range(0, len(queries), step):
            part = queries[start : start + step]
            rough = norms - 2 * (part @ rows.T)
            limit = rough.min(axis=1) + reach[start : start + step]
            # Where a sum is no number, every row is compared.
            query, row = np.nonzero(~(rough > limit[:, None]))
            squares = np.zeros(len(query))
            for d in range(rows.shape[1]):
                squares += np.square(part[query, d] - rows[row, d])
            # Pairs come in order of queries, each of which has one at least.
            firsts = np.searchsorted(query, np.arange(len(part)))
            least = np.minimum.reduceat(squares, firsts)
            best[start : start + step] = least
            hits = np.flatnonzero((squares == least[query]) | np.isnan(squares))
            index[start : start + step] = row[hits[np.searchsorted(query[hits], np.arange(len(part)))]]
    return index, best


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nearest row of its block for each query, from one block of rows in order of id, then one of queries.

    What is not a number is nearest, so it gets a distance below all others.
    """
    held: list[pa.RecordBatch] = []
    rows = vectors = None
    for batch in batches:
        first = int(np.count_nonzero(~batch.column("asks").to_numpy(zero_copy_only=False)))
        if first:
            held.append(batch.slice(0, first))
        asked = batch.slice(first)
        if not len(asked):
            continue
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            vectors, held = _matrix(rows.column("features").to_pandas()), []
        if rows is None:
            continue
        index, squares = _nearest_rows(_matrix(asked.column("features").to_pandas()), vectors)
        near = rows.select(["id", "label"]).take(pa.array(index)).combine_chunks().to_batches()[0]
        yield pa.RecordBatch.from_arrays(
            [asked.column("query"), pa.array(np.where(np.isnan(squares), -1.0, squares)), near.column("id"), near.column("label")],
            ["query", "distance", "id", "label"],
        )


def _finite() -> Column:
    """Whether every value of `features` is a finite number."""
    return F.coalesce(F.forall("features", lambda x: F.abs(x) < F.lit(float("inf"))), F.lit(False))


@dataclass
class NearestNeighbour:
    """A fitted model: `train` has one row per distinct vector (features, id, label)."""

    train: DataFrame

    def is_table(self) -> bool:
        """Whether `prediction` can hold the rows in every worker."""
        return self.train.count() <= TABLE_ROWS

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """`df`, which has an array column `features`, with the label of the nearest row.

        A null vector, or a model without rows, gives a null label.
        """
        if self.is_table():
            return df.withColumn(output, self.prediction(df.sparkSession))
        df = written(df, "asking")
        vector = F.col("features").cast("array<double>")
        asked = df.where(F.col("features").isNotNull()).select(vector.alias("features")).distinct()
        answers = self._answers(written(asked, "asked")).select(F.col("features").alias("_asked"), F.col("label").alias(output))
        # Files hold vectors of few distinct values in far less room than memory does: never broadcast.
        return df.join(answers.hint("merge"), vector == F.col("_asked"), "left").drop("_asked")

    def prediction(self, spark: SparkSession) -> Column:
        """The label as a column, from a small table: one worker of a task answers several such columns of one step."""
        ship_package(spark)
        table = self.train.orderBy("id").select("features", "label").toPandas()
        shipped = spark.sparkContext.broadcast(
            (_matrix(table["features"]), table["label"].to_numpy(dtype=object))
        )

        @F.pandas_udf("string")
        def nearest_label(batch: pd.Series) -> pd.Series:
            rows, labels = shipped.value
            found = pd.Series([None] * len(batch), dtype=object)
            there = batch.notna().to_numpy()
            if len(rows) and there.any():
                index, _ = _nearest_rows(_matrix(batch[there]), rows)
                found[there] = labels[index]
            return found

        return nearest_label(F.col("features").cast("array<double>"))

    def _answers(self, asked: DataFrame) -> DataFrame:
        """(features, label) for the distinct vectors `asked`, by a join and by blocks."""
        ship_package(asked.sparkSession)
        # An equal row is the nearest, unless a value somewhere is no finite number.
        equal = F.lit(self.train.where(~_finite()).isEmpty()) & _finite()
        rows = self.train.select(F.col("features").alias("_row"), "label", F.lit(True).alias("_met"))
        met = asked.join(rows.hint("merge"), equal & (F.col("features") == F.col("_row")), "left")
        numbered = met.select("features", "label", "_met", F.monotonically_increasing_id().alias("query"))
        met = written(numbered, "met")
        rest = met.where("_met IS NULL").select("features", "query")
        row_blocks, query_blocks = (-(-side.count() // BLOCK_ROWS) for side in (self.train, rest))

        def block(blocks: int) -> Column:
            return F.pmod(F.xxhash64("features"), F.lit(max(1, blocks))).cast("int")

        def each(blocks: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(max(1, blocks) - 1)))

        place = (F.col("row_block") * F.lit(max(1, query_blocks)) + F.col("query_block")).alias("place")
        sides = [
            side.select("*", own.alias(f"{name}_block"), every.alias(f"{other}_block"), F.lit(asks).alias("asks"))
            for side, own, every, name, other, asks in (
                (self.train, block(row_blocks), each(query_blocks), "row", "query", False),
                (rest, block(query_blocks), each(row_blocks), "query", "row", True),
            )
        ]
        both = sides[0].unionByName(sides[1], allowMissingColumns=True).select(place, "asks", "id", "query", "label", "features")
        kind = self.train.schema["id"].dataType.simpleString()
        near = (
            both.repartitionById(max(1, row_blocks) * max(1, query_blocks), F.col("place"))
            .sortWithinPartitions("asks", "id")
            .mapInArrow(_meet, f"query long, distance double, id {kind}, label string")
        )
        best = near.groupBy("query").agg(F.min(F.struct("distance", "id", "label")).alias("found"))
        found = rest.join(best.hint("merge"), "query").select("features", F.col("found.label").alias("label"))
        return written(met.where("_met").select("features", "label").unionByName(found), "answers")


def fit_nearest(
    train: DataFrame,
    features: str = "features",
    label: str = "label",
    key: str = "id",
    max_train_rows: int | None = None,
) -> NearestNeighbour:
    """A model of all rows, or of at most `max_train_rows`, the first in hash order of `key`.

    Rows without a vector teach nothing. Repeats of a vector are dropped, the smallest id kept.
    """
    some = train.where(F.col(features).isNotNull())
    if max_train_rows is not None:
        some = cap_rows(some, max_train_rows, key)
    distinct = (
        some.select(
            F.col(features).cast("array<double>").alias("features"),
            F.struct(F.col(key).alias("id"), F.col(label).cast("string").alias("label")).alias("r"),
        )
        .groupBy("features")
        .agg(F.min("r").alias("r"))
        .select("features", "r.id", "r.label")
    )
    return NearestNeighbour(written(distinct, "neighbours"))
