"""Approximate nearest neighbour over all labelled rows, by hashes of random projections.

The exact search of `nearest` holds a bounded table on every executor; this one bounds nothing. A vector is
projected on random directions and each projection cut into steps; the steps of a few directions together are a
bucket, and vectors that lie near one another share a bucket in one of several tables with high
probability. Rows and queries of a bucket go to one place, where each query is compared with all rows and only
its nearest goes on: what is moved grows with the rows and queries, not with their pairs.

Nothing is left out of a bucket. Where a bucket holds more than `BUCKET_ROWS` rows, its rows and queries are
dealt on by further directions, level by level. What a bucket then holds beyond `BLOCK_ROWS` rows or
`BLOCK_QUERIES` queries is cut into blocks, and every block of its rows meets every block of its queries.
A query that meets no row is answered by the exact search over the rows of a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens import constants as C
from newslens.operators.nearest import NearestNeighbour, _matrix, _nearest_rows, fit_nearest
from newslens.session import ship_package, written

TABLES = 16
HASHES = 6
LEVELS = 3
# Buckets with more rows are dealt on, which costs recall: what a query meets is bounded by this.
BUCKET_ROWS = 65_536
# Rows and queries of a bucket that meet in one place.
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 65_536
# Rows, first in hash order, from which the width of a step is taken, and that answer queries without a neighbour.
SAMPLE = 2000
# Width of a step, in typical distances of nearest rows of the sample.
WIDTH = 3.0


@dataclass
class Projections:
    """Random directions and offsets; `LEVELS` keys for each table, each finer than the one before."""

    directions: np.ndarray  # (dimensions, TABLES * LEVELS * HASHES)
    offsets: np.ndarray
    mixers: np.ndarray
    width: float

    @classmethod
    def drawn(cls, dimensions: int, width: float, seed: int) -> Projections:
        rng = np.random.default_rng(seed)
        count = TABLES * LEVELS * HASHES
        mixers = rng.integers(1, 1 << 62, count, dtype=np.int64) | 1
        return cls(rng.standard_normal((dimensions, count)), rng.uniform(0, width, count), mixers, width)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """(row, table, level): the bucket of each row; a level also mixes in those before it."""
        steps = np.floor((vectors @ self.directions + self.offsets) / self.width).astype(np.int64)
        with np.errstate(over="ignore"):
            mixed = (steps * self.mixers).reshape(len(vectors), TABLES, LEVELS, HASHES).sum(axis=3)
            return np.cumsum(mixed, axis=2) + np.arange(TABLES)[None, :, None]

    def column(self, vector: str) -> Column:
        """The keys of a vector column: an array for each table of an array for each level."""

        @F.pandas_udf("array<array<bigint>>")
        def keys(values: pd.Series) -> pd.Series:
            if not len(values):
                return pd.Series([], dtype=object)
            return pd.Series([[list(levels) for levels in row] for row in self.keys(_matrix(values)).tolist()])

        return keys(vector)


def _keyed(rows: DataFrame, projections: Projections, name: str) -> DataFrame:
    """`rows` with `_all`, their keys, written: once for each row, not for each table."""
    return written(rows.withColumn("_all", projections.column("features")), name)


def _bucketed(keyed: DataFrame) -> DataFrame:
    """The rows once for each table, with `keys`, one bucket for each level."""
    kept = [c for c in keyed.columns if c != "_all"]
    return keyed.select(*kept, F.posexplode("_all").alias("table", "keys"))


def _blocks(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """(table, bucket, row_blocks, query_blocks) of the buckets that are cut; both sides have (table, bucket)."""
    one, other = (side.groupBy("table", "bucket").agg(F.count("*").alias(n)) for side, n in ((rows, "n"), (queries, "m")))
    cut = one.join(other, ["table", "bucket"]).where((F.col("n") > BLOCK_ROWS) | (F.col("m") > BLOCK_QUERIES))
    return written(
        cut.select(
            "table", "bucket",
            F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("row_blocks"),
            F.ceil(F.col("m") / BLOCK_QUERIES).cast("int").alias("query_blocks"),
        ),
        "blocks",
    )


def _dealt(side: DataFrame, blocks: DataFrame, key: str, own: str, other: str) -> DataFrame:
    """`side` with its block by a hash of `key`, once for each block of the other side."""
    own_count, other_count = (F.coalesce(f"{kind}_blocks", F.lit(1)) for kind in (own, other))
    return side.join(blocks, ["table", "bucket"], "left").select(
        *side.columns,
        F.pmod(F.xxhash64(key), own_count).cast("int").alias(f"{own}_block"),
        F.explode(F.sequence(F.lit(0), other_count - 1)).alias(f"{other}_block"),
    )


_PLACE = ["table", "bucket", "row_block", "query_block"]


def _meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The nearest row of its block for each query, from rows and queries in order of place, the rows first."""
    here, held = None, []
    for batch in batches:
        places = batch[[*_PLACE, "asks"]].to_numpy(np.int64)
        starts = np.flatnonzero(np.append(True, (places[1:] != places[:-1]).any(axis=1)))
        found = []
        for low, high in zip(starts, [*starts[1:], len(batch)], strict=True):
            *place, asks = places[low].tolist()
            if place != here:
                here, held = place, []
            part = batch.iloc[low:high]
            if not asks:
                held.append((_matrix(part["features"]), part["id"].to_numpy(), part["label"].to_numpy(dtype=object)))
            elif held:
                if len(held) > 1:
                    held = [tuple(map(np.concatenate, zip(*held, strict=True)))]
                vectors, ids, labels = held[0]
                index, squares = _nearest_rows(_matrix(part["features"]), vectors)
                found.append(
                    pd.DataFrame({"query": part["query"].to_numpy(), "distance": squares, "id": ids[index], "label": labels[index]})
                )
        if found:
            yield pd.concat(found)


@dataclass
class HashedNeighbours:
    """A fitted index: `rows` (id, label, features, table, bucket), `hot` (table, bucket) dealt on, `sample`."""

    rows: DataFrame
    hot: DataFrame
    sample: NearestNeighbour
    projections: Projections | None

    def predict(self, df: DataFrame, key: str, output: str = "prediction") -> DataFrame:
        """(`key`, `output`): the label of the nearest row found, for each row of `df`, which has `features`.

        `key` tells the rows of `df` apart; rows that share one are answered once. Of equally near rows the
        smallest id wins. A null vector, or an index without rows, gives a null label.
        """
        ship_package(df.sparkSession)
        vector = F.col("features").cast("array<double>").alias("features")
        queries = df.select(F.col(key).alias("query"), vector)
        if self.projections is None:
            return queries.select(F.col("query").alias(key), F.lit(None).cast("string").alias(output)).distinct()
        asked = queries.where(F.col("features").isNotNull()).groupBy("query").agg(F.min("features").alias("features"))
        asked = _keyed(asked, self.projections, "queries")
        bucketed = _settled(_bucketed(asked), self.hot)
        blocks = _blocks(self.rows, bucketed)
        rows = _dealt(self.rows, blocks, "id", "row", "query").withColumn("asks", F.lit(False))
        both = rows.unionByName(
            _dealt(bucketed, blocks, "query", "query", "row").withColumn("asks", F.lit(True)), allowMissingColumns=True
        )
        near = (
            both.repartition(*_PLACE)
            .sortWithinPartitions(*_PLACE, "asks", "id")
            .mapInPandas(_meet, _schema(both, "query", "distance double", "id", "label"))
        )
        found = F.struct("distance", "id", "label").alias("found")
        best = near.select("query", found).groupBy("query").agg(F.min("found").alias("found"))
        best = best.select("query", F.col("found.label").alias("label"))
        best = written(best, "found")
        alone = self.sample.predict(asked.drop("_all").join(best, "query", "left_anti"), "label").select("query", "label")
        answers = best.unionByName(alone).withColumnRenamed("query", "answered")
        every = queries.select("query").distinct()
        return every.join(answers, F.col("query").eqNullSafe(F.col("answered")), "left").select(
            F.col("query").alias(key), F.col("label").alias(output)
        )


def _schema(df: DataFrame, *columns: str) -> str:
    """DDL of `columns`: names of `df`, or a name with its type."""
    return ", ".join(c if " " in c else f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)


def _settled(bucketed: DataFrame, hot: DataFrame) -> DataFrame:
    """`bucketed` with `bucket`, the first of its keys that is not hot, or the last one."""
    out = bucketed.withColumn("bucket", F.get("keys", F.lit(0))).withColumn("_going", F.lit(True))
    for level in range(1, LEVELS):
        marked = hot.where(F.col("level") == level - 1).select("table", "bucket", F.lit(True).alias("_hot"))
        out = out.join(marked, ["table", "bucket"], "left")
        deeper = F.col("_going") & F.coalesce("_hot", F.lit(False))
        out = out.withColumns(
            {"bucket": F.when(deeper, F.get("keys", F.lit(level))).otherwise(F.col("bucket")), "_going": deeper}
        ).drop("_hot")
    return out.drop("keys", "_going")


def fit_hashed(
    train: DataFrame,
    features: str = "features",
    label: str = "label",
    key: str = "id",
    seed: int = C.SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> HashedNeighbours:
    """An index of all rows with a vector. Repeats of a vector count once, with the smallest id.

    The width of a step comes from a sample of at most `SAMPLE` rows, the first in hash order.
    """
    spark = train.sparkSession
    ship_package(spark)
    vector = F.col(features).cast("array<double>")
    found = F.struct(F.col(key).alias("id"), F.col(label).cast("string").alias("label"))
    distinct = (
        train.where(F.col(features).isNotNull())
        .groupBy(vector.alias("features"))
        .agg(F.min(found).alias("r"))
        .select("r.id", "r.label", "features")
    )
    distinct = written(distinct, "distinct")
    sample = fit_nearest(distinct, key="id", max_train_rows=SAMPLE)
    some = sample.train.select("features").toPandas()
    empty = spark.createDataFrame([], "table int, bucket long, level int")
    if some.empty:
        return HashedNeighbours(distinct, empty, sample, None)
    vectors = _matrix(some["features"])
    # Distances to the nearest other row, in a sample: each row is asked of the rest in two halves.
    half = max(1, len(vectors) // 2)
    _, squares = _nearest_rows(vectors[:half], vectors[half:] if len(vectors) > 1 else vectors)
    projections = Projections.drawn(vectors.shape[1], max(1e-9, WIDTH * float(np.sqrt(np.median(squares)))), seed)
    bucketed = _bucketed(_keyed(distinct, projections, "keyed"))
    hot = empty
    for level in range(LEVELS - 1):
        here = bucketed.select("table", F.get("keys", F.lit(level)).alias("bucket")).groupBy("table", "bucket")
        full = here.count().where(F.col("count") > bucket_rows).select("table", "bucket", F.lit(level).alias("level"))
        hot = hot.unionByName(full)
    hot = written(hot, "hot_buckets")
    return HashedNeighbours(_settled(bucketed, hot), hot, sample, projections)
