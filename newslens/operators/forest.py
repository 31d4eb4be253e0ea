"""A random forest that is never held whole: it is grown, stored and asked in parts of some trees each.

The driver holds the trees that it grows, whose nodes grow with the rows. So as many trees are grown at a time as
rows allow, and after the first part as the nodes of its trees allow, every part from its own seed, and written to the shared folder. Votes of a row are added up part after
part; the label is that of all trees together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens import constants as C
from newslens.session import fresh_path, written

# Of so many rows all trees are grown at once; of more rows, first as many trees as make PART_ROWS rows times trees,
# then as many as make PART_NODES nodes, by the mean of the part before.
WHOLE_ROWS = 10_460
PART_ROWS = 500_000
PART_NODES = 300_000
# Spark's bagging adds the number of a partition to the seed: those of the parts lie further apart.
_SEED_STEP = 1_000_003


@dataclass
class ForestParts:
    """A fitted forest: the folders of its parts; a row's label is that of most votes, the first of equals."""

    labels: list[str]
    paths: list[str]

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """`df`, which has an array column `features`, with a label."""
        kept = df.columns
        df = written(df.withColumn("_votes", F.array(*[F.lit(0.0) for _ in self.labels])), "votes")
        for path in self.paths:
            model = RandomForestClassificationModel.load(path).setFeaturesCol("_vector").setRawPredictionCol("_raw")
            model = model.setPredictionCol("").setProbabilityCol("")
            asked = df.withColumn("_vector", array_to_vector(F.col("features").cast("array<double>")))
            votes = F.zip_with("_votes", vector_to_array("_raw"), lambda a, b: a + b)
            df = written(model.transform(asked).withColumn("_votes", votes).select(*kept, "_votes"), "votes")
        place = F.array_position("_votes", F.array_max("_votes")).cast("int")
        label = F.element_at(F.array(*map(F.lit, self.labels)), place)
        return df.select(*kept, label.alias(output))

    def save(self, path: str) -> None:
        for number, part in enumerate(self.paths):
            RandomForestClassificationModel.load(part).write().save(f"{path}/{number}")

    @classmethod
    def load(cls, path: str, labels: list[str], parts: int) -> ForestParts:
        return cls(labels, [f"{path}/{number}" for number in range(parts)])


def trees_at_once(rows: int) -> int:
    """How many trees the first part has; all of them while rows are few."""
    return C.FOREST_TREES if rows <= WHOLE_ROWS else min(C.FOREST_TREES, max(1, PART_ROWS // rows))


def fit_parts(forest: RandomForestClassifier, train: DataFrame, labels: list[str], size: int) -> ForestParts:
    """The trees that `forest` asks for, `size` of them first."""
    spark: SparkSession = train.sparkSession
    paths: list[str] = []
    left = forest.getNumTrees()
    while left:
        trees = min(size, left)
        part = forest.copy({forest.numTrees: trees, forest.seed: forest.getSeed() + _SEED_STEP * len(paths)})
        paths.append(fresh_path(spark, "forest"))
        model = part.fit(train)
        model.write().save(paths[-1])
        left -= trees
        size = max(1, PART_NODES * trees // model.totalNumNodes)
    return ForestParts(labels, paths)
