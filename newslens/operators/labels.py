"""Labels joined to feature vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens import constants as C
from newslens.operators.skew import PIECE_ROWS, spread_join


def label_features(
    vectors: DataFrame,
    labels: DataFrame,
    keep_missing: bool = False,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """(link, label, features): every label of a link meets its vector, repeats included.

    Repeats of a label are counted before anything moves, and told off in pieces of at most
    `piece_rows` that meet the vector in different tasks and are written out again there.
    """
    wanted = labels.select(F.col("news_url").alias("link"), F.col("credibility").alias("label"))
    if keep_missing:
        wanted = wanted.fillna(C.MISSING_LABEL, ["label"])
    else:
        wanted = wanted.where(F.col("label").isNotNull())
    last = F.ceil(F.col("n") / piece_rows) - 1
    pieces = (
        wanted.groupBy("link", "label")
        .agg(F.count("*").alias("n"))
        .select("link", "label", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
        .select(
            "link",
            "label",
            "piece",
            F.least(F.lit(piece_rows), F.col("n") - F.col("piece") * piece_rows).alias("times"),
        )
    )
    met = spread_join(
        pieces,
        vectors.select("link", "features"),
        "link",
        ["piece"],
        piece_rows=piece_rows,
        counted=wanted.select("link"),
    )
    each = F.explode(F.sequence(F.lit(1), F.col("times")))
    return met.select("link", "label", "features", each.alias("time")).drop("time")
