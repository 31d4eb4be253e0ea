"""Sentiment of a text: the mean polarity and subjectivity of its words found in a lexicon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.functions.text import (
    mean_hundredths,
    sentiment_bin,
    subjectivity_bin,
    words,
)
from newslens.operators.skew import fits_broadcast, spread_join


def score_sentiment(posts: DataFrame, lexicon: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, polarity, subjectivity), one row per distinct value of `keys`.

    `keys` must tell apart texts that differ. Rows equal in `keys` have the same text, and
    counting its words twice leaves the means unchanged.

    Words meet the lexicon by a join, broadcast when the lexicon is small, so only words that
    match go on. Each text also carries the empty word, matched by a weightless lexicon row:
    a text without any known word keeps its place, at (0, 0). Words of one text stay in one
    task up to the aggregation, whose map-side half therefore leaves one narrow row per text.
    """
    found = posts.select(
        *keys, F.explode(F.array_append(words("text"), F.lit(""))).alias("word")
    )
    weighed = lexicon.select("word", "pol", "sub", F.lit(1).alias("weight"))
    no_word = lexicon.sparkSession.range(0, 1, 1, 1).select(
        F.lit("").alias("word"),
        F.lit(0).alias("pol"),
        F.lit(0).alias("sub"),
        F.lit(0).alias("weight"),
    )
    known = weighed.unionByName(no_word)
    times = F.lit(1)
    if not fits_broadcast(known):
        # The words shuffle too: first repeats within a text, and of whole posts, are counted.
        found = found.groupBy(*keys, "word").agg(F.count("*").alias("times"))
        times = F.col("times")
    matched = spread_join(found, known, "word", keys)
    return (
        matched.groupBy(*keys)
        .agg(
            F.sum(F.col("pol") * times).alias("pol"),
            F.sum(F.col("sub") * times).alias("sub"),
            F.sum(F.col("weight") * times).alias("matches"),
        )
        .select(
            *keys,
            mean_hundredths(F.col("pol"), F.col("matches")).alias("polarity"),
            mean_hundredths(F.col("sub"), F.col("matches")).alias("subjectivity"),
        )
    )


def with_sentiment_bins(scores: DataFrame) -> DataFrame:
    return scores.withColumns(
        {
            "sentiment_bin": sentiment_bin("polarity"),
            "subjectivity_bin": subjectivity_bin("subjectivity"),
        }
    )
