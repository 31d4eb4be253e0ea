"""Per-link histograms. Each is one conditional-count aggregate: bins never travel as arrays,
every count has a map-side half, and a link with a third of all posts is one row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens import constants as C
from newslens.functions.arrays import bin_counts, sum_arrays

VERIFIED_MODES = ("groups", "count")


def sentiment_groups(binned: DataFrame) -> DataFrame:
    """Posts by (link, sentiment bin, subjectivity bin)."""
    return binned.groupBy("link", "sentiment_bin", "subjectivity_bin").agg(
        F.count("*").alias("posts")
    )


def text_bins() -> Column:
    """Aggregate: 6 sentiment counts, then 6 subjectivity counts."""
    return bin_counts({"sentiment_bin": C.TEXT_BINS, "subjectivity_bin": C.TEXT_BINS})


def text_histogram(binned: DataFrame) -> DataFrame:
    return binned.groupBy("link").agg(text_bins().alias("textFeatures"))


def total_retweets() -> Column:
    """Aggregate: retweets, a missing count being 0."""
    return F.sum(F.coalesce(F.col("retweets"), F.lit(0)).cast("bigint"))


def retweet_total(posts: DataFrame) -> DataFrame:
    return posts.groupBy("link").agg(total_retweets().alias("retweets"))


def user_groups(binned: DataFrame) -> DataFrame:
    """Joined posts by (link, verified, ratio bin, activity bin)."""
    return binned.groupBy("link", F.col("verified").cast("int").alias("verified"),
                          "ratio_bin", "activity_bin").agg(F.count("*").alias("posts"))


def _verified_groups() -> str:
    """Aggregate: number of distinct (ratio bin, activity bin) pairs among verified authors.

    The 11 x 11 possible pairs are bits of two words, so the distinct count needs neither a
    second shuffle nor a set per link.
    """
    pair = f"(ratio_bin * {C.USER_BINS} + activity_bin)"

    def word(start: int) -> str:
        here = f"verified AND {pair} >= {start} AND {pair} < {start + 64}"
        bit = f"shiftleft(1L, {pair} - {start})"
        return f"coalesce(bit_count(bit_or(CASE WHEN {here} THEN {bit} END)), 0)"

    return f"CAST({word(0)} + {word(64)} AS BIGINT)"


def user_bins(verified: str = "groups") -> Column:
    """Aggregate: 11 ratio counts, 11 activity counts, 1 slot for verified authors.

    With `verified="groups"` the slot holds the number of distinct bin pairs among verified
    authors, as existing vectors have it; with `"count"` the number of verified authors.
    """
    if verified not in VERIFIED_MODES:
        raise ValueError(f"verified must be one of {VERIFIED_MODES}, not {verified!r}")
    slot = _verified_groups() if verified == "groups" else "count_if(verified)"
    return bin_counts({"ratio_bin": C.USER_BINS, "activity_bin": C.USER_BINS}, slot)


def user_histogram(binned: DataFrame, verified: str = "groups") -> DataFrame:
    return binned.groupBy("link").agg(user_bins(verified).alias("userFeatures"))


def verified_share(accounts: DataFrame) -> DataFrame:
    """Share of a link's joined posts whose author is verified."""
    return accounts.groupBy("link").agg(
        F.count_if("verified").alias("verified"),
        F.count("*").alias("authors"),
        F.avg(F.col("verified").cast("double")).alias("share"),
    )


def merge_feature_arrays(df: DataFrame, key: str, values: str, width: int) -> DataFrame:
    """Element-wise totals of ready-made integer arrays, per key."""
    return df.groupBy(key).agg(sum_arrays(values, width).alias(values))
