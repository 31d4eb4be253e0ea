"""Posts and account snapshots to one 36-number vector per link."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions.text import fingerprint, unsigned
from newslens.operators.accounts import binned_users
from newslens.operators.histograms import text_bins, total_retweets, user_bins
from newslens.operators.sentiment import score_sentiment, with_sentiment_bins
from newslens.operators.skew import PIECE_ROWS, spread_join

POST_KEY = ["link", "tweet_id"]

# (texts, lexicon, keys) to (keys, polarity, subjectivity)
Scorer = Callable[[DataFrame, DataFrame, list[str]], DataFrame]

# Bits of a text's hash in a packed row, and of its two bins.
_HASH_BITS, _BIN_BITS = 80, 6


def _packed() -> Column:
    """Retweets, hash and bins of a post as one whole number that sorts as they do, nulls first.

    A number of fixed width can be updated in place, so the least of a key's rows is found by hashing, where
    a struct would be sorted for. 80 bits of the hash tell its texts apart.
    """
    retweets = F.coalesce(F.col("retweets").cast("bigint") + F.lit((1 << 31) + 1), F.lit(0)).cast("decimal(10,0)")
    half = _HASH_BITS // 2
    high, low = (unsigned("text_hash", start, half).cast("decimal(13,0)") for start in (0, half))
    text = F.coalesce(high * _whole(1 << half) + low + _whole(1 << _HASH_BITS), _whole(0))
    bins = (F.col("sentiment_bin") * 8 + F.col("subjectivity_bin")).cast("decimal(2,0)")
    return ((retweets * _whole(1 << (_HASH_BITS + 1)) + text) * _whole(1 << _BIN_BITS) + bins).cast("decimal(38,0)")


def _whole(value: int) -> Column:
    return F.lit(str(value)).cast(f"decimal({len(str(value))},0)")


def _unpacked(packed: str) -> dict[str, Column]:
    retweets = F.expr(f"CAST({packed} div {1 << (_HASH_BITS + 1 + _BIN_BITS)} AS BIGINT)")
    bins = F.expr(f"CAST({packed} % {1 << _BIN_BITS} AS INT)")
    return {
        "retweets": F.when(retweets > 0, (retweets - F.lit((1 << 31) + 1)).cast("int")),
        "sentiment_bin": F.floor(bins / 8).cast("int"),
        "subjectivity_bin": bins % 8,
    }


def scored_posts(posts: DataFrame, lexicon: DataFrame, scorer: Scorer = score_sentiment) -> DataFrame:
    """(link, tweet_id, retweets, sentiment_bin, subjectivity_bin), repeats dropped.

    Texts are scored where they are read and never shuffled: a 16-byte fingerprint stands in
    for them when repeats of a post are told apart. The row kept is the one `dedupe_posts`
    keeps.
    """
    marked = posts.select(*POST_KEY, "retweets", "text", fingerprint("text").alias("text_hash"))
    scores = scorer(marked, lexicon, [*POST_KEY, "retweets", "text_hash"])
    firsts = with_sentiment_bins(scores).groupBy(*POST_KEY).agg(F.min(_packed()).alias("first"))
    return firsts.select(*POST_KEY, *[value.alias(name) for name, value in _unpacked("first").items()])


def link_features(
    posts: DataFrame,
    users: DataFrame,
    lexicon: DataFrame,
    activity: str = "compat",
    verified: str = "groups",
    piece_rows: int = PIECE_ROWS,
    spread: bool | None = None,
    scorer: Scorer = score_sentiment,
) -> DataFrame:
    """(link, textFeatures[12], retweets, userFeatures[23]) of links with a known author.

    Posts keep their place in a left join to the binned users, so one aggregate per link yields
    all three parts at once; links none of whose posts found a user are dropped after it. `spread`
    is that of the join: whether users are too many to broadcast, by default as Catalyst estimates.
    With `scorer=score_in_context` the lexicon is one of phrases and modifiers.
    """
    joined = spread_join(
        scored_posts(posts, lexicon, scorer),
        binned_users(users, activity),
        "tweet_id",
        ["link"],
        how="left",
        piece_rows=piece_rows,
        counted=posts.select("tweet_id"),
        spread=spread,
    )
    return (
        joined.groupBy("link")
        .agg(
            text_bins().alias("textFeatures"),
            total_retweets().alias("retweets"),
            user_bins(verified).alias("userFeatures"),
            F.count("ratio_bin").alias("authors"),
        )
        .where(F.col("authors") > 0)
        .drop("authors")
    )


def assemble(features: DataFrame) -> DataFrame:
    """(link, features): text, then user, then retweets; the order models are trained on."""
    return features.select(
        "link", F.concat("textFeatures", "userFeatures", F.array("retweets")).alias("features")
    )
