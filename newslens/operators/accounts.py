"""Posts joined to their authors' account snapshots, and the bins of those accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.functions import users as U
from newslens.operators.dedupe import USER_FIELDS, dedupe_users
from newslens.operators.skew import PIECE_ROWS, spread_join

ACTIVITY_MODES = ("compat", "age")


def _zero_filled() -> dict[str, Column]:
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in USER_FIELDS if c != "verified"}
    return {**filled, "verified": F.coalesce(F.col("verified"), F.lit(False))}


def join_posts_users(
    posts: DataFrame, users: DataFrame, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """One row per kept (link, tweet_id) whose author is known; missing fields count as 0.

    An author counts once per post, and under each link the post is found with.
    """
    pairs = posts.select("link", "tweet_id").distinct()
    known = dedupe_users(users).withColumnRenamed("tweetid", "tweet_id")
    return spread_join(
        pairs,
        known,
        "tweet_id",
        ["link"],
        piece_rows=piece_rows,
        counted=posts.select("tweet_id"),
    ).withColumns(_zero_filled())


def with_ratios(accounts: DataFrame, activity: str = "compat") -> DataFrame:
    """Adds follower_ratio and activity.

    `activity="compat"` divides the status count by 1 + verified flag, as existing vectors
    have it; `"age"` divides by 1 + account age in days.
    """
    if activity not in ACTIVITY_MODES:
        raise ValueError(f"activity must be one of {ACTIVITY_MODES}, not {activity!r}")
    divisor = F.col("verified").cast("int") if activity == "compat" else F.col("account_age")
    return accounts.withColumns(
        {
            "follower_ratio": U.follower_ratio("followers_count", "friends_count"),
            "activity": U.activity("statuses_count", divisor),
        }
    )


def with_user_bins(accounts: DataFrame, activity: str = "compat") -> DataFrame:
    """Adds ratio_bin and activity_bin, and the ratios they come from."""
    return with_ratios(accounts, activity).withColumns(
        {
            "ratio_bin": U.ratio_bin("follower_ratio"),
            "activity_bin": U.activity_bin("activity"),
        }
    )


def binned_users(users: DataFrame, activity: str = "compat") -> DataFrame:
    """(tweet_id, verified, ratio_bin, activity_bin): all of a snapshot that features need."""
    return with_user_bins(dedupe_users(users).withColumns(_zero_filled()), activity).select(
        F.col("tweetid").alias("tweet_id"), "verified", "ratio_bin", "activity_bin"
    )


def tagged_ids(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Bag union of the post ids on both sides, each tagged with the side it comes from."""
    news = posts.select(F.lit("news").alias("source"), "tweet_id")
    known = users.select(F.lit("users").alias("source"), F.col("tweetid").alias("tweet_id"))
    return news.unionByName(known)
