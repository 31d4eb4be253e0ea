"""Keep one row per key. Which one is fixed, so results do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

USER_FIELDS = ("followers_count", "friends_count", "account_age", "verified", "statuses_count")


def dedupe_posts(posts: DataFrame) -> DataFrame:
    """One row per (link, tweet_id): fewest retweets (null first), then smallest text hash."""
    first = F.min(F.struct("retweets", F.md5("text").alias("text_hash"), "text")).alias("first")
    return (
        posts.groupBy("link", "tweet_id")
        .agg(first)
        .select("link", "tweet_id", "first.text", "first.retweets")
    )


def dedupe_users(users: DataFrame) -> DataFrame:
    """One row per tweetid: the smallest of its rows, nulls first, field by field."""
    first = F.min(F.struct(*USER_FIELDS)).alias("first")
    return users.groupBy("tweetid").agg(first).select("tweetid", "first.*")
