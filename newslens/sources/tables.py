"""Post and user tables as features need them: few columns, firm types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.functions.users import account_age, lenient_int


def prepare_posts(posts: DataFrame) -> DataFrame:
    """(link, tweet_id, text, retweets) from any table that has these columns."""
    return posts.select(
        "link",
        F.col("tweet_id").cast("string").alias("tweet_id"),
        "text",
        lenient_int("retweets").alias("retweets"),
    )


def prepare_users(users: DataFrame) -> DataFrame:
    """(tweetid, counts, account_age, verified); what cannot be read as a number is null."""
    return users.select(
        F.col("tweetid").cast("string").alias("tweetid"),
        *[lenient_int(c).alias(c) for c in ("followers_count", "friends_count", "account_age")],
        F.col("verified").try_cast("boolean").alias("verified"),
        lenient_int("statuses_count").alias("statuses_count"),
    )


def with_account_age(users: DataFrame, as_of) -> DataFrame:
    """`created_at` replaced by the age in days at `as_of`."""
    return users.withColumn("account_age", account_age("created_at", as_of)).drop("created_at")
