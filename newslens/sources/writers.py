"""CSV sinks: a directory of part files with header, no index and no byte-order mark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens import constants as C
from newslens.functions.arrays import print_int_list
from newslens.functions.text import clean_text


def _write(df: DataFrame, path: str, mode: str) -> None:
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_posts(posts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All post columns, the text cleaned: one line per post, so files can be split."""
    cleaned = posts.withColumn("text", clean_text("text"))
    _write(cleaned.select(*C.POST_COLUMNS), path, mode)


def write_users(users: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Raw snapshots, or prepared ones that have account_age in the place of created_at."""
    columns = [
        "account_age" if c == "created_at" and "account_age" in users.columns else c
        for c in C.USER_COLUMNS
    ]
    _write(users.select(*columns), path, mode)


def write_feature_store(features: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Feature rows as a Parquet table, in buckets by link and sorted in them.

    A join on the link then moves no vector, however many links there are: the labels alone are dealt to the buckets.
    Take at least as many buckets as the joins' sessions have shuffle partitions: Spark deals fewer out
    anew. The arrays stay arrays. An existing table raises; `path` places the files outside the warehouse.
    """
    rows = features.select("link", "textFeatures", "retweets", "userFeatures")
    # Dealt out as the buckets are: one file for each.
    dealt = rows.repartition(buckets, "link").write.bucketBy(buckets, "link").sortBy("link").format("parquet")
    (dealt if path is None else dealt.option("path", path)).saveAsTable(table, mode="error")


def write_features(features: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """index, link, textFeatures, retweets, userFeatures; lists as `[1, 2]`. The index is
    unique but has gaps: numbering without gaps would pull all rows through one task."""
    _write(
        features.select(
            F.monotonically_increasing_id().alias("index"),
            "link",
            print_int_list("textFeatures").alias("textFeatures"),
            "retweets",
            print_int_list("userFeatures").alias("userFeatures"),
        ),
        path,
        mode,
    )
