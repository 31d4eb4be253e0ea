"""Domain tables derived from the generic test tables, by Spark and from whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslens.functions.lexicon import lexicon_table, phrase_table

AS_OF = "2024-02-01"

# Frequent words of the test texts, so that many bins fill.
TEST_LEXICON = [
    ("the", 25, 50), ("of", -50, 25), ("and", 100, 100), ("to", -100, 75),
    ("in", 0, 0), ("le", 75, 100), ("der", -25, 50),
]

# The same with phrases, and with frequent words as modifiers.
TEST_PHRASES = [
    ("the", 25, 50, False), ("and", 100, 100, False), ("in", 0, 0, False), ("le", 75, 100, False), ("der", -25, 50, False),
    ("la", 35, 15, False), ("of the", -75, 65, False), ("in the", 45, 35, False), ("and to the", -95, 85, False),
    ("of", -50, 100, True), ("to", 130, 130, True), ("de", 33, 77, True), ("que", -100, 60, True),
]

VOTER_FACTORS = {
    "knn": 1, "lr": 2, "decisionTree": 3, "randomForest": 4, "naiveBayes": 6, "sgd": 7, "xgb": 8,
}


# The columns used, stated so that opening a table reads no file.
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "labels": "doc_id bigint, quality int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def raw_posts(spark: SparkSession, sf_dir: str, decimals: bool = False) -> DataFrame:
    """All 11 post columns. Links: one per source and language, a second one for every third
    post, one per story of four posts; every fifth post repeats with other retweets."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "lang", "text")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), "ts", "user_id", "event_type", "value"
    )
    base = docs.join(events, "doc_id", "left").withColumn(
        "retweets",
        F.when(
            F.col("event_type").isin("click", "view"),
            F.col("value") if decimals else F.floor("value").cast("int"),
        ),
    )
    site = F.concat(F.lit("https://"), "source", F.lit(".example/"), "lang")
    second = F.concat(F.lit("https://"), "lang", F.lit(".example/"))
    story = F.concat(
        F.lit("https://story.example/"), F.floor(F.col("doc_id") / 4).cast("string")
    )

    def entry(link, retweets):
        return F.struct(link.alias("link"), retweets.alias("retweets"))

    copies = F.array(
        entry(site, F.col("retweets")),
        entry(story, F.col("retweets")),
        F.when(F.col("doc_id") % 3 == 0, entry(second, F.col("retweets"))),
        F.when(F.col("doc_id") % 5 == 0, entry(site, F.col("retweets") + 1)),
    )
    rows = base.withColumn("copy", F.explode(F.filter(copies, lambda c: c.isNotNull())))
    return rows.select(
        "copy.link",
        F.col("ts").cast("timestamp").alias("date"),
        "text",
        F.col("doc_id").cast("string").alias("tweet_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("username"),
        "copy.retweets",
        F.floor(F.col("value") * 2).cast("int").alias("favorites"),
        F.lit(None).cast("string").alias("mentions"),
        F.concat(F.lit("#"), "source").alias("hashtags"),
        F.lit(None).cast("string").alias("geo"),
        F.concat(F.lit("https://posts.example/"), F.col("doc_id").cast("string")).alias(
            "permalink"
        ),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_posts(spark, sf_dir).select("link", "tweet_id", "text", "retweets")


def _events_with_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return events.join(customer, events["user_id"] == customer["c_custkey"]).withColumns(
        {
            "followers": F.floor(F.col("value") * 10).cast("bigint"),
            "friends": F.col("c_nationkey").cast("bigint") * 10,
            "k": F.get_json_object("props", "$.k").cast("bigint"),
            "is_verified": F.col("event_type") == "purchase",
            "has_user": F.col("event_id") % 7 != 0,
        }
    )


def _status_count():
    return F.when(F.col("event_id") % 2 == 0, F.col("k") % 20).otherwise(F.col("k") * 2)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared snapshots, one per post id; every 11th lacks its friends count."""
    return (
        _events_with_customers(spark, sf_dir)
        .where("has_user")
        .select(
            F.col("event_id").cast("string").alias("tweetid"),
            F.col("followers").alias("followers_count"),
            F.when(F.col("event_id") % 11 != 0, F.col("friends")).alias("friends_count"),
            F.datediff(F.lit(AS_OF).cast("date"), F.col("ts").cast("date")).alias("account_age"),
            F.col("is_verified").alias("verified"),
            _status_count().alias("statuses_count"),
        )
    )


def repeated_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`users` with every 13th id repeated, one follower more."""
    once = users(spark, sf_dir)
    extra = F.when(F.col("tweetid").cast("bigint") % 13 == 0, 2).otherwise(1)
    return once.withColumn("plus", F.explode(F.sequence(F.lit(0), extra - 1))).select(
        "tweetid",
        (F.col("followers_count") + F.col("plus")).alias("followers_count"),
        "friends_count",
        "account_age",
        "verified",
        "statuses_count",
    )


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw statuses as JSON text; every 7th has no user."""
    user = F.struct(
        F.col("user_id").alias("id"),
        F.col("c_name").alias("name"),
        F.lower("c_name").alias("screen_name"),
        F.col("followers").alias("followers_count"),
        F.col("friends").alias("friends_count"),
        (F.col("event_id") % 5).alias("listed_count"),
        F.date_format("ts", "EEE MMM dd HH:mm:ss '+0000' yyyy").alias("created_at"),
        (F.col("k") * 3).alias("favourites_count"),
        F.col("is_verified").alias("verified"),
        _status_count().alias("statuses_count"),
        (F.col("event_id") % 4 == 0).alias("default_profile"),
        (F.col("event_id") % 9 == 0).alias("default_profile_image"),
    )
    return _events_with_customers(spark, sf_dir).select(
        F.to_json(
            F.struct(F.col("event_id").alias("id"), F.when(F.col("has_user"), user).alias("user"))
        ).alias("status")
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label per site link, and one per story: fake if any of its posts is rated low,
    missing if none is rated."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    rated = table(spark, sf_dir, "labels").select("doc_id", "quality")
    sites = (
        docs.groupBy(
            F.concat(F.lit("https://"), "source", F.lit(".example/"), "lang").alias("news_url")
        )
        .agg(F.min("doc_id").alias("least"))
        .select(
            "news_url",
            F.when(F.col("least") % 3 == 0, "fake").otherwise("real").alias("credibility"),
        )
    )
    stories = (
        docs.join(rated, "doc_id", "left")
        .groupBy(
            F.concat(
                F.lit("https://story.example/"), F.floor(F.col("doc_id") / 4).cast("string")
            ).alias("news_url")
        )
        .agg(F.min("quality").alias("least"))
        .select(
            "news_url",
            F.when(F.col("least") == 0, "fake").when(F.col("least") == 1, "real").alias(
                "credibility"
            ),
        )
    )
    return sites.unionByName(stories)


def lexicon(spark: SparkSession) -> DataFrame:
    return lexicon_table(spark, TEST_LEXICON)


def phrases(spark: SparkSession) -> DataFrame:
    return phrase_table(spark, TEST_PHRASES)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven made-up votes per embedding, for the vote and the verdict."""
    voters = F.array(
        *[F.struct(F.lit(m).alias("model"), F.lit(k).alias("k")) for m, k in VOTER_FACTORS.items()]
    )
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.explode(voters).alias("voter")
    )
    vote = (F.col("vec_id") * 7 + F.col("label") * F.col("voter.k")) % 5 < 2
    return rows.select(
        F.concat(F.lit("link/"), F.col("vec_id").cast("string")).alias("link"),
        F.col("voter.model").alias("model"),
        F.when(vote, "fake").otherwise("real").alias("prediction"),
    )


def margin_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(link, label, features): one row per event, its label readable from any feature.

    Each feature is 0..4 for one label and 40..44 for the other, every second one the other way
    round, so that a right model of any kind gives every row its label.
    """
    number = F.col("event_id")
    fake = number % 3 == 0
    parts = [
        F.when(fake if j % 2 else ~fake, 40).otherwise(0) + (number * (j + 1)) % 5 for j in range(36)
    ]
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), number.cast("string")).alias("link"),
        F.when(fake, "fake").otherwise("real").alias("label"),
        F.array(*parts).cast("array<bigint>").alias("features"),
    )


def overlap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(link, label, features): one row per event, on a chequered board of six by six fields.

    A field is fake if the halves that its row and column lie in say so together, neither alone, and one
    row in eleven has the other label: the classes overlap, no single cut or plane tells them apart, and
    the best a model can do is the label that most rows of a field have.
    """
    number = F.col("event_id")
    across, down = number % 6, F.floor(number / 6) % 6
    fake = (across < 2) != (down < 4)
    labelled_fake = fake != (number % 11 == 0)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), number.cast("string")).alias("link"),
        F.when(labelled_fake, "fake").otherwise("real").alias("label"),
        F.array(*[down if j % 2 else across for j in range(36)]).cast("array<bigint>").alias("features"),
    )


def plane_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(link, label, features): one row per event, on either side of a plane through a cube of points.

    Three odd coordinates of -5 to 5 stand in twelve features each; a row is fake if they add up to more than 0.
    One row in eleven has the other label, so the classes overlap everywhere. Points and flips lie evenly about
    the plane, so the plane is what a right linear model must find, and single cuts cannot.
    """
    number = F.col("event_id")
    sides = [F.floor(number / step) % 6 * 2 - 5 for step in (1, 6, 36)]
    fake = sides[0] + sides[1] + sides[2] > 0
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), number.cast("string")).alias("link"),
        F.when(fake != (number % 11 == 0), "fake").otherwise("real").alias("label"),
        F.array(*[sides[j % 3] for j in range(36)]).cast("array<bigint>").alias("features"),
    )
