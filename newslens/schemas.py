"""Explicit schemas: no source is inferred, so no scan runs twice."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


STRING, INT, LONG, BOOLEAN = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()

POST_SCHEMA = _struct(
    ("link", STRING),
    ("date", T.TimestampType()),
    ("text", STRING),
    ("tweet_id", STRING),
    ("username", STRING),
    ("retweets", INT),
    ("favorites", INT),
    ("mentions", STRING),
    ("hashtags", STRING),
    ("geo", STRING),
    ("permalink", STRING),
)

USER_SCHEMA = _struct(
    ("tweetid", STRING),
    ("userid", LONG),
    ("user_name", STRING),
    ("screen_name", STRING),
    ("followers_count", LONG),
    ("friends_count", LONG),
    ("listed_count", LONG),
    ("created_at", STRING),
    ("favourites_count", LONG),
    ("verified", BOOLEAN),
    ("statuses_count", LONG),
    ("default_profile", BOOLEAN),
    ("default_profile_image", BOOLEAN),
)

# A prepared file has the age in days in the place of the time of creation.
PREPARED_USER_SCHEMA = T.StructType(
    [T.StructField("account_age", INT) if f.name == "created_at" else f for f in USER_SCHEMA.fields]
)

# Fields of a raw status that are kept; `user` may be missing.
STATUS_SCHEMA = _struct(
    ("id", LONG),
    (
        "user",
        _struct(
            ("id", LONG),
            ("name", STRING),
            ("screen_name", STRING),
            ("followers_count", LONG),
            ("friends_count", LONG),
            ("listed_count", LONG),
            ("created_at", STRING),
            ("favourites_count", LONG),
            ("verified", BOOLEAN),
            ("statuses_count", LONG),
            ("default_profile", BOOLEAN),
            ("default_profile_image", BOOLEAN),
        ),
    ),
)
