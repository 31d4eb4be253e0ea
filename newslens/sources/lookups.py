"""Lookups in saved tables: posts by link, account snapshots by post id.

Both are left semi-joins: a list within Spark's broadcast threshold is broadcast and the table
stays where it is; a longer one is a sort-merge join whose hot table keys adaptive execution
splits, as each side is shuffled for this join alone. Posts pass a bitmap of the list before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.operators.skew import fits_broadcast
from newslens.schemas import STATUS_SCHEMA


# The bitmap of wanted keys: at most so many pieces, of 4 KB each. 16 MB whatever the number of keys.
_PIECES = 4096
_PIECE_BITS = 8 * 4096


def _bit(key: str) -> tuple[Column, Column]:
    """(piece, position) of a key in the bitmap."""
    place = F.pmod(F.xxhash64(key), F.lit(_PIECES * _PIECE_BITS))
    return F.shiftright(place, 15).cast("int"), place % _PIECE_BITS


def maybe_wanted(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """`rows` whose `key` may be in `wanted`: none that is gets lost, few that are not stay.

    A Bloom filter with one hash over 2^27 bits, built by an aggregate and broadcast. Its size is bounded by the
    number of pieces, not by that of the keys: up to some ten million keys, one row in ten that does not belong
    passes at most.
    """
    piece, position = _bit(key)
    bitmap = (
        wanted.where(F.col(key).isNotNull())
        .select(piece.alias("_piece"), position.alias("_position"))
        .groupBy("_piece")
        .agg(F.bitmap_construct_agg("_position").alias("_bits"))
    )
    byte = "conv(hex(substring(_bits, CAST(_position div 8 AS INT) + 1, 1)), 16, 10)"
    is_set = F.expr(f"shiftright(CAST({byte} AS INT), CAST(_position % 8 AS INT)) % 2 = 1")
    kept = (
        rows.withColumns({"_piece": piece, "_position": position})
        .join(F.broadcast(bitmap), "_piece")
        # Rows come out of a generator, so that no later join is moved below this one.
        .select(F.explode(F.when(is_set, F.array(F.struct(*rows.columns)))).alias("_row"))
    )
    return kept.select("_row.*")


def posts_for_links(posts: DataFrame, links: DataFrame, late: bool | None = None) -> DataFrame:
    """The posts of every link in `links`, compared exactly.

    With `late` posts first pass a bitmap of the wanted links where they are read, so that the
    shuffle of the join carries the texts of matches, and of few others. By default that is so where the
    links are more than Spark broadcasts; where they are not, no post moves anyway.
    """
    wanted = links.select("link")
    if not fits_broadcast(wanted) if late is None else late:
        posts = maybe_wanted(posts, wanted, "link")
    return posts.join(wanted, "link", "left_semi")


def flatten_status(raw: DataFrame, column: str = "status") -> DataFrame:
    """The 13 snapshot columns of a raw JSON status; null where the status has no user."""
    status = F.from_json(F.col(column), STATUS_SCHEMA)
    return raw.select(status.alias("s")).select(*_snapshot())


def _snapshot() -> list[Column]:
    fields = {"id": "userid", "name": "user_name"}
    user = STATUS_SCHEMA["user"].dataType
    return [F.col("s.id").cast("string").alias("tweetid")] + [
        F.col(f"s.user.{f.name}").alias(fields.get(f.name, f.name)) for f in user.fields
    ]


def statuses_with_user(raw: DataFrame, column: str = "status") -> DataFrame:
    """Flattened statuses, those without a user left out.

    The test sits inside a generator, so that no filter on the outcome moves below it and
    parses the JSON a second time.
    """
    status = F.array(F.from_json(F.col(column), STATUS_SCHEMA))
    kept = F.filter(status, lambda s: s["user"].isNotNull())
    return raw.select(F.explode(kept).alias("s")).select(*_snapshot())


def lookup_statuses(raw: DataFrame, ids: DataFrame, column: str = "status") -> DataFrame:
    """Snapshots of the posts in `ids` (first column), those without a user left out.

    The id is cut out of the text first; all fields are parsed for matches only.
    """
    wanted = ids.select(F.col(ids.columns[0]).cast("string").alias("tweetid"))
    some = raw.withColumn("_id", F.get_json_object(column, "$.id"))
    matched = some.join(wanted, some["_id"] == wanted["tweetid"], "left_semi")
    return statuses_with_user(matched, column)
