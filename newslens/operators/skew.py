"""Equi-joins that hold when one key carries a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.session import written

# A key with more rows than this is cut into pieces of about this many rows.
PIECE_ROWS = 1_000_000
# Keys that the sketch tracks: every key with more than about 1/TRACKED of all rows is found, and
# what lies below that is left to adaptive execution.
TRACKED = 100_000
# Rows without a key meet nothing and are dealt over so many places.
_NOWHERE = 1 << 30


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; nothing runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's own size estimate lets it broadcast `df` without a hint."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return estimated_bytes(df) <= int(limit)


def hot_keys(rows: DataFrame, key: str, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(key, pieces) of the keys to cut, from one pass over one column; at most TRACKED rows.

    A sketch of frequent items has bounded state in every task and merges in place of a count of
    all keys. Its counts are estimates, which only set how finely a key is cut.
    """
    top = rows.select(F.col(key).alias("k")).where("k IS NOT NULL").agg(
        F.expr(f"approx_top_k(k, {TRACKED}, {TRACKED})").alias("top")
    )
    found = top.select(F.explode("top").alias("t")).select(F.col("t.item").alias(key), F.col("t.count").alias("n"))
    hot = found.where(F.col("n") > piece_rows).select(
        key, F.ceil(F.col("n") / piece_rows).cast("int").alias("pieces")
    )
    return written(hot, "hot_keys")


def spread_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    spread_by: list[str],
    how: str = "inner",
    piece_rows: int = PIECE_ROWS,
    counted: DataFrame | None = None,
    spread: bool | None = None,
) -> DataFrame:
    """`big` joined to `small` on `key`, `how` being inner or left.

    With `spread` both sides are prepared for a shuffle on the key: keys that are hot in `big` are
    cut by a hash of `spread_by` into pieces, each meeting its own copy of the `small` rows, and
    rows without a key are dealt out. Without it this is a plain join. By default it depends on
    whether `small` is estimated to fit Spark's broadcast threshold, where nothing of `big` moves.
    Hot keys are looked for in `counted`, by default `big`; where `big` is the outcome of heavy
    work, give the table it starts from, so that the sketch reads one column and redoes none of it.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    if not (not fits_broadcast(small) if spread is None else spread):
        return big.join(small, key, how)
    hot = F.broadcast(hot_keys(big if counted is None else counted, key, piece_rows))
    pieces = F.coalesce(F.col("pieces"), F.lit(1))
    places = F.when(F.col(key).isNull(), _NOWHERE).otherwise(pieces)
    salted = big.join(hot, key, "left").select(
        *big.columns, F.pmod(F.xxhash64(*spread_by), places).cast("int").alias("_piece")
    )
    copies = small.join(hot, key, "left").select(
        *small.columns, F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_piece")
    )
    return salted.join(copies, [key, "_piece"], how).drop("_piece")
