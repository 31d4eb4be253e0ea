"""Reproducible sampling by a hash of the row's key: splits and row cap.

Stratified split and cap follow one order: by the hash, then by the key. No sort of all rows takes place. For the
split, counts per hash bucket show in which bucket a quota ends; only the keys of that bucket are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens import constants as C
from newslens.session import written

_BUCKET_BITS = 16


def key_hash(key: Column | str, seed: int = C.SEED) -> Column:
    """A 32-bit hash of `seed` and `key`, uniform over 0 .. 2^32 - 1."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _keys(df: DataFrame, stratum: Column, key: str, seed: int) -> DataFrame:
    """(stratum, key, hash, bucket) of every row, written: it is read twice."""
    rows = df.select(
        stratum.alias("stratum"), F.col(key).alias("key"), key_hash(key, seed).alias("hash")
    )
    return written(rows, "keys").withColumn("bucket", F.shiftright("hash", 32 - _BUCKET_BITS))


def _cuts(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """(stratum, last_hash, last_key, rows_before, rows_at): where each stratum's quota ends.

    `quotas` is (stratum, quota), one row per stratum; a stratum without a quota above 0 has no row.
    """
    buckets = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    until = Window.partitionBy("stratum").orderBy("bucket")
    quotas = quotas.select(F.col("stratum").alias("of"), "quota").where("quota > 0")
    ends = (
        buckets.withColumn("upto", F.sum("n").over(until))
        .join(quotas, F.col("stratum").eqNullSafe(F.col("of")))
        .where((F.col("upto") - F.col("n") < F.col("quota")) & (F.col("quota") <= F.col("upto")))
        .select("of", F.col("bucket").alias("in_bucket"), "quota", (F.col("upto") - F.col("n")).alias("offset"))
    )
    inside = F.col("stratum").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in_bucket"))
    upto = F.sum("n").over(Window.partitionBy("stratum").orderBy("hash", "key"))
    return (
        rows.join(ends, inside)
        .groupBy("stratum", "hash", "key", "quota", "offset")
        .agg(F.count("*").alias("n"))
        .withColumn("before", upto + F.col("offset") - F.col("n"))
        .where((F.col("before") < F.col("quota")) & (F.col("quota") <= F.col("before") + F.col("n")))
        .select(
            "stratum", F.col("hash").alias("last_hash"), F.col("key").alias("last_key"),
            F.col("before").alias("rows_before"), F.col("n").alias("rows_at"),
        )
    )


def _test_quotas(rows: DataFrame, test: float) -> DataFrame:
    """(stratum, quota): ceil(test * n) rows in all, dealt to the strata by largest remainder."""
    sizes = rows.groupBy("stratum").agg(F.count("*").cast("decimal(19,0)").alias("n"))
    every = Window.partitionBy(F.lit(0))  # one row per label
    total = F.sum("n").over(every)
    shares = sizes.withColumn("total", total).withColumn(
        "wanted", F.ceil(F.col("total").cast("double") * test - 1e-9).cast("decimal(19,0)")
    )
    dealt = shares.withColumn("floor", F.expr("n * wanted div total")).withColumn(
        "rest", F.expr("n * wanted - floor * total")
    )
    rank = F.row_number().over(every.orderBy(F.col("rest").desc(), F.col("stratum").asc()))
    left = F.col("wanted") - F.sum("floor").over(every)
    return dealt.withColumn("rank", rank).withColumn("left", left).select(
        "stratum", (F.col("floor") + F.when(F.col("rank") <= F.col("left"), 1).otherwise(0)).cast("bigint").alias("quota")
    )


def _position(key: str, seed: int) -> Column:
    return F.struct(key_hash(key, seed).alias("hash"), F.col(key).alias("key"))


def hash_split(
    df: DataFrame, key: str = "link", test: float = C.TEST_SHARE, seed: int = C.SEED
) -> DataFrame:
    """Adds is_test. Each row decides for itself by its hash: nothing moves, shares are about right."""
    return df.withColumn("is_test", key_hash(key, seed) < F.lit(test * 2.0**32))


def stratified_split(
    df: DataFrame,
    label: str = "label",
    key: str = "link",
    test: float = C.TEST_SHARE,
    seed: int = C.SEED,
) -> DataFrame:
    """Adds is_test: ceil(test * n) rows, and of every label its share of them.

    Of a label, the first keys in hash order are test. All rows of one key and label fall on one
    side, so a repeated key at the cut adds its other rows. The cuts are a table with a row per
    label, joined to the rows.
    """
    rows = _keys(df, F.col(label), key, seed)
    # Written so that its size is known: it is broadcast where it is small.
    cuts = written(_cuts(rows, _test_quotas(rows, test)).select("stratum", "last_hash", "last_key"), "cuts")
    inside = _position(key, seed) <= F.struct(F.col("last_hash").alias("hash"), F.col("last_key").alias("key"))
    return (
        df.join(cuts, F.col(label).eqNullSafe(F.col("stratum")), "left")
        .withColumn("is_test", F.coalesce(inside, F.lit(False)))
        .drop("stratum", "last_hash", "last_key")
    )


def cap_rows(
    df: DataFrame, n: int = C.TRAINING_CAP, key: str = "link", seed: int = C.SEED
) -> DataFrame:
    """The first `n` rows in hash order, or all if there are fewer.

    Every task keeps its own first `n` in a bounded heap while it reads, and these are merged: one
    scan, nothing written or sorted as a whole. Of the rows of one key those with the smallest
    hash over all columns come first.
    """
    return df.orderBy(key_hash(key, seed), key, F.xxhash64(*df.columns)).limit(n)
