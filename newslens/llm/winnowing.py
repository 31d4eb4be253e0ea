"""Document fingerprints by winnowing, and how near a text is to an edited one.

All k-grams of the UTF-8 bytes are hashed by one rolling polynomial; of every `WINDOW` neighbouring
hashes the least is selected, the rightmost of equal ones, with its position. Any passage of
`WINDOW + GRAM - 1` bytes that two texts share therefore puts a common hash into both fingerprints,
and the kept positions say where.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A shared passage of 19 bytes is always found: half of a text of 38 characters.
GRAM = 12
WINDOW = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_CHUNK = 1 << 16


def _inverse_powers(count: int) -> np.ndarray:
    inverse = pow(int(_BASE), -1, 1 << 64)
    powers = np.full(count, inverse, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _powers(count: int) -> np.ndarray:
    powers = np.full(count, _BASE, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


_UP = _powers(_CHUNK)
_DOWN = _inverse_powers(_CHUNK + GRAM)


def gram_hashes(data: bytes, gram: int = GRAM) -> np.ndarray:
    """32-bit hashes of all `gram`-byte grams; equal grams have equal hashes wherever they stand."""
    down = _DOWN if gram <= GRAM else _inverse_powers(_CHUNK + gram)
    values = np.frombuffer(data, np.uint8)
    total = len(values) - gram + 1
    out = np.empty(max(0, total), np.uint64)
    for low in range(0, total, _CHUNK):
        part = values[low : low + _CHUNK + gram - 1].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * down[: len(part)], out=sums[1:])
        count = len(part) - gram + 1
        rolled = (sums[gram:] - sums[:-gram]) * _UP[:count]
        rolled ^= rolled >> np.uint64(29)
        rolled *= _MIX
        out[low : low + count] = rolled >> np.uint64(32)
    return out


def _window_minima(keys: np.ndarray, window: int) -> np.ndarray:
    """Least key of every `window` neighbours, by doubling the reach."""
    reach = 1
    while reach * 2 <= window:
        keys = np.minimum(keys[:-reach], keys[reach:])
        reach *= 2
    rest = window - reach
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def winnow(data: bytes, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the selected grams, by position.

    With fewer grams than a window, the least of them is selected; a text shorter than a gram is
    hashed whole, at position 0; an empty text has an empty fingerprint.
    """
    if len(data) < gram:
        whole = [xxhash.xxh32_intdigest(data)] if data else []
        return np.array(whole, np.uint64), np.zeros(len(whole), np.int64)
    hashes = gram_hashes(data, gram)
    last = np.uint64(0xFFFFFFFF)
    # A smaller lower half for a later place: of equal hashes the rightmost is the least key.
    keys = (hashes << np.uint64(32)) | (last - np.arange(len(hashes), dtype=np.uint64))
    least = _window_minima(keys, min(window, len(keys)))
    picked = least[np.append(True, least[1:] != least[:-1])]
    return picked >> np.uint64(32), (last - (picked & last)).astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the distinct hashes of two fingerprints that are common; 1 if both are empty."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def digest(hashes: np.ndarray, positions: np.ndarray) -> str:
    """32 hex digits that stand for a whole fingerprint, hashes and positions."""
    state = xxhash.xxh3_128(hashes.astype("<u4").tobytes())
    state.update(positions.astype("<u4").tobytes())
    return state.hexdigest()


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, hashes, positions) of every document, the selected grams by position.

    A null text counts as empty, repeated rows are answered as often as they occur.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(value.as_py(), gram, window) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                    pa.array([p for _, p in found], pa.list_(pa.int64())),
                ],
                ["doc_id", "hashes", "positions"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("data")
    )
    return texts.mapInArrow(rows, "doc_id long, hashes array<long>, positions array<long>")


def edited(text: str, following: str) -> str:
    """`text` with its last floor(n/2) code points replaced by the first as many of `following`."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bucket_of(order: Column, bounds: list[int]) -> Column:
    """How many of the sorted `bounds` are at or below the order key."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound <= order))


def _parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (bucket, place, doc_id, text, tail), where the row after one in (bucket, place, text) follows it.

    Buckets are ranges of ids, cut at quantiles: one per shuffle partition, so that the bounds are
    few. The first rows of a bucket are repeated as the tail of the bucket before it (the
    first bucket's as the tail of the last), so that no bucket needs another one's rows.
    """
    spark = docs.sparkSession
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(
        place.alias("place"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    parts = _parts(spark)
    shares = [i / parts for i in range(1, parts)] or [0.5]
    cut = rows.agg(F.percentile_approx("place", shares, 10_000)).first()[0]
    bounds = sorted(set(cut or []))
    rows = rows.withColumn("bucket", _bucket_of(F.col("place"), bounds))
    # One row per bucket that has rows: as many as there are bounds, whatever the data.
    firsts = sorted(rows.groupBy("bucket").agg(F.min("place")).collect())
    before = {low: firsts[i - 1][0] for i, (_, low) in enumerate(firsts)}
    if not before:
        return rows.withColumn("tail", F.lit(0)).select("bucket", "place", "doc_id", "text", "tail")
    tails = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    copies = F.when(
        F.col("place").isin(list(before)),
        F.array(F.struct("bucket", F.lit(0).alias("tail")),
                F.struct(tails[F.col("place")].alias("bucket"), F.lit(1).alias("tail"))),
    ).otherwise(F.array(F.struct("bucket", F.lit(0).alias("tail"))))
    return rows.withColumn("copy", F.explode(copies)).select(
        "copy.bucket", "place", "doc_id", "text", "copy.tail"
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def near_edits(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Every document's fingerprint against that of its edited text and of the next document.

    The next document is the next row by doc_id, equal ids by text; the first follows the last, and
    a single row follows itself. Rows without an id come before all others. A null text
    counts as empty; a text of any length is taken whole, by one task. Extra columns are not read; an
    empty table gives an empty result. Buckets go to tasks as ranges, so each task has about as many rows.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = [[] for _ in range(7)]
            for place, bucket, tail, doc, text in zip(
                *(batch.column(i).to_pylist() for i in range(5)), strict=True
            ):
                hashes, positions = winnow(text.encode(), gram, window)
                mine = (bucket, tail, doc, text, np.unique(hashes), digest(hashes, positions))
                if held is not None and held[0] == bucket and not held[1]:
                    _, _, doc, before, own, own_digest = held
                    changed = edited(before, text)
                    data = changed.encode()
                    hashes, positions = winnow(data, gram, window)
                    for column, value in zip(columns, (
                        doc, len(before), hashlib.sha256(data).hexdigest(), own_digest,
                        digest(hashes, positions), likeness(own, np.unique(hashes)),
                        likeness(own, mine[4]),
                    ), strict=True):
                        column.append(value)
                held = mine
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                [part.split()[0] for part in RESULT.split(", ")],
            )

    ordered = (
        with_next(docs)
        .select("place", "bucket", "tail", "doc_id", "text")
        .repartitionByRange(_parts(docs.sparkSession), "bucket")
        .sortWithinPartitions("bucket", "tail", "place", "text")
    )
    return ordered.mapInArrow(compare, RESULT)
