"""Benchmark items inside documents, by MinHash containment search over size partitions.

An item is contained in a document if at least `threshold` of its distinct word shingles occur in
it. A document may hold a hundred thousand shingles and an item thirty, so the likeness of
the two sets says nothing; what counts is the share of the item. Items are therefore partitioned by
their number of shingles, in powers of two, and the partition sets the length of the sketch: the
least hash values of an item's shingles, one more than the most shingles that an item of the
partition may lack. A document that contains the item must then hold at least one of the sketch,
so the search misses nothing. Documents that meet a sketch are verified by exact containment of the
shingles themselves.

Everything is DataFrame expressions. A document is spelled out in shingle hashes where it is read,
and only those that a sketch holds are kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.session import written

SHINGLE = 5
THRESHOLD = 0.8


def words_of(text: Column) -> Column:
    """Lower-case words: runs of letters and digits. Null and empty texts have none."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(spaced, " "), lambda word: word != "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body's own functions use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _runs(words: Column, shingle: Callable[..., Column]) -> Column:
    """`shingle` of every run of SHINGLE words; a shorter text that has words is one run."""
    count = F.size(words)
    whole = F.transform(
        F.sequence(F.lit(0), F.greatest(count, F.lit(SHINGLE)) - SHINGLE),
        lambda i: shingle(*[F.get(words, i + shift) for shift in range(SHINGLE)]),
    )
    return F.when(count > 0, whole).otherwise(F.slice(whole, 1, 0))


def shingle_hashes(text: Column) -> Column:
    """Hashes of all shingles of a text."""
    return _let(words_of(text), lambda words: _runs(words, F.xxhash64))


def shingles(text: Column) -> Column:
    """The distinct shingles of a text themselves."""
    return _let(
        words_of(text),
        lambda words: F.array_distinct(_runs(words, lambda *run: F.concat_ws(" ", *run))),
    )


def _most_missing(size: Column, threshold: float) -> Column:
    """How many shingles a contained item of `size` may lack: size less the least that suffices."""
    return size - F.ceil(size * threshold - 1e-9)


def item_sketches(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item, hash): the sketch of every item, as long as its size partition asks."""
    listed = items.select("item", F.array_sort(F.array_distinct(shingle_hashes(F.col("text")))).alias("hashes"))
    size = F.size("hashes")
    # The upper end of the partition (2**k .. 2**(k+1) - 1 shingles).
    upper = F.pow(F.lit(2.0), F.floor(F.log2(size.cast("double"))) + 1) - 1
    length = F.least(size, (_most_missing(upper, threshold) + 1).cast("int"))
    return listed.where(size > 0).select("item", F.explode(F.slice("hashes", 1, length)).alias("hash"))


def containments(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, containment) of every document and item with containment >= threshold.

    Null texts have no words, and an item without words is contained in nothing. An item or
    document with fewer than five words is one shingle. Rows of one document id are searched
    apart and answered once, by the largest containment; so are rows of one item id. Rows
    without an id are left out: they cannot be named in the result. Other columns are not read;
    empty tables give an empty result.
    """
    items = written(
        benchmark.where("item_id IS NOT NULL")
        .select(F.col("item_id").cast("long").alias("item_id"), F.col("text"))
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "text")),
        "items",
    )
    # Written so that its size is known: small sketches are broadcast, large ones shuffled.
    sketches = written(item_sketches(items, threshold), "sketches")
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = rows.select("doc_id", F.explode(shingle_hashes(F.col("text"))).alias("hash"))
    candidates = hashed.join(sketches, "hash").select("doc_id", "item").distinct()
    wanted = items.select("item_id", "item", shingles(F.col("text")).alias("wanted"))
    candidates = written(candidates.join(wanted, "item"), "candidates")
    # Only the texts of documents with a candidate move, where the list of these is small.
    hit = written(candidates.select("doc_id").distinct(), "hit")
    # Files hold an item's shingles once for many rows, so Spark takes the candidates for far smaller than they are in memory.
    held = rows.join(hit, "doc_id", "left_semi").join(candidates.hint("merge"), "doc_id").select(
        "doc_id", "item_id", "wanted", shingles(F.col("text")).alias("held")
    )
    share = F.size(F.array_intersect("wanted", "held")) / F.size("wanted")
    return (
        held.select("doc_id", "item_id", share.alias("containment"))
        .where(F.col("containment") >= threshold)
        .groupBy("doc_id", "item_id")
        .agg(F.max("containment").alias("containment"))
    )
