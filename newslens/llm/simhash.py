"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

A fingerprint bit is set if more than half of the shingle hashes have it. Fingerprints within
`max_bits` of each other are linked, and links are closed to components.

The search works on distinct fingerprints only, so exact copies never meet each other:

1. Sorted neighbours: the fingerprints are ordered under four rotations and each is compared
   with the few before it. That ties most of a large near-copy group together at a cost in
   proportion to the rows, whatever the size of the group.
2. Multi-index hashing: a fingerprint is cut into three segments of 22, 21 and 21 bits. Two
   fingerprints within 4 bits agree up to one bit in the first or second segment, or agree in
   the third (else they would differ in 2 + 2 + 1 bits). Each fingerprint therefore looks up
   its Hamming balls of radius 1, 1 and 0 in the segment table, and the full distance of each
   match is verified. Only pairs of different components of step 1 matter, and the smaller
   component does the looking up, so a group never meets itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.components import connected_components
from newslens.llm.tables import text_bytes
from newslens.session import written

SEED = 42
SHINGLE = 4
MAX_BITS = 4
# (lowest bit, bits, radius) of each segment; sum of (radius + 1) must exceed MAX_BITS.
SEGMENTS = ((42, 22, 1), (21, 21, 1), (0, 21, 0))
ROTATIONS = (0, 16, 32, 48)
NEIGHBOURS = 4


def simhash(data: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of UTF-8 bytes, unsigned; 0 if there is no word."""
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    stops = np.cumsum(lengths) - 1
    starts = stops - lengths + 1
    if len(words) > shingle:
        starts, stops = starts[: 1 - shingle], stops[shingle - 1 :]
    else:
        starts, stops = starts[:1], stops[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)),
        "<u8",
        len(starts),
    )
    counts = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 14):
        part = hashes[low : low + (1 << 14)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint's bits as a signed long."""

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = (simhash(value.as_py(), shingle) for value in batch.column(1))
            fps = np.fromiter(values, np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    return rows.mapInArrow(fingerprints, "doc_id long, fp long")


def _bit_distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _sorted_neighbours(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Links between fingerprints that lie close in some rotated order."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fps = np.zeros(0, np.uint64)
        ids = np.zeros(0, np.int64)
        for batch in batches:
            fps = np.append(fps[-NEIGHBOURS:], batch.column(2).to_numpy().view(np.uint64))
            ids = np.append(ids[-NEIGHBOURS:], batch.column(3).to_numpy())
            for back in range(1, NEIGHBOURS + 1):
                near = np.bitwise_count(fps[back:] ^ fps[:-back]) <= max_bits
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[back:][near]), pa.array(ids[:-back][near])], ["a", "b"]
                )

    rotated = F.array(
        *[
            F.struct(
                F.lit(r).alias("r"),
                F.shiftleft("fp", r).bitwiseOR(F.shiftrightunsigned("fp", 64 - r)).alias("key")
                if r
                else F.col("fp").alias("key"),
            )
            for r in ROTATIONS
        ]
    )
    rows = nodes.select(F.explode(rotated).alias("o"), "fp", "node")
    ordered = rows.select("o.r", "o.key", "fp", "node").repartitionByRange("r", "key")
    return ordered.sortWithinPartitions("r", "key").mapInArrow(links, "a long, b long")


def _segment_keys(balls: bool) -> Column:
    """Segment values tagged with the segment's number; with balls, all within its radius."""
    keys = []
    for number, (low, bits, radius) in enumerate(SEGMENTS):
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << bits) - 1))
        value = value.bitwiseOR(F.lit(number << 32))
        flips = [0] + ([1 << i for i in range(bits)] if balls and radius else [])
        keys += [value.bitwiseXOR(F.lit(flip)) for flip in flips]
    return F.explode(F.array(*keys))


def _index_links(sized: DataFrame, max_bits: int) -> DataFrame:
    """Links between components, from `sized` (fp, component, size), found by the index."""
    entries = sized.select(
        _segment_keys(False).alias("key"),
        F.col("fp").alias("fp_b"),
        F.col("component").alias("b"),
        F.col("size").alias("size_b"),
    )
    buckets = entries.groupBy("key").agg(
        F.max("size_b").alias("largest"), F.min("b").alias("low"), F.max("b").alias("high")
    )
    probes = sized.select(_segment_keys(True).alias("key"), "fp", "component", "size")
    useful = (F.col("largest") > F.col("size")) | (
        (F.col("largest") == F.col("size"))
        & ((F.col("low") != F.col("component")) | (F.col("high") != F.col("component")))
    )
    # Spark takes the exploded sides for as small as `sized`, so it must be told not to broadcast them.
    probes = probes.join(buckets.hint("merge"), [probes.key == buckets.key, useful]).select(
        probes.key, "fp", "component", "size"
    )
    smaller = (F.col("size") < F.col("size_b")) | (
        (F.col("size") == F.col("size_b")) & (F.col("component") < F.col("b"))
    )
    close = _bit_distance("fp", "fp_b") <= max_bits
    found = probes.join(entries.hint("merge"), [probes.key == entries.key, smaller, close])
    return found.select(F.col("component").alias("a"), "b").distinct()


def _labelled(nodes: DataFrame, components: DataFrame, name: str) -> DataFrame:
    """`nodes` with the component of column `name`; its own value if it has none."""
    found = components.select(F.col("node").alias(name), F.col("component").alias("found"))
    return nodes.join(found, name, "left").withColumn(
        "component", F.coalesce("found", name)
    ).drop("found")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    A null text counts as empty; texts without words have fingerprint zero and are linked by it
    like any other. A repeated row is answered as often as it occurs. Rows without an id link
    nothing; they get the component of the documents that share their fingerprint, else null.
    Only doc_id and text are read. An empty table gives an empty result. `max_bits` may be
    smaller than 4, not larger: the index is built for 4.
    """
    if max_bits > MAX_BITS:
        raise ValueError(f"the segments find distances up to {MAX_BITS}")
    marked = written(with_fingerprints(docs, shingle), "fingerprints")
    known = marked.where("doc_id IS NOT NULL")
    nodes = written(known.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")

    near = connected_components(_sorted_neighbours(nodes, max_bits))
    first = _labelled(nodes, near, "node")
    sizes = near.groupBy("component").agg(F.count("*").alias("size"))
    sized = first.join(sizes, "component", "left").select(
        "fp", "node", "component", F.coalesce("size", F.lit(1)).alias("size")
    )
    sized = written(sized, "sized")

    far = connected_components(_index_links(sized, max_bits))
    final = _labelled(sized.select("fp", F.col("component").alias("c")), far, "c")
    return marked.join(final, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
