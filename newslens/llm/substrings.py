"""Repeated passages across documents, found by FM-indexes over shards.

A window is WINDOW consecutive words; a word goes if a window over it also starts earlier. Shards are
cut by content, so that equal windows meet in one shard and no shard needs another one's text:

1. A window's anchor is the least hash of its GRAM-word runs. Neighbouring windows with one anchor make
   a segment. Only segments whose anchor occurs again can repeat; the others stop here.
2. Shards are made of whole anchors. In a shard equal segments become one, with its first place; one that
   shares its anchor with no other, and whose words repeat too little to hold a window twice, is settled.
3. The words of a shard's other segments are indexed (Burrows-Wheeler transform, wavelet matrix), and all
   windows are streamed through backward search. Matching statistics below WINDOW end a window's
   search; an interval at WINDOW holds all its places, the least of which is its first start.
   Where an anchor has too many segments for one shard, its windows are named by a 128-bit hash, as
   segments are; equal ones meet by it, after each batch has settled all but the first of its own.
4. A segment's places after the first repeat it whole; at its first place those windows go that
   start earlier in another segment. The intervals are brought to the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm.fm_index import FMIndex
from newslens.session import written

WINDOW = 20
GRAM = 8
# Windows of a segment at most; longer runs of one anchor are cut.
SEGMENT = 64
# Words that a worker indexes together; a single anchor may hold more, up to HOT segments.
SHARD_WORDS = 400_000
# Segments of one anchor beyond which its windows are reduced by their hashes, without an index.
HOT = 10_000

_ODD = np.uint64(0x9FB21C651E98DF25)


def _gram_hashes(words: list[bytes]) -> np.ndarray:
    """A hash of every run of GRAM words."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    count = len(words) - GRAM + 1
    grams = np.zeros(count, np.uint64)
    for i in range(GRAM):
        grams = (grams ^ hashes[i : i + count]) * _ODD
        grams ^= grams >> np.uint64(29)
    return grams


def _least_of(grams: np.ndarray, runs: int) -> np.ndarray:
    """The least of every `runs` neighbours."""
    reach = 1
    while reach * 2 <= runs:
        grams = np.minimum(grams[:-reach], grams[reach:])
        reach *= 2
    rest = runs - reach
    return np.minimum(grams[: len(grams) - rest], grams[rest:]) if rest else grams


def segments_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, windows, anchors, own) of the segments of one document, which cover all its windows.

    own: whether the document holds the anchor's words more than once, so that a segment may repeat
    within itself.
    """
    if len(words) < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(bool)
    grams = _gram_hashes(words)
    anchors = _least_of(grams, WINDOW - GRAM + 1)
    fresh = np.append(True, anchors[1:] != anchors[:-1])
    begin = np.flatnonzero(fresh)
    inside = np.arange(len(anchors)) - begin[np.cumsum(fresh) - 1]
    starts = np.flatnonzero(inside % SEGMENT == 0)
    windows = np.diff(np.append(starts, len(anchors)))
    grams.sort()
    twice = grams[1:][grams[1:] == grams[:-1]]
    own = np.isin(anchors[starts], twice) if len(twice) else np.zeros(len(starts), bool)
    return starts, windows, anchors[starts].view(np.int64), own


def _packed_texts(docs: DataFrame) -> DataFrame:
    """(rid, place, doc_id, data): texts compressed for the shuffles; place orders ids, null first.

    rid is a hash of id and text, so that only equal rows share it.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data = pa.array([press.compress(v.as_py()) for v in batch.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], data], ["rid", "place", "doc_id", "data"])

    return _keyed(docs).mapInArrow(pack, "rid long, place long, doc_id long, data binary")


def _keyed(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).cast("binary").alias("data"),
    )
    return rows.select(
        F.xxhash64("doc_id", "data").alias("rid"),
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("place"),
        "doc_id",
        "data",
    )


def candidate_segments(docs: DataFrame) -> DataFrame:
    """(rid, spots): segments whose anchor occurs more than once, as start << 8 | windows - 1.

    Within a batch, only one segment of an anchor asks whether it occurs elsewhere; the others
    are known to repeat and travel under keys of their own. So a frequent anchor is a few rows.
    """

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, spots, keys, owns = [], [], [], []
            for rid, value in zip(batch.column(0).to_numpy(), batch.column(1), strict=True):
                starts, windows, anchor, own = segments_of(value.as_py().split())
                rids.append(np.full(len(starts), rid))
                spots.append(starts << 8 | windows - 1)
                keys.append(anchor)
                owns.append(own)
            if not rids:
                continue
            rid, spot, key, known = (np.concatenate(x) for x in (rids, spots, keys, owns))
            _, first, counts = np.unique(key, return_index=True, return_counts=True)
            again = np.ones(len(key), bool)
            again[first] = False
            known |= again
            known[first[counts > 1]] = True
            own = key.view(np.uint64) ^ ((rid.view(np.uint64) + spot.astype(np.uint64)) * _ODD)
            key = np.where(again, own.view(np.int64), key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(rid), pa.array(np.where(known, ~spot, spot))], ["key", "rid", "spot"]
            )

    found = _keyed(docs).select("rid", "data").mapInArrow(anchors, "key long, rid long, spot long")
    counted = found.withColumn("times", F.count("*").over(Window.partitionBy("key")))
    # A negative spot is the complement of one that is known to repeat.
    repeated = counted.where("times > 1 OR spot < 0").select(
        "rid", F.when(F.col("spot") < 0, F.bitwise_not("spot")).otherwise(F.col("spot")).alias("spot")
    )
    return repeated.groupBy("rid").agg(F.collect_set("spot").alias("spots"))


SEGMENTS = (
    "rid long, place long, start long, windows long, anchor long, k1 long, k2 long, words binary"
)


def _cut_segments(texts: DataFrame, spots: DataFrame) -> DataFrame:
    """The candidate segments with their words; in a batch, only the first place of equal ones carries them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        names = [part.split()[0] for part in SEGMENTS.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.binary()]
        for batch in batches:
            seen: set[bytes] = set()
            rows: list[tuple] = []
            rids, places, wanted = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for place, same in groupby(sorted(range(len(rids)), key=places.__getitem__), places.__getitem__):
                # Rows that repeat an id share its places, so their segments are put in one order.
                found = []
                for i in same:
                    words = unpack.decompress(batch.column(2)[i].as_py()).split()
                    starts, _, anchors, _ = segments_of(words)
                    anchor_at = dict(zip(starts.tolist(), anchors.tolist(), strict=True))
                    found += [(spot >> 8, (spot & 255) + 1, rids[i], words, anchor_at[spot >> 8]) for spot in wanted[i]]
                found.sort(key=lambda segment: segment[0])
                for start, windows, rid, words, anchor in found:
                    content = b" ".join(words[start : start + windows + WINDOW - 1])
                    name = xxhash.xxh3_128_digest(content)
                    k1, k2 = np.frombuffer(name, np.int64).tolist()
                    rows.append((rid, place, start, windows, anchor, k1, k2, None if name in seen else content))
                    seen.add(name)
                if len(rows) > 20_000:
                    yield _batch(rows, names, kinds)
                    rows = []
            if rows:
                yield _batch(rows, names, kinds)

    joined = texts.join(spots, "rid").select("rid", "place", "data", "spots")
    return joined.mapInArrow(cut, SEGMENTS)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def index_shard(texts: list[list[bytes]], places: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For each distinct segment of a shard, the windows that start earlier elsewhere in it.

    `places` and `starts` say where each segment first stands.
    """
    sizes = np.array([len(words) for words in texts])
    numbers = {word: i for i, word in enumerate({w for words in texts for w in words}, 1)}
    # Segments one after another, each closed by a 0 that no pattern holds.
    symbols = np.zeros(int(sizes.sum()) + len(texts), np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    inside = np.arange(len(symbols)) - begins[owner]
    body = inside < sizes[owner]
    symbols[body] = np.fromiter((numbers[w] for words in texts for w in words), np.int64, int(sizes.sum()))
    index = FMIndex(symbols, WINDOW)
    windows = np.flatnonzero(inside <= sizes[owner] - WINDOW)
    matched, low, high = index.repeats(windows, WINDOW)
    hit = np.flatnonzero(matched == WINDOW)
    gone = [np.zeros(0, np.int64)] * len(texts)
    if not len(hit):
        return gone
    # Where each suffix stands in the order of all first places.
    at = np.lexsort((starts[owner] + inside, places[owner]))
    order = np.empty(len(at), np.int64)
    place_of, start_of = places[owner][at], (starts[owner] + inside)[at]
    order[at] = np.cumsum(np.append(False, (place_of[1:] != place_of[:-1]) | (start_of[1:] != start_of[:-1])))
    by_suffix = np.append(order[index.order], np.iinfo(np.int64).max)
    spans, which = np.unique(np.stack([low[hit], high[hit]], axis=1), axis=0, return_inverse=True)
    least = np.minimum.reduceat(by_suffix, spans.reshape(-1))[::2][which.reshape(-1)]
    late = windows[hit[least < order[windows[hit]]]]
    cuts = np.searchsorted(owner[late], np.arange(len(texts) + 1))
    return [inside[late[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


WINDOWS = "h1 long, h2 long, place long, start long, k1 long, k2 long, offset long, known boolean"


def _late_by_hash(segments: DataFrame) -> DataFrame:
    """(k1, k2, offset) of the windows of distinct segments that start earlier in another segment.

    Within a batch, only the first place of a window asks whether there is an earlier one; the others
    are known to be late and travel under keys of their own. So a frequent window is a few rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in WINDOWS.split(", ")]
        for batch in batches:
            digests, counts = [], []
            for content in batch.column(4).to_pylist():
                words = content.split(b" ")
                counts.append(len(words) - WINDOW + 1)
                digests += [xxhash.xxh3_128_digest(b" ".join(words[i : i + WINDOW])) for i in range(counts[-1])]
            if not digests:
                continue
            many = np.array(counts, np.int64)
            k1, k2, place, start = (np.repeat(batch.column(i).to_numpy(), many) for i in range(4))
            offset = np.arange(len(digests)) - np.repeat(np.cumsum(many) - many, many)
            start = start + offset
            h1, h2 = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2).T
            at = np.lexsort((start, place, h2, h1))
            h1, h2, place, start, k1, k2, offset = (x[at] for x in (h1, h2, place, start, k1, k2, offset))
            fresh = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
            first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            known = (place != place[first]) | (start != start[first])
            columns = (np.where(known, k1, h1), np.where(known, k2 + offset, h2), np.where(known, 0, place),
                       np.where(known, 0, start), k1, k2, offset)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(known)], names)

    windows = segments.select("k1", "k2", "place", "start", "words").mapInArrow(cut, WINDOWS)
    # Rows at the first place have rank 1, however many they are.
    rank = F.rank().over(Window.partitionBy("known", "h1", "h2").orderBy("place", "start"))
    return windows.withColumn("rank", rank).where("known OR rank > 1").select("k1", "k2", "offset")


FIRSTS = "k1 long, k2 long, p long, s long, offsets array<long>"


def _holds_twice(words: list[bytes]) -> bool:
    """Whether a window may stand twice in `words`: then each word of the later one stands before it, too."""
    return len(set(words)) <= len(words) - WINDOW


def first_segments(segments: DataFrame) -> DataFrame:
    """(k1, k2, p, s, offsets): each distinct segment, its first place, and its windows that start earlier.

    `segments` has (anchor, k1, k2, place, start, words); rows without words stand behind one of the
    same segment that has them. Words move once, to the shard of their anchor. Equal windows have one
    anchor, so those of anchors with more than HOT rows are settled by themselves, and no shard grows
    without bound.
    """
    rows = segments.where("words IS NOT NULL").select("anchor", "k1", "k2", "place", "start", "words")
    hot = written(rows.groupBy("anchor").agg(F.count("*").alias("many")).where(F.col("many") > HOT).select("anchor"), "hot")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Distinct segments: of the anchor at hand, to be indexed, and settled ones as rows of FIRSTS.
        group: list[tuple] = []
        held: list[tuple] = []
        settled: list[tuple] = []
        size = 0

        def close() -> int:
            """Words of the group, if it is to be indexed."""
            texts = [row[5].split(b" ") for row in group]
            if len(group) == 1 and not _holds_twice(texts[0]):
                settled.append((*group[0][1:5], None))
                more = 0
            else:
                held.extend((*row[1:5], words) for row, words in zip(group, texts, strict=True))
                more = sum(len(words) + 1 for words in texts)
            group.clear()
            return more

        def report() -> pa.RecordBatch:
            if held:
                gone = index_shard([row[4] for row in held], np.array([row[2] for row in held]), np.array([row[3] for row in held]))
                settled.extend((*row[:4], late.tolist()) for row, late in zip(held, gone, strict=True))
            columns = list(zip(*settled, strict=True)) or [()] * 5
            held.clear()
            settled.clear()
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["k1", "k2", "p", "s", "offsets"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[0] != group[-1][0]:
                    size += close()
                    if size >= SHARD_WORDS or len(settled) > 20_000:
                        yield report()
                        size = 0
                # Equal segments stand together, the first place before the others.
                if not group or row[1:3] != group[-1][1:3]:
                    group.append(row)
        if group:
            close()
        if held or settled:
            yield report()

    none_hot = hot.isEmpty()
    cold = rows if none_hot else rows.join(F.broadcast(hot), "anchor", "left_anti").select(*rows.columns)
    sharded = cold.repartition("anchor").sortWithinPartitions("anchor", "k1", "k2", "place", "start")
    found = sharded.mapInArrow(index, FIRSTS)
    if none_hot:
        return found
    distinct = rows.join(F.broadcast(hot), "anchor").groupBy("k1", "k2").agg(
        F.min(F.struct("place", "start")).alias("at"), F.first("words").alias("words")
    )
    distinct = written(distinct.select("k1", "k2", "at.place", "at.start", "words"), "distinct")
    late = _late_by_hash(distinct).groupBy("k1", "k2").agg(F.collect_set("offset").alias("offsets"))
    firsts = distinct.select("k1", "k2", F.col("place").alias("p"), F.col("start").alias("s"))
    return found.unionByName(firsts.join(late, ["k1", "k2"], "left"))


def removed_intervals(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, removals): packed texts, and (rid, gone) with the first words of removed windows.

    gone holds start << 8 | windows - 1 for runs of neighbouring windows.
    """
    texts = _packed_texts(docs)
    segments = written(_cut_segments(texts, candidate_segments(docs)), "segments")
    firsts = first_segments(segments)
    spots = segments.select("rid", "place", "start", "windows", "k1", "k2").join(firsts, ["k1", "k2"])
    whole = F.array(F.shiftleft("start", 8).bitwiseOR(F.col("windows") - 1))
    single = F.transform("offsets", lambda o: F.shiftleft(F.col("start") + o, 8))
    is_first = (F.col("place") == F.col("p")) & (F.col("start") == F.col("s"))
    gone = F.when(~is_first, whole).otherwise(single)
    removals = spots.select("rid", F.explode(gone).alias("spot")).groupBy("rid").agg(F.collect_set("spot").alias("gone"))
    return texts, removals


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document.

    A null text has no words. Places are ordered by doc_id, null ids first, then by word, whatever
    row they are in: rows that repeat an id are one document read more than once, so a repeated row
    does not remove itself. Other columns are not read; an empty table gives an empty result.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc, value, gone in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = unpack.decompress(value.as_py()).split()
                kept = words
                if gone:
                    spots = np.array(gone)
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, spots >> 8, 1)
                    np.add.at(depth, (spots >> 8) + (spots & 255) + WINDOW, -1)
                    kept = [w for w, d in zip(words, np.cumsum(depth[:-1]).tolist(), strict=True) if not d]
                digest = hashlib.sha256(b" ".join(kept)).hexdigest()
                rows.append((doc, len(words), len(words) - len(kept), digest))
            columns = zip(*rows, strict=True) if rows else [()] * 4
            kinds = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    texts, removals = removed_intervals(docs)
    return texts.join(removals, "rid", "left").select("doc_id", "data", "gone").mapInArrow(keep, RESULT)
