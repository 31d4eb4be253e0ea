"""Periodic runs of words: stretches in which a phrase repeats at least four times over.

Internal pattern matching, on numpy arrays, for many documents at once: their words are numbered
and laid one after the other, each document closed by a number of its own. Prefix doubling names all stretches
of 1, 2, 4, ... words and ends in a suffix array, where the places of a stretch are one interval. Every
dyadic block, of length B at a multiple of B, asks for its nearest occurrence on either side: range
successor and predecessor in its interval, by a wavelet matrix over the suffix array.

Occurrences of a block that lie within its own length form a progression, and its difference is a period.
If a run has smallest period q and at least 4 q words, the longest dyadic block of at most 2 q words lies in it
once aligned, and has an occurrence q words to its right or left that is also the nearest: so the
two nearest ones give every run. A candidate is extended both ways as far as words a period
apart are equal, by the names of the dyadic stretches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm.tables import text_bytes

MIN_WORDS = 6
MIN_TIMES = 4
# Documents are taken together until they have so many words; a longer one is alone.
GROUP_WORDS = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SuffixArray:
    """Suffixes of `symbols` in an order that tells apart stretches of up to `longest` symbols.

    `names[k][i]` is the name of the stretch of 2^k symbols at i: the place in the order of the first
    suffix that begins so. `sizes[k][i]` is the number of suffixes that do.
    """

    def __init__(self, symbols: np.ndarray, longest: int):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        self.names: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        names, sizes = self._named(order, np.arange(n), symbols[order], np.zeros(n, np.int64), np.ones(n, np.int64))
        self.names.append(names)
        self.sizes.append(sizes)
        length = 1
        while length < longest:
            # Only suffixes that share their name with another can move, within their interval.
            open_ = np.flatnonzero(sizes[order] > 1)
            suffixes = order[open_]
            after = suffixes + length
            # The last symbol is like no other, so a suffix that ends here is alone already.
            key = names[suffixes] * (n + 1) + names[np.minimum(after, n - 1)]
            turn = np.argsort(key, kind="stable")
            order = order.copy()
            order[open_] = suffixes[turn]
            names, sizes = self._named(order[open_], open_, key[turn], names.copy(), sizes.copy())
            self.names.append(names)
            self.sizes.append(sizes)
            length *= 2
        self.order = order

    @staticmethod
    def _named(suffixes, places, keys, names, sizes) -> tuple[np.ndarray, np.ndarray]:
        if len(keys):
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            group = np.diff(np.append(heads, len(keys)))
            names[suffixes] = np.repeat(places[heads], group)
            sizes[suffixes] = np.repeat(group, group)
        return names, sizes


class WaveletMatrix:
    """Order statistics of stretches of a permutation, all queries of an array at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        values = values.astype(np.int32)
        for bit in range(self.bits - 1, -1, -1):
            ones = ((values >> bit) & 1).astype(bool)
            counted = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~ones, out=counted[1:])
            self.zeros.append(counted)
            values = np.concatenate([values[~ones], values[ones]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values in each [low, high) are less than `value`."""
        total = np.zeros(len(low), np.int64)
        for depth, zeros in enumerate(self.zeros):
            low0, high0 = zeros[low], zeros[high]
            one = ((value >> (self.bits - 1 - depth)) & 1).astype(bool)
            total += np.where(one, high0 - low0, 0)
            low = np.where(one, low - low0 + zeros[-1], low0)
            high = np.where(one, high - high0 + zeros[-1], high0)
        return total

    def smallest(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of rank `rank` (from 0) in each [low, high)."""
        value = np.zeros(len(low), np.int64)
        for zeros in self.zeros:
            low0, high0 = zeros[low], zeros[high]
            here = high0 - low0
            one = rank >= here
            rank = np.where(one, rank - here, rank)
            value = (value << 1) | one
            low = np.where(one, low - low0 + zeros[-1], low0)
            high = np.where(one, high - high0 + zeros[-1], high0)
        return value


def _nearest(index: SuffixArray, wavelet: WaveletMatrix, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of the blocks of 2^level words whose nearest occurrence, on either side, is near."""
    size = 1 << level
    blocks = np.arange(0, len(index.order), size)
    blocks = blocks[index.sizes[level][blocks] > 1]
    low = index.names[level][blocks]
    high = low + index.sizes[level][blocks]
    rank = wavelet.below(low, high, blocks)
    found_blocks, distances = [], []
    for step in (1, -1):
        there = (low + rank + step < high) & (rank + step >= 0)
        other = wavelet.smallest(low[there], high[there], rank[there] + step)
        distance = np.abs(other - blocks[there])
        near = distance <= size
        found_blocks.append(np.minimum(other, blocks[there])[near])
        distances.append(distance[near])
    return np.concatenate(found_blocks), np.concatenate(distances)


def _extension(names: list[np.ndarray], here: np.ndarray, there: np.ndarray, way: int) -> np.ndarray:
    """How many symbols agree from each pair of places on, rightwards, or leftwards before them."""
    n = len(names[0])
    length = np.zeros(len(here), np.int64)
    top = len(names) - 1
    going = np.arange(len(here))
    level = top
    while level >= 0:
        size = 1 << level
        if way > 0:
            a, b = here[going] + length[going], there[going] + length[going]
            inside = b < n
        else:
            a, b = here[going] - length[going] - size, there[going] - length[going] - size
            inside = a >= 0
        same = np.zeros(len(going), bool)
        same[inside] = names[level][a[inside]] == names[level][b[inside]]
        length[going[same]] += size
        if level == top and same.any():
            going = going[same]  # the longest stretch may fit more than once
            continue
        if level == top:
            going = np.arange(len(here))
        level -= 1
    return length


def runs_of(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    `symbols` numbers words from 0; every document in it, none longer than `longest`, ends with a symbol of its own.
    """
    none = np.zeros((0, 3), np.int64)
    widest = longest // MIN_TIMES * 2  # twice the longest period
    if longest < MIN_WORDS or widest < 2:
        return none
    levels = int(widest).bit_length() - 1
    index = SuffixArray(symbols, 1 << levels)
    wavelet = WaveletMatrix(index.order)
    pairs = [_nearest(index, wavelet, level) for level in range(1, levels + 1)]
    place = np.concatenate([p for p, _ in pairs])
    period = np.concatenate([d for _, d in pairs])
    if not len(place):
        return none
    left = _extension(index.names, place, place + period, -1)
    right = _extension(index.names, place, place + period, 1)
    start, length = place - left, left + right + period
    enough = (length >= MIN_WORDS) & (length >= MIN_TIMES * period)
    rows = np.unique(np.stack([start[enough], length[enough], period[enough]], axis=1), axis=0)
    if len(rows):
        # Of one stretch the smallest period counts.
        rows = rows[np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])]
        rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return rows


@dataclass
class Found:
    words: int
    runs: np.ndarray
    collapsed: bytes


def collapse(texts: list[bytes]) -> list[Found]:
    """Words, runs and the text without repeats, of each text."""
    split = [text.split() for text in texts]
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    out: list[Found] = []
    low = 0
    while low < len(split):
        high, total = low, 0
        while high < len(split) and (high == low or total + len(split[high]) < GROUP_WORDS):
            total += len(split[high]) + 1
            high += 1
        numbers.clear()
        numbers.default_factory = count(high - low).__next__
        symbols = np.empty(total, np.int64)
        starts, at = [], 0
        for own, words in enumerate(split[low:high]):
            starts.append(at)
            symbols[at : at + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
            at += len(words)
            symbols[at] = own
            at += 1
        rows = runs_of(symbols, max(map(len, split[low:high])))
        cuts = np.searchsorted(rows[:, 0], [*starts, total])
        for own, words in enumerate(split[low:high]):
            mine = rows[cuts[own] : cuts[own + 1]].copy()
            mine[:, 0] -= starts[own]
            if len(mine):
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, mine[:, 0] + mine[:, 2], 1)
                np.add.at(change, mine[:, 0] + mine[:, 1], -1)
                kept = np.cumsum(change[:-1]) == 0
                words = [word for word, keep in zip(words, kept.tolist(), strict=True) if keep]
            out.append(Found(len(split[low + own]), mine, b" ".join(words)))
        low = high
    return out


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document (doc_id, text).

    Words are what white space (0x20, 0x09 to 0x0D) leaves. A run is a stretch of words with smallest period q, at least
    6 and at least 4 q words long, that neither neighbour extends; `runs` lists them by start, then period, and `collapsed` is the text without the
    words that stand in a run after its first q, one blank apart.

    A null or empty text has no words, no runs and an empty `collapsed`. Whole texts are searched, a
    very long one by itself, in memory that grows with its own length. Runs that overlap, nest or tie in length are all listed.
    Repeated rows and rows without an id are answered as often as they occur; other columns are not
    read; an empty table gives no row. Nothing is shuffled.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch):
                found = collapse([value.as_py() for value in part.column(1)])
                ends = np.cumsum([0, *[len(f.runs) for f in found]]).astype(np.int32)
                rows = np.concatenate([f.runs for f in found])
                structs = pa.StructArray.from_arrays(
                    [pa.array(rows[:, i]) for i in range(3)], ["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([f.words for f in found], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), structs),
                        pa.array([f.collapsed.decode() for f in found], pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("data"))
    return rows.mapInArrow(search, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def _portions(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each, so that a task holds few at a time."""
    sizes = np.cumsum([len(value.as_buffer()) for value in batch.column(1)])
    low = 0
    while low < batch.num_rows:
        done = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, done + limit)))
        yield batch.slice(low, high - low)
        low = high


def with_cycles(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where the end of every tenth document repeats a phrase, by a hash of its id.

    With h the crc32 of the id, g = h div 10 and n words: if 10 divides h, the words from a = g mod n on are
    replaced by the p = 1 + (n - a) div (3 + g mod 8) words that begin there, over and over.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.floor(h / 10).alias("g"),
        # Cut into words only where the words change.
        F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("words"),
    )
    n = F.size("words").cast("bigint")
    a = F.col("g") % F.greatest(n, F.lit(1))
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))

    def part(values: Column | str, start: Column, length: Column) -> Column:
        return F.slice(values, start.cast("int"), length.cast("int"))

    times = F.ceil((n - a) / p).cast("int")
    tail = part(F.flatten(F.array_repeat(part("words", a + 1, p), times)), F.lit(1), n - a)
    changed = F.array_join(F.concat(part("words", F.lit(1), a), tail), " ")
    return chosen.select("doc_id", F.when(F.size("words") > 0, changed).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Runs of each document counted and digested, with the longest (least start, then period, of equals)."""
    runs = F.col("runs")
    # Least by (-length, start, period).
    best = F.array_min(
        F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    )
    lines = F.array_join(
        F.transform(
            runs, lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")])
        ),
        "\n",
    )
    text = F.when(F.size(runs) > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return (
        found.withColumn("best", best)
        .select(
            "doc_id", F.size(runs).cast("bigint").alias("n_runs"),
            F.col("best.s").alias("start"), (-F.col("best.l")).alias("length"), F.col("best.p").alias("period"),
            F.floor(F.lit(-1000) * F.col("best.l") / F.col("best.p")).cast("bigint").alias("exponent_milli"),
            F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )


def periodic_digests(docs: DataFrame) -> DataFrame:
    return digests(periodic_runs(with_cycles(docs)))
