"""A compressed full-text index over sequences of numbers: the Burrows-Wheeler transform in a wavelet matrix.

Built once over a shard, it is asked with whole batches: every step of a backward search is taken for
all patterns of a batch together, in numpy.
"""

from __future__ import annotations

import numpy as np


class BitRank:
    """A packed bit vector that counts the set bits before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(counts) - counts).astype(np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Occurrences of a symbol before any place of a sequence; a bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels, self.zeros = [], []
        for shift in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            bits = ((symbols >> shift) & 1).astype(bool)
            self.levels.append((shift, BitRank(bits)))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Place below all levels; the difference of two such places counts the symbol between them."""
        for (shift, rank), zeros in zip(self.levels, self.zeros, strict=True):
            ones = rank.ones(at)
            at = np.where((symbols >> shift) & 1, zeros + ones, at - ones)
        return at


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of what stands there, compared over at least `depth` symbols."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    count, reach = len(symbols), 1
    order = np.argsort(rank, kind="stable")
    while reach < depth:
        following = np.zeros(count, np.int64)
        following[: count - reach] = rank[reach:] + 1
        both = rank * (count + 1) + following
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        rank = np.empty(count, np.int64)
        rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
        reach *= 2
    return order


class FMIndex:
    """Index over `symbols` (non-negative) that answers patterns of up to `depth` symbols."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.symbols = symbols.astype(np.int64)
        self.order = suffix_order(self.symbols, depth)
        largest = int(self.symbols.max(initial=0))
        counts = np.bincount(self.symbols, minlength=largest + 1)
        self.first = np.cumsum(counts) - counts
        # The symbol before each suffix; the text is closed to a ring, which patterns never cross.
        self.tree = WaveletMatrix(self.symbols[self.order - 1], largest)
        names = np.arange(largest + 1)
        self.first -= self.tree.down(names, np.zeros(largest + 1, np.int64))

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
        """Intervals of the patterns with `symbols` put before them."""
        shift = self.first[symbols]
        return shift + self.tree.down(symbols, low), shift + self.tree.down(symbols, high)

    def repeats(self, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the index's own text, up to `length`.

        For the `length` symbols from each of `starts`, backwards from their end: (matched, low,
        high), how many of the last symbols also stand elsewhere, and, where all do, the interval
        of `order` that holds all places where they stand.
        """
        matched = np.zeros(len(starts), np.int64)
        low_at, high_at = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        going = np.arange(len(starts))
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.symbols))
        for back in range(length - 1, -1, -1):
            low, high = self.step(self.symbols[starts[going] + back], low, high)
            more = high - low > 1
            going, low, high = going[more], low[more], high[more]
            matched[going] += 1
            if not len(going):
                break
        else:
            low_at[going], high_at[going] = low, high
        return matched, low_at, high_at
