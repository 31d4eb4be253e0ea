"""Simple-8b coding of unsigned integers in numpy: many small values to a 64-bit word.

The upper four bits of a word select how many values it holds and how wide they are. Values are
coded in blocks of `BLOCK`, each starting with a word of its own, so blocks can be decoded apart. A
value that needs more than 60 bits is escaped: selector 15, and the value in the next word.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
# (values in a word, bits of each), by selector.
SELECTORS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
    (4, 15), (3, 20), (2, 30), (1, 60),
)
ESCAPE = 15
_MOST = SELECTORS[0][0]
_TOGETHER = 256  # blocks that are coded side by side
_COUNTS = np.zeros(16, np.int64)
_COUNTS[: len(SELECTORS)] = [count for count, _ in SELECTORS]
_COUNTS[ESCAPE] = 1
_SELECTOR_OF = {count: selector for selector, (count, _) in enumerate(SELECTORS)}


_SHORT = np.array([max(1, i.bit_length()) for i in range(1 << 16)], np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, at least one."""
    widths = _SHORT[values & np.uint64(0xFFFF)]
    for part in (1, 2, 3):
        upper = values >> np.uint64(16 * part)
        there = upper > 0
        if not there.any():
            break
        low = _SHORT[upper[there] & np.uint64(0xFFFF)] + np.uint8(16 * part)
        widths[there] = np.where(upper[there] & np.uint64(0xFFFF), low, widths[there])
    return widths


def _reach(widths: np.ndarray) -> np.ndarray:
    """For each place of each block, how many values the best word from there holds."""
    columns = widths.shape[1] - _MOST
    maxima = {1: widths}

    def longest(count: int) -> np.ndarray:
        if count not in maxima:
            head = max(c for c in maxima if c < count)
            rest = count - head
            tail = longest(rest)
            size = min(maxima[head].shape[1], tail.shape[1] - head)
            maxima[count] = np.maximum(maxima[head][:, :size], tail[:, head : head + size])
        return maxima[count]

    take = np.ones((widths.shape[0], columns), np.uint8)
    for count, bits in reversed(SELECTORS):
        take[longest(count)[:, :columns] <= bits] = count
    return take


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, offsets): the coded words, and the first word of each block of BLOCK values."""
    words, offsets, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for low in range(0, len(values), _TOGETHER * BLOCK):
        some, starts = _encode(values[low : low + _TOGETHER * BLOCK].astype(np.uint64))
        words.append(some)
        offsets.append(starts + at)
        at += len(some)
    return np.concatenate(words), np.concatenate(offsets)


def _encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blocks = -(-len(values) // BLOCK)
    padded = np.zeros((blocks, BLOCK + _MOST), np.uint64)
    body = np.zeros(blocks * BLOCK, np.uint64)
    body[: len(values)] = values
    padded[:, :BLOCK] = body.reshape(blocks, BLOCK)
    take = _reach(_widths(padded))
    ends = np.full(blocks, BLOCK)
    ends[-1] = len(values) - (blocks - 1) * BLOCK
    # All blocks step ahead together, a word each.
    block, place = np.arange(blocks), np.zeros(blocks, np.int64)
    steps = []
    while len(block):
        count = take[block, place]
        steps.append((block, place, count))
        place = place + count
        going = place < ends[block]
        block, place = block[going], place[going]
    block, place, count = (np.concatenate(part) for part in zip(*steps, strict=True))
    order = np.argsort(block, kind="stable")
    block, place, count = block[order], place[order], count[order]
    flat = padded.reshape(-1)
    start = block * (BLOCK + _MOST) + place
    escaped = (count == 1) & (flat[start] >= np.uint64(1 << 60))
    slot = np.arange(len(start)) + np.cumsum(escaped) - escaped
    words = np.zeros(len(start) + int(escaped.sum()), np.uint64)
    for number, bits in SELECTORS:
        rows = np.flatnonzero((count == number) & ~escaped)
        if len(rows):
            word = np.full(len(rows), _SELECTOR_OF[number] << 60, np.uint64)
            for i in range(number):
                word |= flat[start[rows] + i] << np.uint64(i * bits)
            words[slot[rows]] = word
    words[slot[escaped]] = np.uint64(ESCAPE << 60)
    words[slot[escaped] + 1] = flat[start[escaped]]
    first = np.append(True, block[1:] != block[:-1])
    return words, slot[first]


def decode(words: np.ndarray, offsets: np.ndarray, total: int) -> np.ndarray:
    """The `total` values that `words` hold."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selectors == ESCAPE).tolist():
        if not raw[at]:
            raw[at + 1] = True
    counts = np.where(raw, 0, _COUNTS[selectors])
    before = np.cumsum(counts) - counts
    block = np.zeros(len(words), np.int64)
    block[offsets[1:]] = 1
    block = np.cumsum(block)
    inside = before - before[offsets][block] if len(words) else before
    # The last word of a block may hold more places than values: each block has room for them.
    out = np.zeros((len(offsets), BLOCK + _MOST), np.uint64)
    flat = out.reshape(-1)
    start = block * (BLOCK + _MOST) + inside
    for selector, (number, bits) in enumerate(SELECTORS):
        rows = np.flatnonzero((selectors == selector) & ~raw)
        if not len(rows):
            continue
        mask = np.uint64((1 << bits) - 1)
        coded, at = words[rows], start[rows]
        for i in range(number):
            flat[at + i] = (coded >> np.uint64(i * bits)) & mask
    rows = np.flatnonzero((selectors == ESCAPE) & ~raw)
    flat[start[rows]] = words[rows + 1]
    return out[:, :BLOCK].reshape(-1)[:total]
