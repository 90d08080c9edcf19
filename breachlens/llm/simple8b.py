"""Simple-8b coding of unsigned integers into 64-bit words.

The four high bits of a word select how many values its other 60 bits hold, all of one width. A word
with selector 15 is an escape: the next word holds one value as it is. Values are coded in blocks
of ``BLOCK`` that start at a word of their own; the offsets of the blocks let them be decoded one by
one, and all at once.
"""

from __future__ import annotations

import numpy as np

#: Values per word, by selector.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = 15
#: Values of a block.
BLOCK = 32768
_POWERS = np.array([1 << n for n in range(64)], np.uint64)
_WIDTHS = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), "right").astype(np.uint8)


def _word_sizes(values: np.ndarray) -> np.ndarray:
    """How many of the values from each position on a word would take; 0 where an escape is due."""
    n = len(values)
    width = np.zeros(n + 64, np.uint8)
    small = values < len(_WIDTHS)
    width[:n] = _WIDTHS[np.where(small, values, 0).astype(np.uint16)]
    width[:n][~small] = np.searchsorted(_POWERS, values[~small], "right")
    most = {1: width}
    for count in sorted(COUNTS)[1:]:  # largest width among the next ``count``, from two shorter runs
        half = max(c for c in most if 2 * c >= count and c < count)
        wide = most[half].copy()
        np.maximum(wide[: len(wide) - (count - half)], most[half][count - half :], out=wide[: len(wide) - (count - half)])
        most[count] = wide
    size = (width <= 60).view(np.uint8)
    for count in sorted(COUNTS)[1:]:
        np.maximum(size, (most[count] <= 60 // count).view(np.uint8) * np.uint8(count), out=size)
    return size[:n]


def encode_block(values: np.ndarray) -> np.ndarray:
    """Words of one block; zeros fill up the last word."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    sizes = _word_sizes(values).tobytes()
    starts, at = [], 0
    add = starts.append
    while at < n:
        add(at)
        at += sizes[at] or 1
    start = np.array(starts, np.int64)
    size = np.frombuffer(sizes, np.uint8)[start].astype(np.int64)
    place = np.arange(len(start)) + np.cumsum(size == 0) - (size == 0)
    words = np.zeros(len(start) + int((size == 0).sum()), np.uint64)
    padded = np.concatenate([values, np.zeros(64, np.uint64)])
    for selector, count in enumerate(COUNTS):
        mine = size == count
        if mine.any():
            first, packed = start[mine], np.full(int(mine.sum()), selector << 60, np.uint64)
            for i in range(count):
                packed |= padded[first + i] << np.uint64(i * (60 // count))
            words[place[mine]] = packed
    escaped = size == 0
    words[place[escaped]] = np.uint64(ESCAPE << 60)
    words[place[escaped] + 1] = values[start[escaped]]
    return words


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, offsets): the offset of each block's first word."""
    coded = [encode_block(values[i : i + BLOCK]) for i in range(0, len(values), BLOCK)]
    lengths = np.array([len(c) for c in coded], np.int64)
    return np.concatenate([np.empty(0, np.uint64), *coded]), np.cumsum(lengths) - lengths


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of all blocks (or of some consecutive ones, with offsets into ``words``)."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    last = -1
    for at in np.flatnonzero(selector == ESCAPE).tolist():
        if at != last:  # else this is the value of the escape before it
            raw[at + 1] = True
            last = at + 1
    count = np.array([*COUNTS, 0, 0], np.int64)[selector]
    count[raw] = 1
    # values stand before each word: what earlier words of its block hold, after all earlier blocks
    before = np.cumsum(count) - count
    block = np.repeat(np.arange(len(offsets)), np.diff(offsets, append=len(words)))
    place = before - before[offsets][block] + block * BLOCK if len(words) else before
    limit = np.minimum((block + 1) * BLOCK, n)
    out = np.empty(n + 64, np.uint64)
    out[place[raw]] = words[raw]
    for number, size in enumerate(COUNTS):
        mine = np.flatnonzero((selector == number) & ~raw)
        if len(mine):
            bits = 60 // size
            mask = np.uint64((1 << bits) - 1)
            ends = place[mine] + size > limit[mine]  # last words of blocks, filled up with zeros
            first, held = place[mine][~ends], words[mine][~ends]
            for i in range(size):
                out[first + i] = held >> np.uint64(i * bits) & mask
            for at in mine[ends].tolist():
                left = int(limit[at] - place[at])
                out[place[at] : limit[at]] = words[at] >> np.arange(left, dtype=np.uint64) * np.uint64(bits) & mask
    return out[:n]
