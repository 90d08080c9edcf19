"""Suffix arrays of byte strings, in numpy."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` (below 2 GB) sorted by the ``depth`` bytes (or more) that begin there.

    Larsson-Sadakane refinement: places are first sorted by 8 bytes; then, in rounds, groups of places
    that still agree are sorted by the ranks of the places as far ahead as their order already
    reaches, which doubles that reach. Places alone in their group are not touched again.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.ndarray(n, ">u8", padded, strides=(1,)).astype(np.uint64)
    order = np.argsort(key, kind="stable").astype(np.int32)
    key = key[order]
    at, new = np.arange(n, dtype=np.int32), np.concatenate([np.ones(min(n, 1), bool), key[1:] != key[:-1]])
    rank = np.empty(n, np.int32)
    reach = 8
    while True:
        # ``at`` are the slots of ``order`` just sorted, ``new`` whether a group begins in them
        group = at[np.maximum.accumulate(np.where(new, np.arange(len(at), dtype=np.int32), 0))]
        rank[order[at]] = group
        alone = new & np.concatenate([new[1:], np.ones(min(len(new), 1), bool)])
        at = at[~alone]
        if not len(at) or reach >= depth:
            return order
        place = order[at]
        ahead = place + reach
        then = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[place].astype(np.int64) << 32 | then
        sorting = np.argsort(key, kind="stable")
        order[at] = place[sorting]
        key = key[sorting]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        reach *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, up to ``depth`` or a little more, that each entry of ``order`` shares with the one before it.

    Kasai's rule: a place shares at least one byte less with its forerunner than the place
    before it did. It is followed along all strings (at ``starts``, of ``lengths``, filling the text) at once.
    Places that agree in ``depth`` bytes, or up to the text's end, may stand in any order, so nothing is
    concluded from those.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    words = np.ndarray(n + depth + 8, "<u8", padded, strides=(1,))
    before = np.empty(n, np.int32)
    before[order[1:]] = order[:-1]
    if n:
        before[order[0]] = -1
    shared = np.zeros(n, np.int32)
    lanes = np.argsort(-lengths, kind="stable")  # long strings first, so that lanes end from behind
    starts, lengths = starts[lanes], lengths[lanes]
    known = np.zeros(len(starts), np.int64)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        live = int(np.searchsorted(-lengths, -step, "left"))
        place = starts[:live] + step
        other = before[place]
        length = np.maximum(known[:live] - 1, 0)
        todo = np.flatnonzero((other >= 0) & (length < depth))
        length[other < 0] = 0
        while len(todo):
            differ = words[place[todo] + length[todo]] ^ words[other[todo] + length[todo]]
            equal = np.where(differ == 0, 8, np.bitwise_count((differ & -differ) - np.uint64(1)) >> 3)
            length[todo] += equal
            todo = todo[(equal == 8) & (length[todo] < depth)]
        room = n - np.maximum(place, other)
        shared[place] = np.minimum(length, room)
        known[:live] = np.where((length < depth) & (length < room), length, 0)
    return shared[order]
