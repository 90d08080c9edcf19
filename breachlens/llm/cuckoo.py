"""A cuckoo filter over 16-byte digests, filled, probed and emptied in bulk."""

from __future__ import annotations

import numpy as np

SLOTS = 4
#: Share of the slots that may be planned for; beyond it moving entries about gets long.
LOAD = 0.75
_ROUNDS = 500


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; an entry may stand in either of two buckets.

    Never denies a key that was added and not removed. If entries can't be placed, the filter
    becomes ``open``: it then admits every key until it is built anew.
    """

    def __init__(self, table: np.ndarray, is_open: bool = False):
        self.table, self.open = table, is_open

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, "<u2", offset=1).reshape(-1, SLOTS).copy(), data[:1] == b"\1")

    def dump(self) -> bytes:
        return (b"\1" if self.open else b"\0") + self.table.astype("<u2").tobytes()

    def _places(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        mark = (words[:, 0] % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
        return mark, (words[:, 1] & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        mixed = mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return bucket ^ ((mixed >> np.uint64(20)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def holds(self, keys: list[bytes]) -> np.ndarray:
        if self.open or not keys:
            return np.ones(len(keys), bool)
        mark, bucket = self._places(keys)
        first = (self.table[bucket] == mark[:, None]).any(1)
        return first | (self.table[self._other(mark, bucket)] == mark[:, None]).any(1)

    def add(self, keys: list[bytes]) -> None:
        """Adds keys that the filter does not hold yet; all are placed at once, round by round."""
        if self.open or not keys:
            return
        mark, bucket = self._places(keys)
        rng = np.random.default_rng(len(keys))
        for step in range(_ROUNDS):
            order = np.argsort(bucket, kind="stable")
            mark, bucket = mark[order], bucket[order]
            new = np.concatenate([[True], bucket[1:] != bucket[:-1]])
            rank = np.arange(len(bucket)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            free = self.table[bucket] == 0
            fits = rank < free.sum(1)
            slot = (np.cumsum(free, 1) == rank[:, None] + 1).argmax(1)
            self.table[bucket[fits], slot[fits]] = mark[fits]
            mark, bucket, rank = mark[~fits], bucket[~fits], rank[~fits]
            if not len(mark):
                return
            if step:  # push out an entry per full bucket; the others wait for the next round
                _, one = np.unique(bucket, return_index=True)
                at = rng.integers(0, SLOTS, len(one))
                mark = mark.copy()
                mark[one], self.table[bucket[one], at] = self.table[bucket[one], at], mark[one].copy()
                bucket[one] = self._other(mark[one], bucket[one])
            else:
                bucket = self._other(mark, bucket)
        self.open = True

    def remove(self, keys: list[bytes]) -> None:
        """Removes keys that were added, one entry for each."""
        if self.open or not keys:
            return
        mark, bucket = self._places(keys)
        for m, b, c in zip(mark, bucket, self._other(mark, bucket)):
            for place in (b, c):
                found = np.flatnonzero(self.table[place] == m)
                if len(found):
                    self.table[place, found[0]] = 0
                    break
