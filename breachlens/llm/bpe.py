"""Byte-level BPE encoding and decoding by a rank file, with a two-tier lookup.

Pre-tokens that are whole vocabulary entries (most of a text) are resolved for a batch at once by
a minimal perfect hash over the vocabulary, confirmed byte by byte. The others are merged from
single bytes, lowest rank first and leftmost among equals, with a heap over linked parts; a bounded
cache keeps results of pre-tokens seen before, until the task ends.

Null and empty texts have no ids. What is not UTF-8 becomes U+FFFD before it is encoded. Encoded
ids are little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column

from pyspark.sql import functions as F

from breachlens.llm.common import blocks, release_memory
from breachlens.llm.pretokens import WORD_BYTES, cut_pretokens, distinct_pieces, mixed, piece_words, valid_utf8

#: Text bytes that are encoded together.
BLOCK_BYTES = 2 << 20
#: Merged pre-tokens that a task remembers.
CACHE_ENTRIES = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Entries and ids of a rank file: lines of base64 text and number."""
    lines = Path(path).read_bytes().split(b"\n")
    return {base64.b64decode(entry): int(rank) for entry, rank in (line.split() for line in lines if line)}


class PerfectHash:
    """Minimal perfect hash of byte strings to 0..n-1: levels of slots that one remaining key hits alone."""

    def __init__(self, keys: list[bytes]):
        self.levels: list[np.ndarray] = []
        data = b"".join(keys) + bytes(WORD_BYTES + 8)
        lengths = np.array([len(k) for k in keys], np.int64)
        starts = np.cumsum(lengths) - lengths
        h, words = piece_words(data, starts, lengths)
        left, placed = np.arange(len(keys)), 0
        index = np.empty(len(keys), np.int64)
        while len(left):
            slot = self._slot(h[left], len(self.levels), 2 * len(left))
            alone = np.bincount(slot, minlength=2 * len(left))[slot] == 1
            level = np.full(2 * len(left), -1, np.int32)
            index[left[alone]] = placed + np.arange(alone.sum())
            level[slot[alone]] = index[left[alone]]
            placed += int(alone.sum())
            self.levels.append(level)
            left = left[~alone]
        self.order = np.argsort(index)  # key at each index
        self.lengths = lengths[self.order]
        self.words = [w[self.order] for w in words]

    @staticmethod
    def _slot(h: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(h + np.uint64(0x632BE59BD9B4E019 * (level + 1) & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def find(self, data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of each piece's key in the list the hash was built from; -1 for other pieces."""
        h, words = piece_words(data, starts, lengths)
        index = np.full(len(starts), -1, np.int64)
        left = np.arange(len(starts))
        for number, level in enumerate(self.levels):
            found = level[self._slot(h[left], number, len(level))]
            index[left[found >= 0]] = found[found >= 0]
            left = left[found < 0]
            if not len(left):
                break
        same = (index >= 0) & (lengths <= WORD_BYTES)
        at = np.where(same, index, 0)
        same &= self.lengths[at] == lengths
        for mine, theirs in zip(self.words, words):
            same &= mine[at] == theirs
        return np.where(same, self.order[at], -1)


class Coder:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        entries = list(ranks)
        short = [e for e in entries if len(e) <= WORD_BYTES]
        self.hash = PerfectHash(short)
        self.short_ids = np.array([ranks[e] for e in short], np.uint32)
        by_id = {i: e for e, i in ranks.items()}
        size = max(by_id) + 1
        self.lengths = np.array([len(by_id.get(i, b"")) for i in range(size)], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(size)), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.merged, self.ends = array("I"), array("q", [0])

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks, n = self.ranks, len(piece)
        if piece in ranks:
            return [ranks[piece]]
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, start, middle, stop = heappop(heap)
            if end[start] != middle or end[middle] != stop:
                continue  # one of the parts has grown or gone
            end[start], end[middle], before[stop] = stop, -1, start
            if stop < n and (r := ranks.get(piece[start : end[stop]])) is not None:
                heappush(heap, (r, start, stop, end[stop]))
            left = before[start]
            if left >= 0 and (r := ranks.get(piece[left:stop])) is not None:
                heappush(heap, (r, left, start, stop))
        out, at = [], 0
        while at < n:
            out.append(ranks[piece[at : end[at]]])
            at = end[at]
        return out

    def _slots(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers under which the ids of distinct pieces are kept; unseen pieces are merged first."""
        known = self.slots
        slots = list(map(known.get, pieces))
        for i, slot in enumerate(slots):
            if slot is None:
                slots[i] = known[pieces[i]] = len(known)
                self.merged.extend(self.merge(pieces[i]))
                self.ends.append(len(self.merged))
        return np.array(slots, np.int64)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        data, starts, lengths, per_text = cut_pretokens(texts)
        found = self.hash.find(data, starts, lengths)
        missed = np.flatnonzero(found < 0)
        if len(self.slots) > CACHE_ENTRIES:
            self.forget()
        codes, places = distinct_pieces(data, starts[missed], lengths[missed])
        begins, ends = starts[missed][places], (starts + lengths)[missed][places]
        slots = self._slots([data[a:b] for a, b in zip(begins.tolist(), ends.tolist())])[codes]
        ends, merged = np.array(self.ends), np.array(self.merged, np.uint32)
        counts = np.ones(len(starts), np.int64)
        counts[missed] = ends[slots + 1] - ends[slots]
        at = np.cumsum(counts) - counts
        ids = np.empty(int(counts.sum()), np.uint32)
        hit = found >= 0
        ids[at[hit]] = self.short_ids[found[hit]]
        n = counts[missed]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ids[np.repeat(at[missed], n) + within] = merged[np.repeat(ends[slots], n) + within]
        edges = np.append(at, len(ids))[np.cumsum(per_text) - per_text]
        return np.split(ids, edges[1:]) if texts else []

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.lengths[ids]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.data[np.repeat(self.offsets[ids], n) + within].tobytes()


@cache
def _coder(ranks: bytes) -> Coder:
    lines = (line.split() for line in ranks.split(b"\n") if line)
    return Coder({base64.b64decode(entry): int(rank) for entry, rank in lines})


def _task(ranks: bytes, batches: Iterator[pd.Series], of_block) -> Iterator:
    """What ``of_block`` makes of a coder and the ids of each block of texts. What the coder has learnt goes with the task."""
    coder = _coder(ranks)
    try:
        for batch in batches:
            for found in encode_texts(coder, batch.tolist()):
                yield of_block(coder, found)
    finally:
        coder.forget()
        release_memory()


def encode_texts(coder: Coder, texts: list[bytes | None]) -> Iterator[list[np.ndarray]]:
    """Ids of each text, in blocks of bounded size."""
    for start, stop in blocks(texts, BLOCK_BYTES):
        yield coder.encode([valid_utf8(t) for t in texts[start:stop]])


def _binary(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def encode(text: Column, ranks_path: str) -> Column:
    """Ids of the UTF-8 bytes in ``text`` as binary; the rank file is read here and sent to the tasks."""
    ranks = Path(ranks_path).read_bytes()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _task(ranks, batches, lambda _, found: pd.Series([_binary(ids) for ids in found], dtype=object))

    return F.pandas_udf(run, "binary")(text)


def decode(ids: Column, ranks_path: str) -> Column:
    """The bytes that encoded ids stand for; null stays null."""
    ranks = Path(ranks_path).read_bytes()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if x is None else _coder(ranks).decode(np.frombuffer(x, "<u4")) for x in batch], dtype=object)

    return F.pandas_udf(run, "binary")(ids)


def encode_and_decode(text: Column, ranks_path: str) -> Column:
    """struct(ids, decoded): a round trip in one Python worker, where two would hold the texts twice."""
    ranks = Path(ranks_path).read_bytes()

    def both(coder: Coder, found: list[np.ndarray]) -> pd.DataFrame:
        sent = [_binary(ids) for ids in found]
        return pd.DataFrame({"ids": sent, "decoded": [coder.decode(np.frombuffer(x, "<u4")) for x in sent]})

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _task(ranks, batches, both)

    return F.pandas_udf(run, "ids binary, decoded binary")(text)
