"""Removal of repeated byte strings with suffix arrays.

Every byte is removed that a string of ``LENGTH`` bytes covers which also starts in a document with a
smaller id. Such strings are found in a number of steps that each grow with the text:

1. Texts are packed into segments of bounded size. Each string of ``LENGTH`` bytes has an anchor, the
   ``ANCHOR`` bytes in it with the least hash: equal strings have equal anchors. Neighbouring strings
   with one anchor form a passage. Segments send the hashes of their anchors to shards by hash, which
   answer with a bit for each that is known from two documents.
2. Segments send their distinct passages around such anchors to the anchors' shards. A shard sorts
   its passages in suffix arrays of bounded size (Larsson-Sadakane refinement, Kasai's common prefixes),
   reads off for each distinct string the smallest id that holds it, and merges its arrays by binary
   search for the strings of one in the others.
3. An anchor with very many distinct passages (a common phrase with varying text around it) has no shard of
   its own. Each segment sorts its passages in suffix arrays of its own and deals their distinct strings, in
   order, over all shards by the strings' hash; there the arrays of all segments are merged by binary search.
4. The answers go back to the segments, which cut the texts.

Copies of a passage are merged per segment before anything is sent, so a passage that stands in most
documents costs its shard one entry per segment, and a shard has a bounded number of distinct passages per anchor.
Anchors and hashes only route: what is removed rests on the comparison of all bytes.

Null and empty texts have no bytes. Rows with one id are one document and do not remove each other's
bytes. Rows without id come after all others and are one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachlens.llm.common import utf8
from breachlens.llm.pretokens import mixed
from breachlens.llm.suffix_arrays import common_prefixes, suffix_order
from breachlens.sources import new_folder
from breachlens.sources.layers import write_layer

#: Bytes of a string whose repetition removes it.
LENGTH = 50
ANCHOR = 24


class Sizes(NamedTuple):
    """Bounds that decide how the work is divided, never what is removed."""

    #: text bytes of a segment; a longer document is a segment of its own
    segment: int = 4 << 20
    #: places whose anchors are found together
    chunk: int = 1 << 20
    #: text bytes per shard of anchors
    shard: int = 8 << 20
    #: passage bytes of one suffix array
    array: int = 2 << 20
    #: text bytes per task of a shuffle, if that makes more tasks than the session's shuffles have
    task: int = 64 << 20
    #: an anchor is common from so many distinct passages on, beyond one per segment,
    common: int = 1 << 10
    #: or so many summed over all segments
    common_entries: int = 1 << 16


#: Bytes of an anchor's hash that are sent. A shard has a bounded number of anchors, and two that
#: agree by chance only have their passages compared in vain.
_SENT_BYTES = 5
_LAST_ID = (1 << 63) - 1

SEGMENT = "segment bigint, n_bytes bigint, doc_ids array<bigint>, sizes array<bigint>, data binary"
RESULT = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary"


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays with their types and lengths, compressed."""
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    return _pack(len(head).to_bytes(4, "little") + head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpack_arrays(data: bytes) -> list[np.ndarray]:
    data = _unpack(data)
    at = 4 + int.from_bytes(data[:4], "little")
    out = []
    for part in data[4:at].decode().split(";"):
        kind, n = part.split(",")
        out.append(np.frombuffer(data, kind, int(n), at))
        at += out[-1].nbytes
    return out


# --- segments -------------------------------------------------------------------
_SEGMENT_ARROW = pa.schema(
    [("segment", pa.int64()), ("n_bytes", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("data", pa.binary())]
)


def _segment_batches(sizes: Sizes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    made, held, ids, texts = 0, 0, [], []

    def out() -> pa.RecordBatch:
        row = [task << 32 | made, held, ids, [len(t) for t in texts], _pack(b"".join(texts))]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SEGMENT_ARROW)], schema=_SEGMENT_ARROW)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or b""
            if ids and held + len(text) > sizes.segment:
                yield out()
                made, held, ids, texts = made + 1, 0, [], []
            ids.append(doc_id)
            texts.append(text)
            held += len(text)
    if ids:
        yield out()


class _Segment:
    """The texts of a segment and its passages: runs of neighbouring strings with one anchor."""

    def __init__(self, row: pd.Series, chunk: int):
        self.chunk = chunk
        self.raw = _unpack(row["data"])
        self.text = np.frombuffer(self.raw, np.uint8)
        self.doc_ids = [None if i is None or i != i else int(i) for i in row["doc_ids"]]
        #: ids in the order that decides who keeps a string
        self.keys = np.array([_LAST_ID if i is None else i for i in self.doc_ids], np.int64)
        self.sizes = np.array(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        found = [self._passages(a) for a in range(0, max(1, len(self.text)), chunk)]
        self.start, self.count, self.anchor = (np.concatenate(part) for part in zip(*found))
        self.key = self.keys[np.searchsorted(self.ends, self.start, "right")] if len(self.start) else self.start

    def _passages(self, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first string, number of strings, hash of the anchor) of the passages that begin in a chunk."""
        part = self.text[first : first + self.chunk + LENGTH - 1]
        n = len(part) - LENGTH + 1
        if n <= 0:
            empty = np.empty(0, np.int64)
            return empty, empty, empty.astype(np.uint64)
        words = np.ndarray(len(part) - 7, "<u8", part, strides=(1,))
        places = len(part) - ANCHOR + 1
        h = words[:places] * np.uint64(0x9E3779B97F4A7C15)
        for offset in (8, 16):  # ANCHOR is 24
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[offset : offset + places]
        h = mixed(h)
        least = h & np.uint64(0xFFFFFFFF00000000) | np.arange(places, dtype=np.uint64)
        width, span = 1, LENGTH - ANCHOR + 1
        while 2 * width <= span:  # least of ``width`` neighbours; the place in its low half makes the first one win
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: n], least[span - width : span - width + n])
        at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # strings that lie in one document
        inside = np.ones(n, bool)
        for end in self.ends[np.searchsorted(self.ends, first, "right") : np.searchsorted(self.ends, first + len(part), "left")].tolist():
            inside[max(0, end - LENGTH + 1 - first) : max(0, end - first)] = False
        begins = inside.copy()
        begins[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
        start = np.flatnonzero(begins)
        stops = np.flatnonzero(inside & ~np.concatenate([inside[1:] & ~begins[1:], [False]]))
        # anchors have small hashes; mixed once more, they spread over all shards
        return start + first, stops - start + 1, mixed(h[at[start]] ^ np.uint64(0x632BE59BD9B4E019))

    def strings(self, which: np.ndarray) -> list[bytes]:
        stops = self.start[which] + self.count[which] + LENGTH - 1
        return [self.raw[a:b] for a, b in zip(self.start[which].tolist(), stops.tolist())]

    def windows(self, places: np.ndarray) -> np.ndarray:
        """The strings of ``LENGTH`` bytes at ``places``."""
        return np.ndarray(max(0, len(self.text) - LENGTH + 1), f"S{LENGTH}", self.text, strides=(1,))[places]

    def distinct(self, order: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Number of distinct passages of each anchor; ``order`` sorts by anchor, ``first`` begins each anchor's."""
        sizes = np.diff(np.append(first, len(order)))
        several = np.repeat(sizes > 1, sizes)
        codes = np.repeat(np.arange(len(sizes)), sizes)[several]
        seen: set[bytes] = set()
        new = [not (s in seen or seen.add(s)) for s in self.strings(order[several])]
        counts = np.bincount(codes[np.array(new, bool)], minlength=len(sizes))
        return np.where(sizes > 1, counts, 1).astype(np.uint32)


def _shards(anchors: np.ndarray, n_shards: int) -> np.ndarray:
    return ((anchors >> np.uint64(32)) * np.uint64(n_shards) >> np.uint64(32)).astype(np.int64)


def _cuts(shards: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(shard, its slice) of ascending shards."""
    edges = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])) if len(shards) else shards
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(shards)]):
        yield int(shards[a]), slice(a, b)


# --- anchors --------------------------------------------------------------------
def _send_anchors(n_shards: int, sizes: Sizes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                segment, out = _Segment(row, sizes.chunk), []
                order = np.argsort(segment.anchor, kind="stable")
                anchor, key = segment.anchor[order], segment.key[order]
                first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else order
                if len(first):
                    several = np.minimum.reduceat(key, first) < np.maximum.reduceat(key, first)
                    distinct = segment.distinct(order, first)
                    for shard, cut in _cuts(_shards(anchor[first], n_shards)):
                        sent = anchor[first][cut].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_SENT_BYTES]
                        out.append((shard, row["segment"], _pack_arrays(sent.reshape(-1), several[cut], distinct[cut])))
                yield pd.DataFrame(out, columns=["shard", "segment", "data"])

    return run


def _answer_anchors(sizes: Sizes, key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Two bits for each sent anchor: whether two documents or more have it, and whether it is a common one."""
    sent = []
    for low, several, distinct in (_unpack_arrays(d) for d in rows["data"]):
        whole = np.zeros((len(several), 8), np.uint8)
        whole[:, :_SENT_BYTES] = low.reshape(-1, _SENT_BYTES)
        sent.append((whole.view("<u8")[:, 0], several, distinct))
    hashes, several, distinct = (np.concatenate(part) for part in zip(*sent))
    codes, anchors = pd.factorize(hashes)
    holders = np.bincount(codes, minlength=len(anchors))
    entries = np.bincount(codes, distinct, len(anchors))
    known = holders > 1
    known[codes[several]] = True
    common = (entries - holders >= sizes.common) | (entries >= sizes.common_entries)
    edges = np.cumsum([len(a) for a, *_ in sent])[:-1]
    bits, commons = (
        [np.packbits(part).tobytes() for part in np.split(flags[codes], edges)] for flags in (known, known & common)
    )
    n = [len(a) for a, *_ in sent]
    return pd.DataFrame({"segment": rows["segment"].to_numpy(), "shard": key[0], "n": n, "bits": bits, "common": commons})


# --- passages -------------------------------------------------------------------
def _merged(segment: _Segment, which: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(distinct strings, a passage that spells each, its smallest holder, its largest) of some passages."""
    first: dict[bytes, int] = {}
    number = np.array([first.setdefault(s, len(first)) for s in segment.strings(which)], np.int64)
    least, most = np.full(len(first), _LAST_ID), np.full(len(first), -_LAST_ID - 1)
    np.minimum.at(least, number, segment.key[which])
    np.maximum.at(most, number, segment.key[which])
    source = np.empty(len(first), np.int64)
    source[number[::-1]] = which[::-1]
    return list(first), source, least, most


def _deal(strings: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each string of ``LENGTH`` bytes, by its hash."""
    rows = np.ascontiguousarray(strings).view(np.uint8).reshape(-1, LENGTH)
    h = np.zeros(len(rows), np.uint64)
    for at in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        h = mixed(h ^ np.ascontiguousarray(rows[:, at : at + 8]).view("<u8")[:, 0])
    return _shards(mixed(h ^ np.uint64(0x632BE59BD9B4E019)), n_shards)


def _common_strings(segment: _Segment, which: np.ndarray, number: int, n_shards: int, array: int) -> list[tuple[int, int, bytes]]:
    """The distinct strings of passages with common anchors, from suffix arrays, in order for each shard of strings.

    Shards of strings are numbered after those of anchors. With each string go a place of it and its
    smallest and largest holder.
    """
    out = []
    passages, source, least, most = _merged(segment, which)
    sizes = np.array([len(p) for p in passages], np.int64)
    cut = np.cumsum(sizes) // array
    edges = [0, *(np.flatnonzero(cut[1:] != cut[:-1]) + 1).tolist(), len(passages)] if passages else []
    for a, b in zip(edges[:-1], edges[1:]):
        strings, low, owner_string = sorted_strings(passages[a:b], least[a:b])
        owner, place = _windows(sizes[a:b])
        begins = np.cumsum(sizes[a:b]) - sizes[a:b]
        example, high = np.empty(len(strings), np.int64), np.full(len(strings), -_LAST_ID - 1)
        example[owner_string] = place - begins[owner] + segment.start[source[a:b]][owner]
        np.maximum.at(high, owner_string, most[a:b][owner])
        shards = _deal(strings, n_shards)
        order = np.argsort(shards, kind="stable")  # keeps the strings of a shard in order
        for shard, part in _cuts(shards[order]):
            mine = order[part]
            data = _pack_arrays(strings[mine].view(np.uint8), example[mine], low[mine], high[mine])
            out.append((n_shards + shard, number, data))
    return out


def _answer_strings(rows: pd.DataFrame) -> pd.DataFrame:
    """Per segment the places of strings that a smaller holder removes, and that holder."""
    sent = [_unpack_arrays(d) for d in rows["data"]]
    lows = [least.copy() for _, _, least, _ in sent]
    merge_sorted([(text.view(f"S{LENGTH}"), low) for (text, *_), low in zip(sent, lows)])
    out = []
    for segment, (_, place, _, most), low in zip(rows["segment"], sent, lows):
        removing = low < most
        if removing.any():
            out.append((segment, True, _pack_arrays(place[removing], low[removing])))
    return pd.DataFrame(out, columns=["segment", "common", "data"])


def _send_passages(n_shards: int, sizes: Sizes):
    def run(key: tuple, segments: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(segments) and len(answers):
            segment = _Segment(segments.iloc[0], sizes.chunk)
            answers = answers.sort_values("shard")
            known, common = (
                np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(answers[c], answers["n"])]).astype(bool)
                for c in ("bits", "common")
            )
            anchors, codes = np.unique(segment.anchor, return_inverse=True)
            out += _common_strings(segment, np.flatnonzero(common[codes]), key[0], n_shards, sizes.array)
            strings, source, least, most = _merged(segment, np.flatnonzero((known & ~common)[codes]))
            shards = _shards(segment.anchor[source], n_shards)
            order = np.argsort(shards, kind="stable")
            for shard, cut in _cuts(shards[order]):
                mine = order[cut]
                parts = [strings[i] for i in mine.tolist()]
                lengths = np.array([len(p) for p in parts], np.int32)
                anchor = segment.anchor[source[mine]].astype(np.uint32)
                data = _pack_arrays(
                    np.frombuffer(b"".join(parts), np.uint8), lengths, anchor, source[mine], least[mine], most[mine]
                )
                out.append((shard, key[0], data))
        return pd.DataFrame(out, columns=["shard", "segment", "data"])

    return run


def _windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, place in the joined strings) of every string of ``LENGTH`` bytes in passages of ``sizes``."""
    n = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(sizes)), n)
    return owner, np.arange(int(n.sum())) + np.repeat(np.cumsum(sizes) - sizes - np.cumsum(n) + n, n)


def sorted_strings(
    passages: list[bytes], holders: np.ndarray, spelled: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct strings in order, smallest holder of each, number of each passage's strings in that list).

    The strings themselves, which only a merge needs, are left out unless ``spelled``. One suffix array over the joined passages; neighbours that share ``LENGTH`` bytes are one string.
    """
    text = np.frombuffer(b"".join(passages), np.uint8)
    sizes = np.array([len(p) for p in passages], np.int64)
    order = suffix_order(text, LENGTH)
    shared = common_prefixes(text, order, np.cumsum(sizes) - sizes, sizes, LENGTH)
    owner, place = _windows(sizes)
    group = np.empty(len(text), np.int64)
    group[order] = np.cumsum(shared < LENGTH)
    kept, number = np.unique(group[place], return_inverse=True)
    least = np.full(len(kept), _LAST_ID)
    np.minimum.at(least, number, holders[owner])
    if not spelled:
        return np.empty(0, f"S{LENGTH}"), least, number
    example = np.empty(len(kept), np.int64)
    example[number] = place
    strings = np.ndarray(max(0, len(text) - LENGTH + 1), f"S{LENGTH}", text, strides=(1,))[example]
    return strings, least, number


def merge_sorted(arrays: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Give each string, in all the sorted arrays that hold it, the smallest of its holders there.

    Each array's strings are looked for by binary search in the ordered union of all.
    """
    if len(arrays) < 2:
        return
    union = np.concatenate([strings for strings, _ in arrays])
    union.sort(kind="stable")
    union = union[np.concatenate([[True], union[1:] != union[:-1]])] if len(union) else union
    low = np.full(len(union), _LAST_ID)
    places = [np.searchsorted(union, strings) for strings, _ in arrays]
    for at, (_, least) in zip(places, arrays):
        low[at] = np.minimum(low[at], least)
    for at, (_, least) in zip(places, arrays):
        least[:] = low[at]


def _lowest_holders(passages: list[bytes], holders: np.ndarray, codes: np.ndarray, array: int) -> np.ndarray:
    """Smallest holder of each string, passage by passage; equal strings have passages with one code.

    The passages come sorted by code.
    """
    cut = np.cumsum([len(p) for p in passages]) // array
    edges = [0, *(np.flatnonzero(cut[1:] != cut[:-1]) + 1).tolist(), len(passages)]
    joined = [codes[e - 1] == codes[e] for e in edges[1:-1]]  # whether arrays share a code with the next one
    arrays = []
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        spelled = any(joined[max(0, i - 1) : i + 1])
        arrays.append(sorted_strings(passages[a:b], holders[a:b], spelled))
    start = 0
    for i in range(len(arrays)):
        if i == len(joined) or not joined[i]:
            merge_sorted([(strings, least) for strings, least, _ in arrays[start : i + 1]])
            start = i + 1
    return np.concatenate([least[number] for _, least, number in arrays])


def _answer_passages(n_shards: int, sizes: Sizes, key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Per segment the smallest holder of each string of its passages, if it removes one there.

    Equal strings have one anchor. So the strings of a passage that is the only one of its anchor stand
    in it alone, and its smallest holder is theirs. The other passages are sorted by anchor and go into
    suffix arrays of bounded size; arrays between which an anchor's passages are split are merged.
    Shards of strings have their strings in order already.
    """
    if key[0] >= n_shards:
        return _answer_strings(rows)
    number: dict[bytes, int] = {}
    sent = []
    for segment, data in zip(rows["segment"], rows["data"]):
        text, lengths, anchor, source, least, most = _unpack_arrays(data)
        text, ends = text.tobytes(), np.cumsum(lengths)
        own = [number.setdefault(text[b - n : b], len(number)) for b, n in zip(ends.tolist(), lengths.tolist())]
        sent.append((segment, np.array(own, np.int64), source, least, most, anchor))
    passages = list(number)
    holders, anchors = np.full(len(passages), _LAST_ID), np.empty(len(passages), np.uint32)
    for _, own, _, least, _, anchor in sent:
        np.minimum.at(holders, own, least)
        anchors[own] = anchor
    counts = np.array([len(p) for p in passages], np.int64) - LENGTH + 1
    codes, _ = pd.factorize(anchors)
    several = np.flatnonzero(np.bincount(codes)[codes] > 1)
    several = several[np.argsort(codes[several], kind="stable")]
    low, high, first = holders.copy(), holders.copy(), np.zeros(len(passages), np.int64)
    lowest = np.empty(0, np.int64)
    if len(several):
        lowest = _lowest_holders([passages[i] for i in several.tolist()], holders[several], codes[several], sizes.array)
        first[several] = at = np.cumsum(counts[several]) - counts[several]
        low[several], high[several] = np.minimum.reduceat(lowest, at), np.maximum.reduceat(lowest, at)
    out = []
    for segment, own, source, _, most, _ in sent:
        own, source = own[most > low[own]], source[most > low[own]]
        if len(own):
            even = low[own] == high[own]
            n = counts[own[~even]]
            at = np.arange(int(n.sum())) + np.repeat(first[own[~even]] - np.cumsum(n) + n, n)
            out.append((segment, False, _pack_arrays(source[even], low[own[even]], source[~even], n, lowest[at])))
    return pd.DataFrame(out, columns=["segment", "common", "data"])


# --- texts ----------------------------------------------------------------------
def _mark_strings(segment: _Segment, answers: list[bytes], marks: np.ndarray) -> None:
    """Mark the strings of common anchors that the answers remove, looking for each by binary search."""
    place, low = (np.concatenate(part) for part in zip(*(_unpack_arrays(d) for d in answers)))
    strings = segment.windows(place)
    order = np.argsort(strings, kind="stable")
    strings, low = strings[order], low[order]
    anchors = segment.anchor[np.searchsorted(segment.start, place, "right") - 1]
    which = np.flatnonzero(np.isin(segment.anchor, anchors))
    total = np.cumsum(segment.count[which])
    for part in np.split(which, np.flatnonzero(np.diff(total // (segment.chunk >> 2))) + 1):
        count = segment.count[part]
        at = np.arange(int(count.sum())) + np.repeat(segment.start[part] - np.cumsum(count) + count, count)
        own = segment.windows(at)
        found = np.minimum(np.searchsorted(strings, own), len(strings) - 1)
        at = at[(strings[found] == own) & (np.repeat(segment.key[part], count) > low[found])]
        marks[at] += 1
        marks[at + LENGTH] -= 1


def _cut_texts(sizes: Sizes, key: tuple, segments: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    out = []
    if len(segments):
        segment = _Segment(segments.iloc[0], sizes.chunk)
        marks = np.zeros(len(segment.text) + 1, np.int64)
        common = answers["common"].to_numpy(bool)
        if common.any():
            _mark_strings(segment, answers["data"][common].tolist(), marks)
        if not common.all():
            parts = [_unpack_arrays(d) for d in answers["data"][~common]]
            even, low, uneven, n, lows = (np.concatenate(p) for p in zip(*parts))
            source = np.concatenate([even, uneven])
            limits = [*low.tolist(), *np.split(lows, np.cumsum(n)[:-1])] if len(uneven) else low.tolist()
            answer = dict(zip(segment.strings(source), limits))
            which = np.flatnonzero(np.isin(segment.anchor, segment.anchor[source]))
            for passage, string in zip(which.tolist(), segment.strings(which)):
                limit = answer.get(string)
                if limit is None:
                    continue
                start = segment.start[passage]
                removed = segment.key[passage] > limit
                if isinstance(limit, int):
                    if removed:
                        marks[start] += 1
                        marks[start + len(string)] -= 1
                else:
                    at = start + np.flatnonzero(removed)
                    marks[at] += 1
                    marks[at + LENGTH] -= 1
        gone = np.cumsum(marks[:-1]) > 0
        for doc_id, end, size in zip(segment.doc_ids, segment.ends.tolist(), segment.sizes.tolist()):
            own = gone[end - size : end]
            if own.any():
                edges = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
                spans = [{"start": a, "stop": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
                kept = segment.text[end - size : end][~own].tobytes()
            else:
                spans, kept = [], segment.raw[end - size : end]
            out.append((doc_id, size, spans, kept))
    found = pd.DataFrame(out, columns=["doc_id", "n_bytes", "spans", "kept"])
    return found.astype({"doc_id": "Int64"})


def remove_repeats(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: Sizes = Sizes()
) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (the removed runs, in bytes) and kept (the bytes that stay)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), utf8(text_col).alias("text"))
    segments = write_layer(rows.mapInArrow(partial(_segment_batches, sizes), SEGMENT), new_folder(spark, "segments"))
    total = segments.agg(F.sum("n_bytes")).first()[0] or 0
    n_shards = max(8, -(-total // sizes.shard))
    width = max(min(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-total // sizes.task))
    sent = "shard bigint, segment bigint, data binary"
    by_segment = segments.repartition(width, "segment").groupBy("segment")
    anchors = segments.mapInPandas(_send_anchors(n_shards, sizes), sent).repartition(width, "shard")

    def answer_anchors(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _answer_anchors(sizes, key, rows)

    def answer_passages(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _answer_passages(n_shards, sizes, key, rows)

    def cut(key: tuple, held: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        return _cut_texts(sizes, key, held, answered)

    answers = anchors.groupBy("shard").applyInPandas(
        answer_anchors, "segment bigint, shard bigint, n bigint, bits binary, common binary"
    )
    answers = answers.repartition(width, "segment").groupBy("segment")
    passages = by_segment.cogroup(answers).applyInPandas(_send_passages(n_shards, sizes), sent).repartition(width, "shard")
    lowest = passages.groupBy("shard").applyInPandas(answer_passages, "segment bigint, common boolean, data binary")
    lowest = lowest.repartition(width, "segment").groupBy("segment")
    return by_segment.cogroup(lowest).applyInPandas(cut, RESULT)
