"""Pre-tokens of byte-level BPE, cut from whole batches of UTF-8 texts with numpy.

The cuts are those of the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``:
runs of letters, numbers, other characters and white space; the last character of white space
before something else stands alone, or begins the next run if it is a space; and a contraction
that begins a run of its own is cut after its letters.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pandas as pd
import xxhash

_END, _LETTER, _NUMBER, _SPACE, _OTHER = range(5)
#: Stands between texts; no UTF-8 text holds it.
_BETWEEN = 0xFF
#: No letter or number of Unicode has this code point or a higher one.
_LETTERS_END = 0x34000
#: The white space of Unicode.
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@cache
def _kinds() -> np.ndarray:
    """Kind of every code point."""
    of = {"L": _LETTER, "N": _NUMBER}
    kinds = np.full(0x110000, _OTHER, np.uint8)
    kinds[:_LETTERS_END] = [of.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(_LETTERS_END)]
    kinds[_WHITE] = _SPACE
    return kinds


def valid_utf8(text: bytes | None) -> bytes:
    """The text, with U+FFFD for what is not UTF-8; null as empty."""
    if not text:
        return b""
    if not text.isascii():
        try:
            text.decode()
        except UnicodeDecodeError:
            return text.decode(errors="replace").encode()
    return text


def _kinds_of_bytes(data: np.ndarray) -> np.ndarray:
    """Kind of the character that each byte belongs to."""
    kinds = _kinds()
    table = np.full(256, _END, np.uint8)
    table[:128] = kinds[:128]
    out = table[data]
    lead = np.flatnonzero((data >= 0xC0) & (data != _BETWEEN))
    if len(lead):
        first = data[lead].astype(np.int64)
        tail = [data[lead + i].astype(np.int64) & 63 for i in (1, 2, 3)]
        width = 2 + (first >= 0xE0) + (first >= 0xF0)
        point = np.select(
            [width == 2, width == 3],
            [(first & 31) << 6 | tail[0], (first & 15) << 12 | tail[0] << 6 | tail[1]],
            (first & 7) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2],
        )
        kind = kinds[point]
        out[lead] = kind
        for i in (1, 2, 3):
            out[lead[width > i] + i] = kind[width > i]
    return out


def cut_pretokens(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, lengths, per text): pre-tokens as places in ``data``, in order, and their number in each text."""
    data_bytes = bytes([_BETWEEN]).join([*texts, bytes([_BETWEEN]) * 32])
    data = np.frombuffer(data_bytes, np.uint8)
    kind = _kinds_of_bytes(data)
    cut = np.ones(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    cut |= kind == _END
    runs = np.flatnonzero(cut)
    # white space before something else
    at = np.flatnonzero((kind[runs[:-1]] == _SPACE) & (kind[runs[1:]] != _END))
    begin, end = runs[at], runs[at + 1]
    last = end - 1
    for _ in range(2):
        last -= (data[last] & 0xC0) == 0x80
    cut[last] = True
    cut[end[data[last] == 32]] = False
    # contractions
    quote = np.flatnonzero((data == 39) & cut)
    quote = quote[kind[quote + 1] == _LETTER]
    one, two = data[quote + 1], data[quote + 2]
    size = np.where(np.isin(one, list(b"stmd")), 1, 0)
    size[((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)] = 2
    quote, size = quote[size > 0], size[size > 0]
    cut[quote + 1] = False
    cut[quote + 1 + size] = True
    runs = np.flatnonzero(cut)
    lengths = np.diff(runs, append=len(data))
    real = kind[runs] != _END
    starts, lengths = runs[real], lengths[real]
    sizes = np.array([len(t) for t in texts], np.int64)
    edges = np.searchsorted(starts, np.cumsum(sizes + 1))
    return data_bytes, starts, lengths, np.diff(edges, prepend=0)


# --- equal pieces ---------------------------------------------------------------
#: Bytes of a piece that are compared as four 8-byte words.
WORD_BYTES = 32
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits mixed."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _two_words(data: bytes, starts: np.ndarray, lengths: np.ndarray, first: int) -> list[np.ndarray]:
    """Two 8-byte words of each piece from byte ``first`` on, zero beyond its end."""
    view = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    out = []
    for offset in (first, first + 8):
        at = np.minimum(starts + offset, len(view) - 1)
        out.append(view[at] & _MASKS[np.clip(lengths - offset, 0, 8)])
    return out


def piece_words(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(hash of the length and first ``WORD_BYTES`` bytes, those bytes as four words) of each piece.

    ``data`` must go on for as many bytes behind the last piece.
    """
    words = _two_words(data, starts, lengths, 0)
    h = mixed(words[0] ^ mixed(lengths.astype(np.uint64)))
    h = mixed(h ^ words[1])
    more = np.flatnonzero(lengths > 16)
    rest = [np.zeros(len(starts), np.uint64) for _ in range(2)]
    if len(more):
        for word, part in zip(rest, _two_words(data, starts[more], lengths[more], 16)):
            word[more] = part
            h[more] = mixed(h[more] ^ part)
    return h, words + rest


def distinct_pieces(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each piece, place of a piece with each code): equal pieces, and only those, share a code."""
    h, words = piece_words(data, starts, lengths)
    for i in np.flatnonzero(lengths > WORD_BYTES).tolist():
        h[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]])
    codes, seen = pd.factorize(h)
    first = np.empty(len(seen), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    same = lengths == lengths[first[codes]]
    for word in words:
        same &= word == word[first[codes]]
    for i in np.flatnonzero(same & (lengths > WORD_BYTES)).tolist():
        a, b, n = starts[i], starts[first[codes[i]]], lengths[i]
        same[i] = data[a : a + n] == data[b : b + n]
    others: dict[bytes, int] = {}
    places = first.tolist()
    for i in np.flatnonzero(~same).tolist():  # equal hashes of different pieces
        piece = data[starts[i] : starts[i] + lengths[i]]
        if piece not in others:
            others[piece] = len(places)
            places.append(i)
        codes[i] = others[piece]
    return codes, np.array(places, np.int64)


class PieceTable:
    """Numbers given to pieces of up to ``SHORT`` bytes, kept in sorted arrays: some 30 bytes a piece, no objects."""

    SHORT = 16

    def __init__(self) -> None:
        empty = np.empty(0, np.uint64)
        self.hash, self.words, self.lengths, self.numbers = empty, [empty, empty], np.empty(0, np.uint8), np.empty(0, np.int32)

    def find(self, data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 where the table has none."""
        out = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(lengths <= self.SHORT)
        if len(short) and len(self.hash):
            h, words = piece_words(data, starts[short], lengths[short])
            at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            same = (self.hash[at] == h) & (self.lengths[at] == lengths[short])
            for mine, theirs in zip(self.words, words):
                same &= mine[at] == theirs
            out[short[same]] = self.numbers[at[same]]
        return out

    def add(self, data: bytes, starts: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> None:
        """Keep the numbers of distinct pieces that the table lacks; longer ones are passed over."""
        short = lengths <= self.SHORT
        h, words = piece_words(data, starts[short], lengths[short])
        h = np.concatenate([self.hash, h])
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.words = [np.concatenate([mine, new])[order] for mine, new in zip(self.words, words)]
        self.lengths = np.concatenate([self.lengths, lengths[short].astype(np.uint8)])[order]
        self.numbers = np.concatenate([self.numbers, numbers[short].astype(np.int32)])[order]
