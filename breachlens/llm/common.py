"""Helpers shared by the operators on training text."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachlens.sources.workspace import remove_folder, ship_package

__all__ = [
    "WHITE_SPACE", "blocks", "cut_words", "lower_words", "release_memory", "remove_folder", "ship_package", "unused_name", "utf8",
]

#: The white space that ends a word or surrounds a line: space, tab and the four line breaks.
WHITE_SPACE = b" \t\n\r\x0b\x0c"

#: Bytes of a text to words: A-Z become a-z, and all but digits, letters and bytes from 0x80 a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def lower_words(text: bytes | None) -> list[bytes]:
    """Runs of digits, ASCII letters in lower case and non-ASCII characters; none for null."""
    return text.translate(_WORD_BYTES).split() if text else []


def cut_words(texts: list[bytes | None]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, lengths, per text): the words of ``lower_words`` as places in ``data``, which ends in 40 spaces."""
    data = b" ".join([*[(t or b"").translate(_WORD_BYTES) for t in texts], b" " * 40])
    inside = np.frombuffer(data, np.uint8) != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    sizes = np.array([len(t) + 1 if t else 1 for t in texts], np.int64)
    return data, starts, ends - starts, np.diff(np.searchsorted(starts, np.cumsum(sizes)), prepend=0)


@cache
def _c_library() -> ctypes.CDLL | None:
    try:
        library = ctypes.CDLL(None)
        library.malloc_trim
    except (OSError, AttributeError):
        return None
    return library


def release_memory() -> None:
    """Give freed memory of a Python worker back, so that the next task on it starts from little."""
    pa.default_memory_pool().release_unused()
    if library := _c_library():
        library.malloc_trim(0)


def utf8(name: str) -> Column:
    """The text column as UTF-8 bytes, which is how Spark holds it: tasks need not decode it."""
    return F.col(f"`{name}`").cast("binary")


def unused_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def blocks(texts: Iterable[bytes | None], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts that hold at most ``limit`` bytes, or a single text."""
    start, held, at = 0, 0, -1
    for at, text in enumerate(texts):
        size = len(text) if text else 0
        if at > start and held + size > limit:
            yield start, at
            start, held = at, 0
        held += size
    if at >= start:
        yield start, at + 1
