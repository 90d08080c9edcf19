"""SimHash near-duplicates by a grid join of segment popcounts.

A fingerprint of 64 bits is embedded as the numbers of set bits in its 32 two-bit segments. The
Manhattan distance of two embeddings never exceeds the bit distance of the fingerprints, so links
at ``MAX_BITS`` = 4 bits have embeddings at distance 4 or less, and in one half of the segments at 2 or
less. Each distinct fingerprint is entered, per half, in the grid cell of its counts and in all cells
at distance 1: two fingerprints whose half is at distance 2 or less meet in a cell. Those that
meet are compared bit by bit, and each cell passes on a spanning forest of its links, not all pairs.

Equal fingerprints are one entry of the grid, so copies cost nothing there; what a cell holds are
distinct fingerprints only.

Words are runs without white space, A-Z lower-cased; a text with fewer words than a shingle is one
shingle. Null and blank texts have fingerprint 0 and link like others. Each row is a document of its own,
so rows that share an id may lie in different components. Rows without id link too, but never name a
component unless all its rows lack one. An empty table has no fingerprints; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from breachlens.llm.common import unused_name, utf8
from breachlens.llm.components import component_roots
from breachlens.sources import new_folder
from breachlens.sources.layers import write_layer

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Cells up to this size are compared all at once, larger ones around one fingerprint after another.
SMALL_CELL = 32
#: Shingles whose hashes are held at once.
_HASHES = 1 << 18


def fingerprint(text: bytes | None) -> int:
    """Bit i is 1 if it is 1 in over half of the hashes of the text's shingles."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[: n - 1] + 1]).tolist()
    stops = ends[min(len(words), SHINGLE_WORDS) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, _HASHES):
        spans = zip(starts[i : i + _HASHES], stops[i : i + _HASHES])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > n).tolist())


def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series(np.array([fingerprint(text) for text in batch], np.uint64).view(np.int64))


def fingerprints(text: Column) -> Column:
    """The 64 bits as a signed bigint, of UTF-8 bytes."""
    return F.pandas_udf(_fingerprints, "bigint")(text)


# --- grid -----------------------------------------------------------------------
def _popcounts(half: Column) -> Column:
    """Bits set in each two-bit segment of a 32-bit half, each count in the place of its segment."""
    odd = F.lit(0x55555555).cast("bigint")
    return half.bitwiseAND(odd) + F.shiftrightunsigned(half, 1).bitwiseAND(odd)


def _cells(fp: Column) -> Column:
    """(half, counts) of the grid cells in which a fingerprint is entered."""
    cells = []
    for number, half in enumerate((fp.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")), F.shiftrightunsigned(fp, 32))):
        counts, tag = _popcounts(half), F.lit(number << 32).cast("bigint")
        cells.append(counts + tag)
        for segment in range(16):
            one = F.lit(1 << 2 * segment).cast("bigint")
            here = F.shiftrightunsigned(counts, 2 * segment).bitwiseAND(F.lit(3).cast("bigint"))
            cells.append(F.when(here < 2, counts + one + tag))
            cells.append(F.when(here > 0, counts - one + tag))
    return F.array_compact(F.array(*cells))


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= MAX_BITS


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a graph that already join all that its links join: each node and its root."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _large_cell(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forest of one cell: what is near a reached fingerprint is reached and not looked at again."""
    left, a, b, todo = fps, [], [], []
    while len(left):
        if not todo:
            todo.append(left[0])
            left = left[1:]
        at = todo.pop()
        near = _near(left, at)
        found, left = left[near], left[~near]
        a.append(found)
        b.append(np.full(len(found), at))
        todo += list(found)
    return (np.concatenate(a), np.concatenate(b)) if a else (fps[:0], fps[:0])


def cell_links(cell: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints that share a cell; ``cell`` is sorted, its cells are complete."""
    edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    sizes = np.diff(edges, append=len(cell))
    a, b = [fps[:0]], [fps[:0]]
    for start, size in zip(edges[sizes > SMALL_CELL].tolist(), sizes[sizes > SMALL_CELL].tolist()):
        x, y = _large_cell(fps[start : start + size])
        a.append(x)
        b.append(y)
    rank = np.arange(len(cell)) - np.repeat(edges, sizes)
    rest = np.repeat(sizes, sizes) - rank  # entries of the cell from this one on
    at = np.flatnonzero(np.repeat(sizes, sizes) <= SMALL_CELL)
    for step in range(1, SMALL_CELL):
        at = at[rest[at] > step]
        if not len(at):
            break
        near = at[_near(fps[at], fps[at + step])]
        a.append(fps[near])
        b.append(fps[near + step])
    return _forest(np.concatenate(a), np.concatenate(b))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows that come sorted by cell; the last cell of a batch waits for the next one."""

    def out(cell: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        a, b = cell_links(cell, fps.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    cells, fps = [], []
    for batch in batches:
        cell, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(cell):
            continue
        if cell[-1] != (cells[0] if cells else cell)[0]:
            last = np.searchsorted(cell, cell[-1])
            yield out(np.concatenate([*cells, cell[:last]]), np.concatenate([*fps, fp[:last]]))
            cells, fps, cell, fp = [], [], cell[last:], fp[last:]
        cells.append(cell)
        fps.append(fp)
    if cells:
        yield out(np.concatenate(cells), np.concatenate(fps))


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints in column ``fp`` that join all those which lie at
    ``MAX_BITS`` bits or less, directly or over others."""
    entered = fps.select(F.explode(_cells(F.col("fp"))).alias("cell"), "fp")
    met = entered.repartition("cell").sortWithinPartitions("cell")
    return met.mapInArrow(_linked, "a bigint, b bigint").distinct()


def _first_of_each(spark: SparkSession, rows: DataFrame, first: Column, folder: str) -> tuple[DataFrame, DataFrame]:
    """((fp, root) of each fingerprint, (root, first) with the least ``first`` of each component)."""
    fps = write_layer(rows.groupBy("fp").agg(F.min(first).alias("first")), f"{folder}/fingerprints")
    roots = component_roots(spark, links(fps.select("fp")))
    of = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return of.select("fp", "root"), of.groupBy("root").agg(F.min("first").alias("first"))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest id it is linked with)."""
    folder = new_folder(spark, "simhash")
    rows = write_layer(
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), fingerprints(utf8(text_col)).alias("fp")), f"{folder}/documents"
    )
    of, least = _first_of_each(spark, rows, F.col("doc_id"), folder)
    named = of.join(least, "root").select("fp", F.col("first").alias("component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one_row_of_each(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that with the smallest id, one without id only if
    all lack one. Rows get a key of their own, which decides between equal ids, and are written with it."""
    folder, key, fp = new_folder(spark, "simhash"), unused_name(docs, "row_key"), unused_name(docs, "row_fp")
    keyed = docs.select("*", F.monotonically_increasing_id().alias(key), fingerprints(utf8(text_col)).alias(fp))
    keyed = write_layer(keyed, f"{folder}/documents")
    doc_id = F.col(f"`{id_col}`")
    rows = keyed.select(F.col(fp).alias("fp"), F.struct(doc_id.isNull(), doc_id.alias("doc_id"), F.col(key).alias("key")).alias("row"))
    _, least = _first_of_each(spark, rows, F.col("row"), folder)
    kept = least.select(F.col("first.key").alias(key))
    return keyed.join(kept, key, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
