"""Product codes of embedding vectors, by Lloyd rounds that look again only at what can have changed.

Each component becomes an integer, each vector ``PARTS`` parts, and each part the index of its nearest
entry in the codebook of its position. Between rounds an entry is replaced by the mean of its parts.
A part's row keeps its entry and the exact distance to it. If that entry did not move, the distance
still holds and the other entries at rest have lost already, so the part is compared with the moved
entries only (active entries); if it moved, the part is compared with all. Ties go to the lower index
in both cases, so the result is that of comparing all with all in every round.

Integers are exact throughout: distances come from a float64 product where all its values stay below
2^53, and from int64 otherwise. What reaches the driver are the codebooks (``PARTS`` x ``ENTRIES``
rows), never vectors; each round writes the vectors with their codes once, in the order in which they
came, and sums the parts of each entry in the tasks before anything is shuffled.

Vectors that are null or hold null or non-finite components are dropped. The length of the vectors is
that of the kept vector with the smallest id whose length is a multiple of ``PARTS``. Kept vectors of
another length, or with components of ``LIMIT`` / 1024 or more in size, train nothing and come back with
null code and error. Rows that repeat an id are coded each for itself; rows without id are seeds only if
too few have one; equal ids are ordered by their components. With fewer than ``ENTRIES`` vectors the
codebooks are that much smaller. An empty table has no codes. Other columns of the table are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from breachlens.llm.common import remove_folder
from breachlens.sources import new_folder
from breachlens.sources.layers import write_layer

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Integers per unit of a component.
SCALE = 1024
#: Components must stay below this size as integers, so that sums of squares fit 64 bits.
LIMIT = 1 << 24
#: Vectors that are compared with a codebook at once.
BATCH = 4096

_STATE = "vec_id bigint, label {label}, v binary, codes binary, dist binary, error bigint"
_STATE_COLUMNS = ["vec_id", "label", "v", "codes", "dist", "error"]
_SUMS = "part int, entry int, n bigint, total array<bigint>"


def _exact(length: int, *arrays: np.ndarray) -> bool:
    largest = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return length * (2 * largest + 1) ** 2 < 1 << 53


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(part, entry): exact squared distances of integer rows."""
    kind = np.float64 if _exact(x.shape[1], x, entries) else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    out = a @ b.T
    out *= -2
    out += (a * a).sum(1)[:, None]
    out += (b * b).sum(1)
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, distance) of each row's nearest entry, the lower index among equals."""
    found = distances(x, entries)
    at = found.argmin(1)
    return at, found[np.arange(len(x)), at].astype(np.int64)


def reassign(
    x: np.ndarray, codes: np.ndarray, dist: np.ndarray, entries: np.ndarray, moved: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The same as ``nearest``, from the codes and distances before the entries ``moved`` (a mask) did."""
    codes, dist = codes.copy(), dist.copy()
    rescan = moved[codes]
    if rescan.any():
        codes[rescan], dist[rescan] = nearest(x[rescan], entries)
    rest, active = np.flatnonzero(~rescan), np.flatnonzero(moved)
    if len(rest) and len(active):
        at, near = nearest(x[rest], entries[active])
        at = active[at]
        better = (near < dist[rest]) | ((near == dist[rest]) & (at < codes[rest]))
        codes[rest[better]], dist[rest[better]] = at[better], near[better]
    return codes, dist


def new_entries(entries: np.ndarray, sums: list[tuple[int, int, list[int]]]) -> np.ndarray:
    """Entries of one part after a round, from (entry, count, component sums); unused ones stay."""
    out = entries.copy()
    for entry, n, total in sums:
        out[entry] = [s // n for s in total]
    return out


@dataclass
class VectorCodes:
    """Result: rows (vec_id, label, code, error) and the codebooks, one integer array per part."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def codebooks_sha256(self) -> str:
        numbers = [str(c) for book in self.codebooks for c in book.ravel().tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


# --- rows -----------------------------------------------------------------------
def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v): kept vectors as arrays of integers; an array is null where one is too large."""
    x = F.col(f"`{vector_col}`")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE))
    small = F.forall(x, lambda c: F.abs(c.cast("double")) * SCALE < LIMIT)
    return vectors.where(x.isNotNull() & F.forall(x, finite)).select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
        F.when(small, scaled.cast("array<int>")).alias("v"),
    )


def _codable(length: int) -> Column:
    """Never null: null arrays are not codable."""
    return F.coalesce(F.size("v") == length, F.lit(False)) & F.col("v").isNotNull() & F.lit(length > 0)


def _first_codes(length: int):
    """State rows from integer arrays: the components as 32-bit integers, without codes yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4")
            n = batch.num_rows
            v = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * length), n, [None, pa.py_buffer(flat.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), v.cast(pa.binary()), pa.nulls(n, pa.binary()),
                    pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()),
                ],
                names=_STATE_COLUMNS,
            )

    return run


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """Rows of a binary column without nulls, all of one width."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _packed(rows: np.ndarray) -> pa.Array:
    size = rows.shape[1] * rows.itemsize
    data = pa.py_buffer(np.ascontiguousarray(rows).tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(rows), [None, data]).cast(pa.binary())


def _round(books: list[np.ndarray], moved: list[np.ndarray] | None):
    """Assign every part; yields the state rows and, at a task's end, its sums of parts by entry."""
    width = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        totals = [np.zeros(b.shape, np.int64) for b in books]
        schema = None
        for whole in batches:
            schema = schema or pa.schema(
                [*whole.schema, ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]
            )
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                rows = batch.num_rows
                x = _matrix(batch.column(2), "<i4", width * PARTS).astype(np.int64)
                if moved is not None:
                    old, far = _matrix(batch.column(3), np.uint8, PARTS), _matrix(batch.column(4), "<i8", PARTS)
                codes, dist = np.empty((rows, PARTS), np.uint8), np.empty((rows, PARTS), "<i8")
                for p, book in enumerate(books):
                    mine = x[:, p * width : (p + 1) * width]
                    if moved is None:
                        code, near = nearest(mine, book)
                    else:
                        code, near = reassign(mine, old[:, p].astype(np.int64), far[:, p], book, moved[p])
                    codes[:, p], dist[:, p] = code, near
                    counts[p] += np.bincount(code, minlength=len(book))
                    for i in range(width):  # a batch's sums are far below 2^53
                        totals[p][:, i] += np.bincount(code, mine[:, i], len(book)).astype(np.int64)
                state = [*[batch.column(i) for i in range(3)], _packed(codes), _packed(dist), pa.array(dist.sum(1))]
                yield pa.RecordBatch.from_arrays([*state, *[pa.nulls(rows, f.type) for f in list(schema)[6:]]], schema=schema)
        if schema is not None:
            used = [(p, int(e)) for p in range(PARTS) for e in np.flatnonzero(counts[p])]
            sums = [
                pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()),
                pa.array([int(counts[p][e]) for p, e in used], pa.int64()),
                pa.array([totals[p][e].tolist() for p, e in used], pa.list_(pa.int64())),
            ]
            nothing = [pa.nulls(len(used), f.type) for f in list(schema)[:6]]
            yield pa.RecordBatch.from_arrays([*nothing, *sums], schema=schema)

    return run


def _summed(rows: DataFrame) -> list[list[tuple[int, int, list[int]]]]:
    """Per part (entry, count, component sums): at most ``PARTS`` x ``ENTRIES`` rows, summed by Spark."""
    each = rows.where("part IS NOT NULL").select("part", "entry", "n", F.posexplode("total").alias("place", "c"))
    totals = each.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("c").cast("decimal(38,0)")).alias("c"))
    whole = totals.groupBy("part", "entry").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "c"))).alias("total")
    )
    out: list[list[tuple[int, int, list[int]]]] = [[] for _ in range(PARTS)]
    for row in whole.collect():
        out[row.part].append((row.entry, row.n, [int(t.c) for t in row.total]))
    return out


def code_vectors(
    spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> VectorCodes:
    """Codebooks after ``ROUNDS`` rounds and the codes of all kept vectors by them."""
    folder = new_folder(spark, "vector-codes")
    kept = integer_vectors(vectors, id_col, vector_col, label_col)
    label = kept.schema["label"].dataType.simpleString()
    smallest = kept.where((F.size("v") > 0) & (F.size("v") % PARTS == 0)).orderBy(F.col("vec_id").asc_nulls_last(), "v")
    seeds = smallest.limit(ENTRIES).select("v").collect()
    length = len(seeds[0].v) if seeds else 0
    if any(len(row.v) != length for row in seeds):
        seeds = smallest.where(_codable(length)).limit(ENTRIES).select("v").collect()
    rest = kept.where(~_codable(length)).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error")
    )
    if not length:
        return VectorCodes(rest, [np.empty((0, 0), np.int64)] * PARTS)
    coded = kept.where(_codable(length))
    books = [np.array([row.v for row in seeds], np.int64)[:, p * length // PARTS : (p + 1) * length // PARTS] for p in range(PARTS)]
    schema = _STATE.format(label=label)
    state = coded.mapInArrow(_first_codes(length), schema)
    moved, before = None, None
    for number in range(ROUNDS + 1):
        path = f"{folder}/{number}"
        rows = write_layer(state.mapInArrow(_round(books, moved), f"{schema}, {_SUMS}"), path)
        if before:
            remove_folder(spark, before)  # its successor is written
        before, state = path, rows.where("part IS NULL").select(*_STATE_COLUMNS)
        if number < ROUNDS:
            changed = [new_entries(book, sums) for book, sums in zip(books, _summed(rows))]
            moved = [(a != b).any(1) for a, b in zip(books, changed)]
            books = changed
    rows = state.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error")
    return VectorCodes(rows.union(rest), books)


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over equal labels, nulls together. One row per label is joined back;
    a join cannot be skewed by a label that many rows have, as the side of the labels has it once."""
    by_label = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return rows.join(by_label, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
