"""CSV whose quoted cells hold line breaks, read by many tasks per file.

Whether a line begins inside a quoted cell depends on all lines before it. A first pass gives one row per
split: the state in which the split ends, for each of the two states in which it may begin. A running
composition of these over a file's splits gives the true state at the beginning of each. A second pass joins
lines to records; what a split's edge cuts comes out as fragments, at most two per split, and only those
are shuffled and put together. Records become cells by ``from_csv``. No task reads more than its split.

A quote opens a cell only where a cell begins; a doubled quote stands for one; what follows a closing quote
up to the comma belongs to the cell. Lines end with a line feed, with or without a carriage return; in a record
that ends with both, those in its cells become line feeds too, as in a file that is read whole.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from breachlens.sources.layers import write_layer
from breachlens.sources.workspace import ship_package

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
#: Complete cells, then one that is not closed.
_ENDS_INSIDE = re.compile(rf'(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+{_QUOTED}\Z')
#: The rest of a quoted cell, to its comma or the line's end.
_CLOSES = re.compile(r'[^"]*+(?:""[^"]*+)*+"[^,]*+')

_STATES = "file string, block bigint, from_outside int, from_inside int"
_RECORDS = "file string, block bigint, row bigint, part string, record string"
WHOLE, HEADER, FIRST, MIDDLE, LAST = "whole", "header", "first", "middle", "last"


def state_after(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open behind a line that begins inside or outside of one."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        closed = _CLOSES.match(line)
        if not closed:
            return True
        at = closed.end() + 1
        if at > len(line):
            return False
    return _ENDS_INSIDE.match(line, at) is not None


def _split_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Per batch and split in it: the split, and its lines in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for column in (batch.column("file"), batch.column("block")):
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        starts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for at, end in zip(starts, starts[1:]):
            yield (batch.column("file")[at].as_py(), batch.column("block")[at].as_py()), batch.slice(at, end - at)


def _end_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends: dict[tuple, tuple[bool, bool]] = {}
    for split, lines in _split_lines(batches):
        outside, inside = ends.get(split, (False, True))
        text = lines.column("value")
        for line in text.filter(pc.match_substring(text, '"')).to_pylist():
            same = outside == inside
            outside = state_after(line, outside)
            inside = outside if same else state_after(line, inside)
        ends[split] = outside, inside
    if ends:
        columns = list(zip(*[(*split, int(a), int(b)) for split, (a, b) in ends.items()]))
        types = [pa.string(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["file", "block", "from_outside", "from_inside"]
        )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split, and the fragments at its edges.

    Lines without a quote are records as they stand while no cell is open: they are picked at once. Python goes line by line
    only through the others, a file's header, blank lines and files whose lines end with a carriage return.
    """
    split, inside, held, held_row, begun, header_due, returns = None, False, [], None, False, False, False

    def row(part: str, text: str) -> tuple:
        return (*split, held_row, part, text)

    def rest() -> list[tuple]:
        """What is open at the end of a split: from its beginning on, or from a record in it."""
        return [row(FIRST if begun else MIDDLE, "\n".join(held))] if held else []

    def out(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        columns = zip(*rows) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["file", "block", "row", "part", "record"])

    for new, lines in _split_lines(batches):
        done = []
        if new != split:
            done += rest() if split else []
            split, held = new, []
            inside = lines.column("begins")[0].as_py() == 1
            begun, header_due, returns = not inside, new[1] == 0, False
        text_of, number_of = lines.column("value"), lines.column("row").to_numpy()
        plain = pc.and_(pc.match_substring_regex(text_of, "[!-~]"), pc.invert(pc.match_substring_regex(text_of, '["\r]')))
        plain = plain.to_numpy(zero_copy_only=False)
        special, picked = [*np.flatnonzero(~plain).tolist(), len(plain)], np.zeros(len(plain), bool)
        ahead, at = 0, 0
        while at < len(plain):
            while special[ahead] < at:
                ahead += 1
            if begun and not (held or header_due or returns) and special[ahead] > at:
                picked[at : special[ahead]] = True
                at = special[ahead]
                continue
            line, number = text_of[at].as_py(), int(number_of[at])
            at += 1
            if not held:
                held_row = number
            held.append(line)
            inside = state_after(line, inside)
            if inside:
                continue
            text = "\n".join(held)
            if not begun:
                done.append(row(LAST, text))
                held, begun = [], True
                continue
            returns = returns or text.endswith("\r")
            if returns:  # a file's last record may end without either
                text = text.removesuffix("\r").replace("\r\n", "\n")
            if header_due and text.strip("\ufeff \t"):
                done.append(row(HEADER, text))
                header_due = False
            elif text.strip():
                done.append(row(WHOLE, text))
            held = []
        yield out(done)
        if picked.any():
            whole = lines.filter(pa.array(picked))
            part = pa.array([WHOLE]).take(pa.array(np.zeros(whole.num_rows, np.int32)))
            columns = [whole.column("file"), whole.column("block"), whole.column("row"), part, whole.column("value")]
            yield pa.RecordBatch.from_arrays(columns, ["file", "block", "row", "part", "record"])
    if split:
        yield out(rest())


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _begin_states(ends: DataFrame) -> DataFrame:
    """Adds ``begins``, the state (1: inside) at each split's beginning, and ``finishes``, that at its end.

    A split that ends in one state however it begins sets the state; others keep it or turn it round.
    """
    in_order = Window.partitionBy("file").orderBy("block")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum(F.when(F.col("from_outside") > F.col("from_inside"), 1).otherwise(0))
    known = ends.withColumn("turns", turns.over(in_order)).withColumn(
        "sets", F.when(F.col("from_outside") == F.col("from_inside"), F.struct(F.col("from_outside").alias("state"), "turns"))
    )
    last = F.last("sets", ignorenulls=True).over(before)
    turned = F.coalesce(F.lag("turns").over(in_order), F.lit(0))
    begins = known.select(
        "file", "block", "from_outside", "from_inside",
        F.pmod(F.coalesce(last["state"], F.lit(0)) + turned - F.coalesce(last["turns"], F.lit(0)), F.lit(2)).alias("begins"),
    )
    return begins.withColumn("finishes", F.when(F.col("begins") == 1, F.col("from_inside")).otherwise(F.col("from_outside")))


def _joined_fragments(fragments: DataFrame) -> DataFrame:
    """Records from fragments: a first one and all up to the next."""
    number = F.sum(F.when(F.col("part") == FIRST, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("block", "row"))
    pieces = F.sort_array(F.collect_list(F.struct("block", "row", "record")))
    whole = fragments.withColumn("number", number).groupBy("file", "number").agg(pieces.alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda p: p["record"]), "\n")
    without = F.replace(F.substring(text, F.lit(1), F.length(text) - 1), F.lit("\r\n"), F.lit("\n"))
    text = F.when(F.endswith(text, F.lit("\r")), without).otherwise(text)
    return whole.select("file", F.col("pieces")[0]["block"].alias("block"), F.col("pieces")[0]["row"].alias("row"), text.alias("record"))


def split_records(spark: SparkSession, path: str, names: list[str], folder: str) -> DataFrame:
    """(record, file, block, row): each record's text, and its place as in a scan by lines.

    Blank records and each file's header are left out. A cell that is never closed, or a header other than
    ``names`` in any file, raises.
    """
    ship_package(spark)
    ends = write_layer(_begin_states(_lines(spark, path).mapInArrow(_end_states, _STATES)), f"{folder}/splits")
    last = ends.groupBy("file").agg(F.max_by("finishes", "block").alias("finishes")).where("finishes = 1").first()
    if last:
        raise RuntimeError(f"Unable to load dataset: a quoted cell of {last['file']} is not closed")
    inside = ends.where("begins = 1").select("file", "block", "begins")  # few: splits that begin inside a cell
    lines = _lines(spark, path).join(F.broadcast(inside), ["file", "block"], "left")
    parts = lines.select("value", "file", "block", "row", "begins").mapInArrow(_records, _RECORDS)
    parts = write_layer(parts, f"{folder}/records")
    headers = [r["record"] for r in parts.where(F.col("part") == HEADER).select("record").distinct().limit(2).collect()]
    for header in headers:
        if next(csv.reader([header.lstrip("\ufeff")]), []) != names:
            raise RuntimeError(f"Unable to load dataset: the files have different headers, as {header!r}")
    whole = parts.where(F.col("part") == WHOLE).select("file", "block", "row", "record")
    return whole.unionByName(_joined_fragments(parts.where(F.col("part").isin(FIRST, MIDDLE, LAST))))


def cells_of(record: Column, n: int, options: dict) -> Column:
    """struct(c0, c1, ..., broken) of one record's text."""
    schema = ", ".join([*[f"c{i} string" for i in range(n)], "broken string"])
    return F.from_csv(record, schema, {**options, "columnNameOfCorruptRecord": "broken", "mode": "PERMISSIVE", "multiLine": "true"})
