"""Reversible line dedup over a store of reference counts.

A line's key is the line without white space at its ends, A-Z lower-cased. Of keys with
``KEY_CHARS`` code points or more that stand in two documents or more, all lines go but those in
the document with the smallest id. The store keeps, under a folder,

* ``holders``: (doc_id, key) of each inserted batch, and the ids of later deletions,
* ``counts``: per key the exact number of documents that hold it and the smallest of their ids,
* ``filters``: per shard of keys a cuckoo filter of those held by two documents or more.

Inserting documents adds keys to the filters when their count reaches two; deleting documents
takes them out when it falls below. When a store has outgrown its shards, they are divided anew and the filters
built again, so a filter stays of bounded size however small the first batch was. An insert reads the holders of
earlier batches only within its own range of ids, which Parquet statistics find; counts are written whole. A dedup asks the filter of the shard first; what it admits (the
repeated keys and a few false ones) is looked up in the exact counts.

Keys are 16-byte BLAKE2 digests. Null and empty texts are one empty line. Rows with one id are
one document. A document without id comes after all others; all rows without id are one document. Ids must be
whole numbers (they are cast to bigint). An empty table has no lines; other columns are kept as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from breachlens.llm.common import WHITE_SPACE, unused_name, utf8
from breachlens.llm.cuckoo import LOAD, SLOTS, CuckooFilter
from breachlens.sources.layers import write_layer

KEY_CHARS = 10
#: Keys of a shard: its filter has some 3 MB, its exact counts some 40 MB.
SHARD_KEYS = 1_000_000
#: Lines of one shard are dealt to so many partitions, as one line may stand in most documents.
SPREAD = 8
_LAST_ID = (1 << 63) - 1
#: A line on its way: the id that orders its document, the row it stands in, and its key.
_LINE = ["doc_id", "row_a", "row_b", "key"]
_CHANGE = "number int, kind string, folder string, n_shards int"
_CONTINUED = bytes(range(0x80, 0xC0))


def line_key(line: bytes) -> bytes | None:
    """Digest of the line's key; None if the key is too short to count."""
    key = line.strip(WHITE_SPACE).lower()
    if len(key) < KEY_CHARS or len(key.translate(None, _CONTINUED)) < KEY_CHARS:
        return None
    return blake2b(key, digest_size=16).digest()


def _held_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per row and key in it, with all columns but the text."""
    for batch in batches:
        rows, keys = [], []
        for row, text in enumerate(batch.column("text")):
            text = text.as_py()
            if text:
                own = {line_key(line) for line in text.split(b"\n")} - {None}
                rows += [row] * len(own)
                keys += own
        others = batch.drop_columns("text").take(pa.array(rows, pa.int64()))
        yield others.append_column("key", pa.array(keys, pa.binary()))


def _shard(n_shards: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(n_shards)).cast("int")


def _update_filter(key: tuple, filters: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    rebuild = bool(len(changes) and changes["rebuild"].iloc[0]) or filters.empty
    keys = changes["key"]
    if rebuild:
        held = keys[changes["repeated"]].tolist()
        cuckoo = CuckooFilter.sized(2 * len(held))
        cuckoo.add(held)
    else:
        cuckoo = CuckooFilter.load(filters["data"].iloc[0])
        cuckoo.remove(keys[changes["was_repeated"] & ~changes["repeated"]].tolist())
        cuckoo.add(keys[changes["repeated"] & ~changes["was_repeated"]].tolist())
    return pd.DataFrame({"shard": [key[0]], "data": [cuckoo.dump()]})


def _admitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines that the filter of their shard admits; the filter's row stands before its lines."""
    loaded, cuckoo = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        shard, part = (batch.column(c).to_numpy() for c in ("shard", "part"))
        is_line = ~batch.column("data").is_valid().to_numpy(zero_copy_only=False)
        same = is_line[1:] & (shard[1:] == shard[:-1]) & (part[1:] == part[:-1])
        edges = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(shard)]])
        for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if not is_line[start]:
                loaded, cuckoo = (shard[start], part[start]), CuckooFilter.load(batch.column("data")[start].as_py())
                start += 1
            if start == stop or loaded != (shard[start], part[start]):  # without a filter, no key is repeated
                continue
            lines = batch.slice(start, stop - start).select(_LINE)
            yield lines.filter(pa.array(cuckoo.holds(lines.column("key").to_pylist())))


def _without_lines(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, keys in batches:
        out = []
        for text, gone in zip(texts, keys):
            if gone is None or text is None:
                out.append((None, 0))
                continue
            gone, lines = set(gone), text.split(b"\n")
            kept = [line for line in lines if line_key(line) not in gone]
            out.append((b"\n".join(kept).decode(), len(lines) - len(kept)))
        yield pd.DataFrame(out, columns=["text", "n_dropped"])


class LineStore:
    """Line counts of the documents inserted so far, under a folder that all executors share.

    Each change writes a new version of the counts and filters next to the old one and is listed when it
    is complete, so a failed change leaves the store as it was; batches of holders and deletions are
    only appended. Opening the folder again gives the store of the last change. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, shard_keys: int = SHARD_KEYS):
        self.spark, self.folder, self.shard_keys = spark, folder, shard_keys
        self.batches: list[tuple[str, DataFrame]] = []
        self.counts: DataFrame | None = None
        self.filters: DataFrame | None = None
        self.n_shards = 0
        for change in sorted(self._changes(), key=lambda c: c.number):
            self.batches.append((change.kind, spark.read.parquet(f"{change.folder}/rows")))
            self.counts = self._held(spark.read.parquet(f"{change.folder}/counts"))
            self.filters = spark.read.parquet(f"{change.folder}/filters")
            self.n_shards = change.n_shards

    def _changes(self) -> list[Row]:
        """The finished changes of the folder: one row each, written when all else of it is there."""
        try:
            return self.spark.read.schema(_CHANGE).parquet(f"{self.folder}/changes").collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error.getCondition()):
                return []
            raise

    def _new_change(self) -> str:
        return f"{self.folder}/change-{uuid.uuid4().hex}"

    @staticmethod
    def _held(counts: DataFrame) -> DataFrame:
        return counts.where("n_docs > 0").select("shard", "key", "n_docs", "first_doc", "repeated")

    def _live(self) -> DataFrame:
        """(doc_id, key) of the documents that are in the store."""
        live = None
        for kind, rows in self.batches:
            if kind == "inserted":
                live = rows if live is None else live.unionByName(rows).distinct()
            elif live is not None:
                live = live.join(rows, "doc_id", "left_anti")
        return live

    def _publish(self, kind: str, rows: DataFrame, folder: str, counts: DataFrame, n_shards: int) -> None:
        """Write the changed counts, bring the filters in line with them, and list the change."""
        counts = write_layer(counts, f"{folder}/counts")
        per_shard = counts.groupBy("shard").agg(F.count(F.when(F.col("repeated"), 1)).alias("n"))
        if n_shards != self.n_shards:
            full = per_shard.select("shard", F.lit(True).alias("rebuild"))
            old = self.spark.createDataFrame([], "shard int, data binary")
        else:
            old = self.filters
            slots = F.length("data") / 2
            full = per_shard.join(old, "shard", "left").select(
                "shard", F.coalesce((F.col("n") > LOAD * slots) | (F.hex(F.substring("data", 1, 1)) == "01"), F.lit(True)).alias("rebuild")
            )
        changes = counts.where("repeated OR was_repeated").join(full, "shard").where(
            (F.col("rebuild") & F.col("repeated")) | (F.col("repeated") != F.col("was_repeated"))
        )
        changes = changes.select(F.col("shard").alias("of_shard"), "key", "repeated", "was_repeated", "rebuild")
        filters = (
            old.groupBy("shard").cogroup(changes.groupBy("of_shard")).applyInPandas(_update_filter, "shard int, data binary")
        )
        filters = write_layer(filters, f"{folder}/filters")
        change = [(len(self.batches), kind, folder, n_shards)]
        self.spark.createDataFrame(change, _CHANGE).coalesce(1).write.mode("append").parquet(f"{self.folder}/changes")
        self.batches.append((kind, rows))
        self.counts, self.filters, self.n_shards = self._held(counts), filters, n_shards

    @staticmethod
    def _order(id_col: str) -> Column:
        return F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(_LAST_ID))

    def holders(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(doc_id, key) once for each key that a row holds."""
        rows = docs.select(self._order(id_col).alias("doc_id"), utf8(text_col).alias("text"))
        return rows.mapInArrow(_held_keys, "doc_id bigint, key binary")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Count the lines of ``docs``; lines of an id that the store already holds are added to that document."""
        folder = self._new_change()
        rows = write_layer(self.holders(docs, id_col, text_col), f"{folder}/rows")
        new, n_shards = rows.distinct(), self.n_shards
        if self.counts is None:
            n_shards = max(8, -(-rows.count() // self.shard_keys))
        else:
            n, least, most = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
            n += self.counts.count()
            if n > 2 * n_shards * self.shard_keys:
                n_shards = -(-n // self.shard_keys)
            held = self._live().where(F.col("doc_id").between(least, most)) if least is not None else self._live().limit(0)
            new = new.join(held, ["doc_id", "key"], "left_anti")
        new = new.groupBy("key").agg(
            F.min("doc_id").alias("new_first"), F.max("doc_id").alias("new_last"), F.count(F.lit(1)).alias("new_docs")
        )
        if self.counts is None:
            merged = new.select(
                _shard(n_shards).alias("shard"), "key", F.col("new_docs").alias("n_docs"),
                F.col("new_first").alias("first_doc"), F.lit(False).alias("was_repeated"),
                (F.col("new_first") < F.col("new_last")).alias("repeated"),
            )
        else:
            old = self.counts.select("key", "n_docs", "first_doc", F.col("repeated").alias("was"))
            both = old.join(new, "key", "full")
            merged = both.select(
                _shard(n_shards).alias("shard"), "key",
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("new_docs", F.lit(0))).alias("n_docs"),
                F.least("first_doc", "new_first").alias("first_doc"),
                F.coalesce("was", F.lit(False)).alias("was_repeated"),
                (
                    F.coalesce("was", F.lit(False))
                    | (F.greatest("first_doc", "new_last") > F.least("first_doc", "new_first"))
                ).alias("repeated"),
            )
        self._publish("inserted", rows, folder, merged, n_shards)

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Take documents out again; ids that the store does not hold change nothing."""
        order = F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(_LAST_ID)).alias("doc_id")
        folder = self._new_change()
        gone = write_layer(ids.select(order).distinct(), f"{folder}/rows")
        touched = self._live().join(gone, "doc_id").select("key").distinct()
        left = (
            self._live().join(gone, "doc_id", "left_anti").join(touched, "key", "left_semi").groupBy("key").agg(
                F.count(F.lit(1)).alias("left"), F.min("doc_id").alias("left_first"), F.max("doc_id").alias("left_last")
            )
        )
        touched = touched.join(left, "key", "left").withColumn("touched", F.lit(True))
        merged = self.counts.join(touched, "key", "left").select(
            "shard", "key",
            F.when(F.col("touched"), F.coalesce("left", F.lit(0))).otherwise(F.col("n_docs")).alias("n_docs"),
            F.when(F.col("touched"), F.col("left_first")).otherwise(F.col("first_doc")).alias("first_doc"),
            F.col("repeated").alias("was_repeated"),
            F.when(F.col("touched"), F.coalesce(F.col("left_first") < F.col("left_last"), F.lit(False)))
            .otherwise(F.col("repeated")).alias("repeated"),
        )
        self._publish("deleted", gone, folder, merged, self.n_shards)

    def repeats(self, lines: DataFrame) -> DataFrame:
        """Of rows of ``_LINE``, those whose key a document with a smaller id holds too."""
        blank = F.lit(None)
        rows = lines.select(
            _shard(self.n_shards).alias("shard"), F.pmod(F.xxhash64("doc_id", "row_a"), F.lit(SPREAD)).cast("int").alias("part"),
            *_LINE, blank.cast("binary").alias("data"),
        )
        filters = self.filters.select(
            "shard", F.explode(F.array(*[F.lit(i) for i in range(SPREAD)])).alias("part"),
            *[blank.cast("bigint").alias(c) for c in _LINE[:-1]], blank.cast("binary").alias("key"), "data",
        )
        dealt = filters.unionByName(rows).repartition(self.n_shards * SPREAD, "shard", "part")
        admitted = dealt.sortWithinPartitions("shard", "part", F.col("data").isNull()).mapInArrow(
            _admitted, "doc_id bigint, row_a bigint, row_b bigint, key binary"
        )
        exact = self.counts.where("repeated").select("key", "first_doc")
        return admitted.join(exact, "key").where("doc_id > first_doc").select(*_LINE)

    def dedupe(
        self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_dropped: str | None = None
    ) -> DataFrame:
        """``docs`` without the lines that an inserted document with a smaller id holds.

        All columns stay; ``n_dropped`` names a column to add with the number of dropped lines. What is
        dropped is collected per id and text (128 bits of hashes), so a list never has more keys than
        its own text, however many rows share an id or lack one.
        """
        own = {name: unused_name(docs, name) for name in ("dedup_id", "dedup_a", "dedup_b", "dedup_keys", "dedup_new")}
        text = F.col(f"`{text_col}`")
        row = {"doc_id": self._order(id_col), "row_a": F.xxhash64(text), "row_b": F.xxhash64(F.lit(1), text)}
        lines = docs.select(*[c.alias(name) for name, c in row.items()], utf8(text_col).alias("text")).mapInArrow(
            _held_keys, "doc_id bigint, row_a bigint, row_b bigint, key binary"
        )
        gone = self.repeats(lines).groupBy(*row).agg(F.collect_set("key").alias(own["dedup_keys"]))
        names = dict(zip(row, (own["dedup_id"], own["dedup_a"], own["dedup_b"])))
        keyed = docs.withColumns({names[name]: c for name, c in row.items()})
        joined = keyed.join(gone.withColumnsRenamed(names), list(names.values()), "left")
        keys = F.col(own["dedup_keys"])
        changed = F.pandas_udf(_without_lines, "text string, n_dropped bigint")(F.when(keys.isNotNull(), utf8(text_col)), keys)
        joined = joined.withColumn(own["dedup_new"], changed)
        new = F.col(own["dedup_new"])
        columns = [F.when(keys.isNotNull(), new["text"]).otherwise(F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
        return joined.select(*columns, *([new["n_dropped"].alias(n_dropped)] if n_dropped else []))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str, n_dropped: str | None = None) -> DataFrame:
    """``docs`` without the lines that another of them with a smaller id holds."""
    store = LineStore(spark, folder)
    store.insert(docs)
    return store.dedupe(docs, n_dropped=n_dropped)
