"""Benchmark decontamination by a positional inverted index of the training texts.

``build_index`` cuts the documents into segments of bounded size and writes, per segment and term,
the sorted positions of the term. ``match_phrases`` looks up word sequences: for each sequence it
takes the rarest of its terms, sends the sequence to the segments which hold that term, and there
intersects the lists of positions, each moved back by the term's offset, from the rarest term on.
With ``slop`` the rarest term stands at its place and each other one up to that many places off it
(a proximity match).

No list spans segments, so no term, however common, makes a list longer than a segment, and the
only rows that move are lists of terms that the benchmark uses.

Null and empty texts have no words: such documents get a row without hits, such items no window.
Repeated documents (also repeated ids) get a row each. Items repeated under one id count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachlens.llm.common import cut_words, lower_words, release_memory, unused_name, utf8
from breachlens.llm.pretokens import distinct_pieces
from breachlens.sources import new_folder
from breachlens.sources.layers import write_layer

#: Words of an item that make one window.
WINDOW_WORDS = 13
#: Free positions between two documents, so that no match and no slop reaches across.
GAP = 64
#: Text bytes of a segment; a longer document is a segment of its own.
SEGMENT_BYTES = 8 << 20
#: Words of a segment whose codes are found together.
WORDS_AT_ONCE = 1 << 17
#: Windows handled together in one segment.
WINDOWS_AT_ONCE = 100_000
#: Bytes of distinct benchmark terms up to which they are broadcast (they are summed first); more are joined
#: by a shuffle.
BROADCAST_BYTES = 16 << 20

INDEX = "segment bigint, term binary, n bigint, positions binary, doc_id {id_type}, start bigint, n_words bigint"


# --- index ----------------------------------------------------------------------
def _segment_rows(segment: int, ids: list, texts: list[bytes | None], schema: pa.Schema) -> pa.RecordBatch:
    """One row per document, then one per term, its positions ascending."""
    data, word_starts, word_lengths, counts = cut_words(texts)
    codes, known = np.empty(len(word_starts), np.int32), {}
    for at in range(0, len(codes), WORDS_AT_ONCE):
        begins, sizes = word_starts[at : at + WORDS_AT_ONCE], word_lengths[at : at + WORDS_AT_ONCE]
        code, first = distinct_pieces(data, begins, sizes)
        own = [data[a : a + n] for a, n in zip(begins[first].tolist(), sizes[first].tolist())]
        codes[at : at + WORDS_AT_ONCE] = np.array([known.setdefault(term, len(known)) for term in own], np.int32)[code]
    terms = list(known)
    del data, word_starts, word_lengths, known
    starts = np.cumsum(counts + GAP) - counts - GAP
    places = np.arange(len(codes), dtype=np.int64) + np.repeat(GAP * np.arange(len(ids)), counts)
    order = np.argsort(codes, kind="stable")
    lengths = np.bincount(codes, minlength=len(terms)).astype(np.int64)
    positions = places.astype("<i4")[order]
    edges = np.concatenate([[0], np.cumsum(lengths) * 4]).astype(np.int32)
    lists = pa.BinaryArray.from_buffers(
        pa.binary(), len(terms), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(positions.tobytes())]
    )
    d, t = len(ids), len(terms)
    columns = [
        pa.array(np.full(d + t, segment)),
        pa.concat_arrays([pa.nulls(d, pa.binary()), pa.array(terms, pa.binary())]),
        pa.concat_arrays([pa.nulls(d, pa.int64()), pa.array(lengths)]),
        pa.concat_arrays([pa.nulls(d, pa.binary()), lists]),
        pa.concat_arrays([pa.array(ids, schema.field("doc_id").type), pa.nulls(t, schema.field("doc_id").type)]),
        pa.concat_arrays([pa.array(starts), pa.nulls(t, pa.int64())]),
        pa.concat_arrays([pa.array(counts), pa.nulls(t, pa.int64())]),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _index_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of whole documents, closed as soon as they hold ``SEGMENT_BYTES``."""
    task = TaskContext.get().partitionId()
    made, held, ids, texts, schema = 0, 0, [], [], None
    for batch in batches:
        if schema is None:
            schema = pa.schema(
                [
                    ("segment", pa.int64()), ("term", pa.binary()), ("n", pa.int64()), ("positions", pa.binary()),
                    ("doc_id", batch.schema.field(0).type), ("start", pa.int64()), ("n_words", pa.int64()),
                ]
            )
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            size = len(text) if text else 0
            if ids and held + size > SEGMENT_BYTES:
                yield _segment_rows(task << 32 | made, ids, texts, schema)
                made, held, ids, texts = made + 1, 0, [], []
            ids.append(doc_id)
            texts.append(text)
            held += size
    if ids:
        yield _segment_rows(task << 32 | made, ids, texts, schema)
    del ids, texts
    release_memory()


def build_index(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the index of ``docs`` to ``folder`` and return it read back.

    Rows with a term hold its positions in a segment (4-byte little-endian integers); rows without
    one hold a document: its id, its first position and its number of words.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), utf8(text_col).alias("text"))
    return write_layer(rows.mapInArrow(_index_batches, INDEX.format(id_type=rows.schema["doc_id"].dataType.simpleString())), folder)


# --- phrases --------------------------------------------------------------------
def _item_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (item, words[i : i + WINDOW_WORDS])
            for item, words in zip(batch["item"], map(lower_words, batch["text"]))
            for i in range(max(1, len(words) - WINDOW_WORDS + 1))
            if words
        ]
        yield pd.DataFrame(rows, columns=["item", "terms"])


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item as string, terms): every run of ``WINDOW_WORDS`` words; a shorter item is one window."""
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), utf8(text_col).alias("text"))
    return rows.mapInPandas(_item_windows, "item string, terms array<binary>")


class _Segment:
    """The lists of one segment that the benchmark's terms need."""

    def __init__(self, rows: pd.DataFrame):
        self.number = {term: i for i, term in enumerate(rows["term"])}
        lists = [np.frombuffer(p, "<i4") for p in rows["positions"]]
        self.length = np.array([len(p) for p in lists], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.positions = np.concatenate(lists).astype(np.int64) if lists else np.empty(0, np.int64)
        #: term number and position in one ascending key
        self.keys = np.repeat(np.arange(len(lists)), self.length) << 32 | self.positions

    def starts(self, phrases: list[list[bytes]], slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start position) of every match."""
        widest = max(map(len, phrases))
        numbers = np.full((len(phrases), widest), -1, np.int64)
        for i, phrase in enumerate(phrases):
            for j, term in enumerate(phrase):
                numbers[i, j] = self.number.get(term, -2)
        phrase = np.flatnonzero((numbers != -2).all(1))
        used = numbers[phrase] >= 0
        lengths = np.where(used, self.length[numbers[phrase]] if len(self.length) else 0, np.iinfo(np.int64).max)
        rarest_first = np.argsort(lengths, axis=1, kind="stable")
        # candidates: each position of the rarest term, moved back by its offset
        row = np.arange(len(phrase))
        offset = rarest_first[:, 0] if len(phrase) else row
        term = numbers[phrase, offset]
        n = self.length[term] if len(phrase) else row
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[term] if len(phrase) else row, n)
        row = np.repeat(row, n)
        start = self.positions[at] - offset[row]
        for step in range(1, widest):
            if not len(row):
                break
            offset = rarest_first[row, step]
            term = numbers[phrase[row], offset]
            low = term << 32 | np.maximum(start + offset - slop, 0)
            found = np.searchsorted(self.keys, low)
            inside = self.keys[np.minimum(found, len(self.keys) - 1)]
            good = (term < 0) | ((found < len(self.keys)) & (inside >> 32 == term) & (inside - (term << 32) <= start + offset + slop))
            row, start = row[good], start[good]
        return phrase[row], start


def _match_segment(slop: int):
    def match(key: tuple, rows: pd.DataFrame, phrases: pd.DataFrame) -> pd.DataFrame:
        found = []
        segment = _Segment(rows[rows["term"].notna()])
        for i in range(0, len(phrases), WINDOWS_AT_ONCE):
            part = phrases.iloc[i : i + WINDOWS_AT_ONCE]
            phrase, start = segment.starts([list(t) for t in part["terms"]], slop)
            found.append(
                pd.DataFrame(
                    {"segment": key[0], "phrase": part["phrase"].to_numpy()[phrase], "position": start,
                     "n_terms": part["terms"].map(len).to_numpy()[phrase]}
                )
            )
        names = ["segment", "phrase", "position", "n_terms"]
        return pd.concat(found)[names] if found else pd.DataFrame(columns=names)

    return match


def match_phrases(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """Every place of every phrase: (segment, phrase, position, n_terms).

    ``phrases`` has a ``phrase`` id (bigint) and ``terms`` (array of binary); it is read more than
    once, so hand in a written table. ``slop`` must stay below ``GAP``.
    """
    if not 0 <= slop < GAP:
        raise ValueError(f"slop must be at least 0 and below {GAP}")
    lists = index.where("term IS NOT NULL").select("segment", "term", "n", "positions")
    terms = phrases.select(F.explode("terms").alias("term")).distinct()
    few = (terms.agg(F.sum(F.length("term") + 16)).first()[0] or 0) <= BROADCAST_BYTES
    lists = lists.join(F.broadcast(terms) if few else terms, "term", "left_semi")
    frequency = lists.groupBy("term").agg(F.sum("n").alias("n"))
    # a phrase with a term that no text has is dropped by the inner join and the count below
    spread = phrases.select("phrase", F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))
    rarest = (
        spread.join(frequency, "term")
        .groupBy("phrase", "n_terms")
        .agg(F.count(F.lit(1)).alias("known"), F.min_by("term", F.struct("n", "term")).alias("term"))
        .where("known = n_terms")
        .select("phrase", "term")
    )
    wanted = rarest.join(lists.select("segment", "term"), "term").join(phrases, "phrase").select(
        F.col("segment").alias("home"), "phrase", "terms"
    )
    return (
        lists.groupBy("segment")
        .cogroup(wanted.groupBy("home"))
        .applyInPandas(_match_segment(slop), "segment bigint, phrase bigint, position bigint, n_terms bigint")
    )


# --- documents ------------------------------------------------------------------
def _covered(key: tuple, docs: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
    """Per document with hits: the words inside any match, and the distinct phrases."""
    names = ["segment", "start", "n_hit", "phrases"]
    if hits.empty or docs.empty:
        return pd.DataFrame(columns=names)
    docs = docs.sort_values("start")
    starts, counts = docs["start"].to_numpy(), docs["n_words"].to_numpy()
    at, end = hits["position"].to_numpy(), (hits["position"] + hits["n_terms"]).to_numpy()
    marks = np.zeros(int(starts[-1] + counts[-1]) + 2, np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, end, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(marks) > 0)])
    owner = np.searchsorted(starts, at, "right") - 1
    pairs = pd.DataFrame({"doc": owner, "phrase": hits["phrase"].to_numpy()}).drop_duplicates()
    grouped = pairs.groupby("doc")["phrase"].agg(list)
    found = grouped.index.to_numpy()
    return pd.DataFrame(
        {"segment": key[0], "start": starts[found], "n_hit": inside[starts[found] + counts[found]] - inside[starts[found]],
         "phrases": grouped.to_list()}
    )[names]


def contaminated_documents(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (sorted), contaminated.

    A document is contaminated if words inside windows of items make up a twentieth of it or more.
    """
    folder = new_folder(spark, "decontamination")
    index = build_index(docs, f"{folder}/index", id_col, text_col)
    of_items = write_layer(
        item_windows(items, item_col, item_text_col)
        .groupBy("terms")
        .agg(F.collect_set("item").alias("items"))
        .select(F.monotonically_increasing_id().alias("phrase"), "terms", "items"),
        f"{folder}/windows",
    )
    hits = match_phrases(index, of_items.select("phrase", "terms"))
    rows = index.where("term IS NULL").select("segment", "start", "doc_id", "n_words")
    covered = (
        rows.select("segment", "start", "n_words")
        .groupBy("segment")
        .cogroup(hits.groupBy("segment"))
        .applyInPandas(_covered, "segment bigint, start bigint, n_hit bigint, phrases array<bigint>")
    )
    covered = write_layer(covered, f"{folder}/hits")
    items_of = (
        covered.select("segment", "start", F.explode("phrases").alias("phrase"))
        .join(of_items.select("phrase", "items"), "phrase")
        .select("segment", "start", F.explode("items").alias("item"))
        .groupBy("segment", "start")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return (
        rows.join(covered.select("segment", "start", "n_hit"), ["segment", "start"], "left")
        .join(items_of, ["segment", "start"], "left")
        .select(
            "doc_id", "n_words", n_hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def drop_contaminated_rows(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that are not contaminated, with all their columns. Each row is judged alone, whatever ids rows share
    or lack: verdicts go by the SHA-256 of the text, on which alone they depend, so no row is written a second time."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256))
    texts = docs.select(digest.alias("digest"), F.col(f"`{text_col}`").alias("text"))
    found = contaminated_documents(spark, texts, items, "digest").where("contaminated").select("doc_id").distinct()
    bad = write_layer(found, new_folder(spark, "contaminated"))  # Spark then knows its size and picks the join by it
    key = unused_name(docs, "contaminated_text")
    return docs.join(bad.withColumnRenamed("doc_id", key), digest == F.col(key), "left_anti")
