"""Token ids of documents in Simple-8b files, in ascending order of document ids.

A file is one partition of the id order. Each of its rows holds whole documents (about
``ROW_IDS`` ids, or one longer document): their ids and lengths, the Simple-8b words of all their
token ids and the word offset of each block of the coding. Parquet is only the container of the
words; the rows are found by range, and the blocks of a row are decoded at once.

Null and empty texts hold the end id alone. Rows with one document id stand next to each other in
the order of a hash of their texts, equal texts in no order that shows; rows without id come first. However
many rows share an id or lack one, they are dealt out over files. An empty table has no rows. Ids must be
whole numbers (they are cast to bigint); other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from breachlens.llm import simple8b
from breachlens.llm.common import blocks, utf8
from breachlens.llm.pretokens import PieceTable, cut_pretokens, distinct_pieces, valid_utf8

#: Token ids of one row; a longer document is a row of its own.
ROW_IDS = 1 << 18
#: Text bytes that are tokenized together.
BLOCK_BYTES = 2 << 20
#: Pre-tokens whose ids a worker remembers.
CACHE_ENTRIES = 1_000_000

FILE = (
    "part int, row int, start bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "offsets array<bigint>, words binary"
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()), ("row", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("words", pa.binary()),
    ]
)
DOCUMENT = "part int, start bigint, doc_id bigint, n_tokens bigint, ids binary"
#: Pre-tokens that are joined to one text for the library.
_JOINED = 256
#: Fixed value: a pre-tokenizer that cuts texts as ``cut_pretokens`` does.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


class Encoder:
    """The tokenizers library, asked once for each distinct pre-token.

    Byte-level BPE never merges across pre-tokens, so the ids of a text are those of its
    pre-tokens in a row. Tokenizers of other kinds get whole texts. Strings of special tokens have their
    own ids, as in the library's default; without ``special_tokens`` they are ordinary text.
    """

    def __init__(self, tokenizer_json: str, special_tokens: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer_json)
        self.library.encode_special_tokens = not special_tokens
        spec = json.loads(tokenizer_json)
        added = [t for t in spec.get("added_tokens") or () if t["content"] and (special_tokens or not t["special"])]
        plain = not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")) and not any(" " in t["content"] for t in added)
        #: ids of the tokens at which texts are cut; where several begin, the library takes the longest
        self.added_ids = {t["content"].encode(): np.array([self.library.token_to_id(t["content"])], np.uint32) for t in added}
        longest_first = sorted(self.added_ids, key=len, reverse=True)
        self.added = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")") if added else None
        kind = {k: (spec.get("pre_tokenizer") or {}).get(k, d) for k, d in (("type", None), ("add_prefix_space", True), ("use_regex", True))}
        self.by_piece = kind == _BYTE_LEVEL and spec.get("normalizer") is None and spec["model"]["type"] == "BPE" and plain
        #: bytes of each token: its text has a character for each
        self.sizes = np.zeros(self.library.get_vocab_size(), np.int64)
        for token, i in self.library.get_vocab().items() if self.by_piece else ():
            self.sizes[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.known = PieceTable()
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _ask(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        found = [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), np.uint32), np.array([len(x) for x in found], np.int64)

    def _ask_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pre-tokens that begin with a space. Joined, they are cut as before, and the
        library needs a third less time; where its tokens don't end with the words, it is asked anew."""
        ids, _ = self._ask(["".join(words[i : i + _JOINED]) for i in range(0, len(words), _JOINED)])
        ends = np.cumsum([len(w.encode()) for w in words])
        token_ends = np.cumsum(self.sizes[ids])
        last = np.searchsorted(token_ends, ends)
        if len(ids) and last[-1] + 1 == len(ids) and (token_ends[last] == ends).all():
            return ids, np.diff(last, prepend=-1)
        return self._ask(words)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        if not self.by_piece:
            return self._ask([t.decode() for t in texts])
        parts = [self.added.split(t) for t in texts] if self.added else []
        if all(len(p) == 1 for p in parts):
            return self._encode_pieces(texts)
        # every second part is an added token
        ids, counts = self._encode_pieces([x for p in parts for x in p[::2]])
        between = iter(np.split(ids, np.cumsum(counts)[:-1]))
        own = [np.concatenate([self.added_ids[x] if i % 2 else next(between) for i, x in enumerate(p)]) for p in parts]
        return np.concatenate(own), np.array([len(x) for x in own], np.int64)

    def _encode_pieces(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        if len(self.ends) > CACHE_ENTRIES:
            self._forget()
        data, starts, lengths, per_text = cut_pretokens(texts)
        codes, places = distinct_pieces(data, starts, lengths)
        begins, sizes = starts[places], lengths[places]
        slots = self.known.find(data, begins, sizes)
        new = np.flatnonzero(slots < 0)
        if len(new):
            strings = {i: data[a : a + n].decode() for i, a, n in zip(new.tolist(), begins[new].tolist(), sizes[new].tolist())}
            words = [i for i, s in strings.items() if len(s) > 1 and s[0] == " " and not s[1].isspace()]
            rest = sorted(set(strings) - set(words))
            for ask, which in ((self._ask_words, words), (self._ask, rest)):
                if which:
                    slots[which] = len(self.ends) - 1 + np.arange(len(which))
                    ids, counts = ask([strings[i] for i in which])
                    self.ids = np.concatenate([self.ids, ids])
                    self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
            self.known.add(data, begins[new], sizes[new], slots[new])
        slots = slots[codes]
        n = self.ends[slots + 1] - self.ends[slots]
        total = np.cumsum(n)
        ids = self.ids[np.arange(int(n.sum())) + np.repeat(self.ends[slots] - total + n, n)]
        return ids, np.diff(np.concatenate([[0], total])[np.cumsum(per_text)], prepend=0)


@cache
def _encoder(tokenizer_json: str, special_tokens: bool) -> Encoder:
    return Encoder(tokenizer_json, special_tokens)


def _file_row(part: int, row: int, start: int, doc_ids: list, lengths: list[int], ids: list[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate(ids)
    words, offsets = simple8b.encode(flat)
    values = [part, row, start, len(flat), doc_ids, lengths, offsets.tolist(), words.astype("<u8").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _ARROW)], schema=_ARROW)


def _write_part(tokenizer_json: str, end_id: int, special_tokens: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer_json, special_tokens), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        row = start = held = 0
        doc_ids, lengths, ids = [], [], []
        for batch in batches:
            texts = [valid_utf8(t.as_py()) for t in batch.column(1)]
            keys = batch.column(0).to_pylist()
            for first, stop in blocks(texts, BLOCK_BYTES):
                flat, counts = encoder.encode(texts[first:stop])
                for key, own in zip(keys[first:stop], np.split(flat, np.cumsum(counts)[:-1])):
                    if held and held + len(own) + 1 > ROW_IDS:
                        yield _file_row(part, row, start, doc_ids, lengths, ids)
                        row, start, held, doc_ids, lengths, ids = row + 1, start + held, 0, [], [], []
                    doc_ids.append(key)
                    lengths.append(len(own) + 1)
                    ids += [own, end]
                    held += len(own) + 1
        if held:
            yield _file_row(part, row, start, doc_ids, lengths, ids)

    return run


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    special_tokens: bool = True,
) -> None:
    """Tokenize ``docs`` and write their ids, each document followed by ``end_id``, to ``folder``.

    Texts that hold the string of a special token get that token's id there, as from the library as loaded;
    without ``special_tokens`` such strings are ordinary text. The one shuffle is that of the texts into ranges
    of document ids, in which a hash of the text and the row's place divide rows of one id.
    """
    tokenizer_json = Path(tokenizer_path).read_text()
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), utf8(text_col).alias("text"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("hash"), F.monotonically_increasing_id().alias("place"),
    )
    keys = ["doc_id", "hash", "place"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    ordered.mapInArrow(_write_part(tokenizer_json, end_id, special_tokens), FILE).write.parquet(folder)


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), np.array(row["offsets"], np.int64), row["n_ids"])
            lengths = np.array(row["lengths"], np.int64)
            edges = np.concatenate([[0], np.cumsum(lengths)]) * 4
            data = ids.astype("<u4").tobytes()
            starts = row["start"] + np.cumsum(lengths) - lengths
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(lengths), row["part"], np.int32)), pa.array(starts),
                    pa.array(row["doc_ids"], pa.int64()), pa.array(lengths),
                    pa.array([data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.binary()),
                ],
                names=["part", "start", "doc_id", "n_tokens", "ids"],
            )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: part, start within the part, doc_id, n_tokens, ids (little-endian, 32 bits)."""
    return spark.read.schema(FILE).parquet(folder).mapInArrow(_read_rows, DOCUMENT)


def part_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(part, part_start): ids in all parts before. One row per file goes through the running sum."""
    totals = spark.read.schema(FILE).parquet(folder).groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
