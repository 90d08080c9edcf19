"""Quality scores of documents by a small network over random-indexing word vectors.

A word (a run of letters and digits, A-Z lower-cased, or a run of other characters that are not white
space) has an index vector: ``NONZERO`` places of ``DIMENSIONS``, each +1 or -1, given by a hash of the
word. Its word vector is the sum of the index vectors of the words up to ``REACH`` places from it, over all
occurrences in all documents. Word vectors are held by ``BUCKETS`` hash buckets, so the table has one
size however many words there are, no word is left out, and words of one bucket share a vector.

A document's features are pooled over all its words: the mean of the word vectors (of unit length, less
the mean over the corpus), its length, their mean square length, and their mean product with the next
word's, which is high where words repeat. Two layers in numpy turn them into a logit; dividing it by a
temperature, fitted on a fifth of the sample that the weights do not see, gives calibrated probabilities.

Word vectors come from all documents. Weights are fitted on the driver on ``SAMPLE`` distinct labelled
texts at most, those with the smallest hashes; their pooled features are collected, not their texts.

Null and empty texts have no words and are scored by zero features. Texts that are labelled both ways count once for each.
Rows without id have no label. Without both labels there is nothing to tell apart: all scores are then (n1 + 1) / (n + 2).
Repeated rows get equal scores; an empty table has none. A long text is cut into words piece by piece, so only its word
hashes (8 bytes a word) are held whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from breachlens.llm.common import blocks, utf8
from breachlens.llm.pretokens import mixed
from breachlens.sources import new_folder
from breachlens.sources.layers import write_layer

BUCKETS = 1 << 15
DIMENSIONS = 32
NONZERO = 4
#: Places to each side that are a word's context.
REACH = 2
HIDDEN = 32
EPOCHS = 20
WEIGHT_DECAY = 1e-3
#: Bound of the training sample.
SAMPLE = 40_000
#: Text bytes whose words are found at once, and words that are looked at together.
BLOCK_BYTES = 1 << 20
WORDS = 1 << 16
#: Rows in which a task's sums are dealt out.
SLICES = 128

_SPACE, _WORD, _OTHER = range(3)
_KINDS = np.array(
    [_SPACE if b in b"\0 \t\n\r\x0b\x0c" else _WORD if chr(b).isalnum() or b >= 128 else _OTHER for b in range(256)], np.uint8
)
_LOWER = np.array([b + 33 if 65 <= b <= 90 else b + 1 for b in range(256)], np.uint64)
_BASE = 0x9E3779B97F4A7C15


# --- words ----------------------------------------------------------------------
@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2^64."""
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.cumprod(np.full(n, x, np.uint64)) for x in (_BASE, inverse))


def _hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, start) of each word, in order."""
    raw = np.frombuffer(data, np.uint8)
    kind = _KINDS[raw]
    cut = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]])) if len(raw) else np.empty(0, np.int64)
    ends = np.append(cut[1:], len(raw))[: len(cut)]
    real = kind[cut] != _SPACE
    starts, ends = cut[real], ends[real]
    size = 1 << max(16, (len(raw) - 1).bit_length())
    power, inverse = _powers(size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LOWER[raw] * power[: len(raw)])])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end before white space; a longer run without any stays whole."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        tail = text[at : at + BLOCK_BYTES]
        cut = max(tail.rfind(b" "), tail.rfind(b"\n"))
        if cut <= 0:
            after = [i for i in (text.find(b" ", at + BLOCK_BYTES), text.find(b"\n", at + BLOCK_BYTES)) if i >= 0]
            cut = min(after, default=len(text)) - at
        yield text[at : at + cut]
        at += cut
    yield text[at:]


def words(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes of the words of some texts in a row, number of words of each), block by block."""
    for start, stop in blocks(texts, BLOCK_BYTES):
        part = [t or b"" for t in texts[start:stop]]
        if len(part) == 1:
            found = np.concatenate([_hashes(piece)[0] for piece in _pieces(part[0])])
            yield found, np.array([len(found)])
        else:
            found, starts = _hashes(b"\0".join(part))
            edges = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in part]))
            yield found, np.diff(edges, prepend=0)


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS)).astype(np.int64)


def index_vectors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of each word's index vector; a place may come twice."""
    h = mixed(hashes + np.uint64(1))
    bits = [h >> np.uint64(16 * i) for i in range(NONZERO)]
    places = np.stack([(b & np.uint64(0xFF)) % np.uint64(DIMENSIONS) for b in bits], 1).astype(np.int64)
    return places, np.stack([1 - 2 * ((b >> np.uint64(8)) & np.uint64(1)).astype(np.int64) for b in bits], 1)


# --- word vectors ---------------------------------------------------------------
def add_contexts(table: np.ndarray, hashes: np.ndarray, per_text: np.ndarray) -> None:
    """Add the context of every word to ``table`` (bucket, DIMENSIONS and a count)."""
    owner = np.repeat(np.arange(len(per_text)), per_text)
    flat = table.reshape(-1)
    for at in range(0, len(hashes), WORDS):
        low, high = max(0, at - REACH), min(len(hashes), at + WORDS + REACH)
        of, own = buckets(hashes[low:high]), owner[low:high]
        places, signs = index_vectors(hashes[low:high])
        here = np.arange(at, min(at + WORDS, len(hashes))) - low
        keys, weights = [of[here] * (DIMENSIONS + 1) + DIMENSIONS], [np.ones(len(here))]
        for step in [*range(-REACH, 0), *range(1, REACH + 1)]:
            good = here[(here + step >= 0) & (here + step < high - low)]
            good = good[own[good] == own[good + step]]
            keys.append((of[good][:, None] * (DIMENSIONS + 1) + places[good + step]).ravel())
            weights.append(signs[good + step].ravel())
        key, where = np.unique(np.concatenate(keys), return_inverse=True)
        flat[key] += np.bincount(where, np.concatenate(weights)).astype(flat.dtype)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's table, as 4-byte integers; it goes out before a number could get too large for them."""
    table, added = np.zeros((BUCKETS, DIMENSIONS + 1), np.int64), 0

    def out() -> pa.RecordBatch:
        parts = [p.astype("<i4").tobytes() for p in np.split(table, SLICES)]
        return pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], ["slice", "sums"])

    for batch in batches:
        for hashes, per_text in words(batch.column(0).to_pylist()):
            most = 2 * REACH * NONZERO * len(hashes)
            if added and added + most > 1 << 30:
                yield out()
                table[:], added = 0, 0
            add_contexts(table, hashes, per_text)
            added += most
    if added:
        yield out()


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(sums.as_py(), "<i4")
            totals[number] = totals[number] + part if number in totals else part.astype(np.int64)
    if totals:
        rows = [pa.array(totals, pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(rows, ["slice", "sums"])


def context_sums(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """(bucket, DIMENSIONS and a count) over all documents. What reaches the driver has a fixed size."""
    schema = "slice int, sums binary"
    parts = docs.select(utf8(text_col).alias("text")).mapInArrow(_sums, schema)
    rows = parts.repartition("slice").mapInArrow(_add_up, schema).collect()
    table = np.zeros((SLICES, BUCKETS // SLICES * (DIMENSIONS + 1)), np.int64)
    for row in rows:
        table[row["slice"]] += np.frombuffer(row.sums, "<i8")
    return table.reshape(BUCKETS, DIMENSIONS + 1)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit vectors less their mean over all occurrences; zero for buckets without words."""
    vectors, n = sums[:, :DIMENSIONS].astype(np.float64), sums[:, DIMENSIONS]
    vectors /= np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-9)
    vectors -= (vectors * n[:, None]).sum(0) / max(1, int(n.sum()))
    vectors[n == 0] = 0
    return vectors.astype(np.float32)


# --- documents ------------------------------------------------------------------
def pooled(vectors: np.ndarray, hashes: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Features of each text: mean vector, its length, mean square length, mean product of neighbours."""
    sums = np.zeros((len(per_text), DIMENSIONS + 2))
    owner = np.repeat(np.arange(len(per_text)), per_text)
    for at in range(0, len(hashes), WORDS):
        here = vectors[buckets(hashes[at : at + WORDS + 1])].astype(np.float64)
        own = owner[at : at + WORDS + 1]
        n = min(WORDS, len(hashes) - at)
        next_one = np.zeros(n)
        pairs = min(n, len(here) - 1)
        next_one[:pairs] = (here[:pairs] * here[1 : pairs + 1]).sum(1) * (own[:pairs] == own[1 : pairs + 1])
        each = np.concatenate([here[:n], (here[:n] ** 2).sum(1)[:, None], next_one[:, None]], 1)
        first = np.flatnonzero(np.concatenate([[True], own[1:n] != own[: n - 1]]))
        sums[own[first]] += np.add.reduceat(each, first)
    sums /= np.maximum(per_text, 1)[:, None]
    length = np.sqrt((sums[:, :DIMENSIONS] ** 2).sum(1))
    return np.concatenate([sums[:, :DIMENSIONS], length[:, None], sums[:, DIMENSIONS:]], 1)


def features(vectors: np.ndarray, texts: list[bytes | None]) -> np.ndarray:
    found = [pooled(vectors, hashes, per_text) for hashes, per_text in words(texts)]
    return np.concatenate(found) if found else np.empty((0, DIMENSIONS + 3))


# --- network --------------------------------------------------------------------
def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Network:
    """Scaling of the features, two layers and the temperature. Without layers, one score for all."""

    shift: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.maximum((x - self.shift) / self.scale @ w1 + b1, 0) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(self.logits(x) / self.temperature)

    def step(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean log loss, in the order of ``layers``; x is scaled already."""
        w1, b1, w2, b2 = self.layers
        hidden = np.maximum(x @ w1 + b1, 0)
        back = (_sigmoid(hidden @ w2 + b2) - y) / len(y)
        inner = np.outer(back, w2) * (hidden > 0)
        return [x.T @ inner + WEIGHT_DECAY * w1, inner.sum(0), hidden.T @ back, np.array([back.sum()])]


def log_loss(logits: np.ndarray, y: np.ndarray, temperature: float) -> float:
    return float(np.logaddexp(0, np.where(y == 1, -logits, logits) / temperature).mean())


def fitted_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss; 1 where there is only one label."""
    if len(set(y.tolist())) < 2:
        return 1.0
    tried = np.geomspace(0.2, 20, 200)
    return float(tried[np.argmin([log_loss(logits, y, t) for t in tried])])


def fit(x: np.ndarray, y: np.ndarray, seed: int = 0) -> Network:
    """Network of labelled features, trained by Adam; every fifth row is left for the temperature."""
    if len(set(y.tolist())) < 2:
        empty = np.empty(0)
        return Network(empty, empty, [], constant=(float(y.sum()) + 1) / (len(y) + 2))
    rng = np.random.default_rng(seed)
    apart = np.arange(len(y)) % 5 == 4
    if len(set(y[~apart].tolist())) < 2:
        apart[:] = False
    shift, scale = x[~apart].mean(0), x[~apart].std(0) + 1e-6
    n = x.shape[1]
    layers = [rng.standard_normal((n, HIDDEN)) * n**-0.5, np.zeros(HIDDEN), rng.standard_normal(HIDDEN) * HIDDEN**-0.5, np.zeros(1)]
    network = Network(shift, scale, layers)
    scaled, labels = (x[~apart] - shift) / scale, y[~apart]
    means, squares, t = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), 64):
            t += 1
            part = order[at : at + 64]
            for w, g, m, v in zip(layers, network.step(scaled[part], labels[part]), means, squares):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    network.temperature = fitted_temperature(network.logits(x[apart]), y[apart])
    return network


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network


def _featured(vectors: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = features(vectors, batch["text"].tolist())
            yield pd.DataFrame({"hash": batch["hash"], "label": batch["label"], "features": list(found)})

    return run


def _sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(hash, label, text): the labelled texts with the smallest hashes, ``SAMPLE`` at most, each text once per label.

    Only ids and hashes are shuffled to find them; texts are joined by the hash, one copy per task.
    """
    key = F.col(f"`{id_col}`")
    text_hash = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    known = labels.where(F.col(f"`{label_col}`").isin(0, 1)).select(key.alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).distinct()
    rows = docs.where(usable).select(key.alias("id"), text_hash.alias("hash"))
    labelled = write_layer(rows.join(known, "id").select("hash", "label").distinct(), new_folder(spark, "quality-labels"))
    n = labelled.count()
    if n > SAMPLE:  # some twice as many as wanted are sorted, not all
        few = F.pmod("hash", F.lit(1 << 32)) < F.lit(min(1 << 32, int(2 * SAMPLE / n * (1 << 32))))
        labelled = labelled.where(few)
    chosen = write_layer(labelled.orderBy(F.pmod("hash", F.lit(1 << 32)), "hash", "label").limit(SAMPLE), new_folder(spark, "quality-sample"))
    texts = docs.where(usable).select(text_hash.alias("hash"), utf8(text_col).alias("text"))
    wanted = F.broadcast(chosen.select("hash").distinct())  # SAMPLE rows of 8 bytes at most
    texts = texts.join(wanted, "hash").groupBy("hash").agg(F.any_value("text").alias("text"))
    return chosen.join(texts, "hash")


def train(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, usable: Column,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> QualityModel:
    """Word vectors of all ``docs``, and a network fitted to the labels of those rows of ``docs`` where ``usable`` holds."""
    vectors = word_vectors(context_sums(docs, text_col))
    sample = _sample(spark, docs, labels, usable, id_col, text_col, label_col)
    rows = sample.mapInPandas(_featured(vectors), "hash bigint, label int, features array<double>").collect()
    rows.sort(key=lambda r: (r.hash & 0xFFFFFFFF, r.hash, r.label))
    x = np.array([r.features for r in rows]).reshape(-1, DIMENSIONS + 3)
    return QualityModel(vectors, fit(x, np.array([r.label for r in rows], np.int64)))


def score(text: Column, model: QualityModel) -> Column:
    """Probability of label 1 for UTF-8 bytes."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.network.scores(features(model.vectors, batch.tolist())))

    return F.pandas_udf(run, "double")(text)
