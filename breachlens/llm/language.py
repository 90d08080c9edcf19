"""Language identification by a convolutional network over bytes, trained and applied in numpy.

A window of ``WINDOW`` bytes (A-Z lower-cased) is embedded byte by byte; filters of several widths run
over it, each keeps its largest response, and a softmax layer turns those into probabilities of the
languages. A text's probabilities are those of all its windows, weighted by their bytes.

The network is fitted on the driver from a bounded sample of labelled texts: of each
language the ``SAMPLE_DOCS`` distinct texts with the smallest hash, ``SAMPLE_WINDOWS`` windows of each.
Labelled texts beyond that do not change what is collected. Predictions see the text only.

Null texts and texts without a letter are ``und`` with score 0, and so is everything if there is no
labelled text to learn from. Rows are independent, whatever ids they share or lack; equal texts get equal
results, and a text that is repeated counts once in the sample. An empty table has no predictions. Columns
other than those named in the arguments are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breachlens.llm.common import blocks, utf8
from breachlens.sources import new_folder
from breachlens.sources.layers import write_layer

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Bound of the training sample, per language.
SAMPLE_DOCS = 300
SAMPLE_WINDOWS = 8
EPOCHS = 8
#: Text bytes whose windows are made together, and windows that go through the network together.
BLOCK_BYTES = 4 << 20
BATCH = 64

_PAD = 256
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = regex.compile(r"\p{L}")


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text) or not text.isascii() and _LETTER.search(text.decode(errors="replace")))


def _layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of each window padded at its end, number of bytes in it)."""
    sizes = np.array([min(WINDOW, len(t) - i) for t in texts for i in range(0, max(1, len(t)), WINDOW)], np.int64)
    flat = np.frombuffer(b"".join(texts).translate(_LOWER), np.uint8)
    out = np.full((len(sizes), WINDOW + max(WIDTHS) - 1), _PAD, np.int64)
    out[:, :WINDOW][np.arange(WINDOW) < sizes[:, None]] = flat
    return out, sizes


@dataclass
class ByteNetwork:
    """Weights: byte embedding, per width a filter bank (width, EMBEDDING, FILTERS), and the softmax layer."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    @classmethod
    def random(cls, languages: list[str], seed: int = 0) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        make = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        embedding = make(0.5, 257, EMBEDDING)
        embedding[_PAD] = 0
        n = FILTERS * len(WIDTHS)
        return cls(
            languages, embedding, [make((w * EMBEDDING) ** -0.5, w, EMBEDDING, FILTERS) for w in WIDTHS],
            np.zeros(n, np.float32), make(n**-0.5, n, len(languages)), np.zeros(len(languages), np.float32),
        )

    def tables(self) -> list[np.ndarray]:
        """Response of every filter to every byte, by the byte's place in the filter; wider filters last."""
        return [
            np.ascontiguousarray(np.concatenate([self.embedding @ f[k] for f in self.filters if k < len(f)], 1))
            for k in range(max(WIDTHS))
        ]

    def responses(self, windows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """(window, place, filter): what each filter gives at each place."""
        n = FILTERS * len(WIDTHS)
        out = np.take(tables[0], windows[:, :WINDOW], axis=0)
        for k in range(1, len(tables)):
            part = np.take(tables[k], windows[:, k : WINDOW + k], axis=0)
            out[:, :, n - part.shape[2] :] += part
        return out

    def probabilities(self, windows: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        hidden = np.maximum(self.responses(windows, tables).max(1) + self.bias, 0)
        return _softmax(hidden @ self.dense + self.dense_bias)

    def predict(self, texts: list[bytes]) -> list[tuple[str, float]]:
        """(language, score) of each text. A long text goes through in pieces of whole windows."""
        tables, size = self.tables(), max(WINDOW, BLOCK_BYTES // WINDOW * WINDOW)
        owner = [i for i, t in enumerate(texts) for _ in range(0, max(1, len(t)), size)]
        pieces = [t[a : a + size] for t in texts for a in range(0, max(1, len(t)), size)]
        total, weight = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for start, stop in blocks(pieces, BLOCK_BYTES):
            windows, sizes = _layout(pieces[start:stop])
            p = np.concatenate([self.probabilities(windows[i : i + BATCH], tables) for i in range(0, len(windows), BATCH)])
            per_piece = np.array([max(1, -(-len(t) // WINDOW)) for t in pieces[start:stop]])
            of = np.repeat(owner[start:stop], per_piece)
            np.add.at(total, of, p * sizes[:, None])
            np.add.at(weight, of, sizes)
        total /= np.maximum(weight, 1)[:, None]
        return [(self.languages[b], min(1.0, float(t[b]))) for b, t in zip(total.argmax(1), total)]

    def step(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and gradients, in the order of ``weights``. Only each filter's best place has a gradient."""
        response = self.responses(windows, self.tables())
        place = response.argmax(1)
        best = np.take_along_axis(response, place[:, None], 1)[:, 0] + self.bias
        hidden = np.maximum(best, 0)
        p = _softmax(hidden @ self.dense + self.dense_bias)
        rows = np.arange(len(labels))
        loss = -float(np.log(p[rows, labels] + 1e-9).mean())
        p[rows, labels] -= 1
        p /= len(labels)
        back = (p @ self.dense.T) * (best > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters = []
        for i, bank in enumerate(self.filters):
            mine = slice(i * FILTERS, (i + 1) * FILTERS)
            d_bank = np.empty_like(bank)
            for k in range(len(bank)):
                seen = windows[rows[:, None], place[:, mine] + k]
                d_bank[k] = np.einsum("bf,bfe->ef", back[:, mine], self.embedding[seen])
                np.add.at(d_embedding, seen, back[:, mine, None] * bank[k].T[None])
            d_filters.append(d_bank)
        d_embedding[_PAD] = 0
        return loss, [d_embedding, *d_filters, back.sum(0), hidden.T @ p, p.sum(0)]

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.dense, self.dense_bias]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def fit(windows: list[bytes], labels: list[str], seed: int = 0) -> ByteNetwork:
    """Train on labelled windows with Adam; the same input gives the same network."""
    languages = sorted(set(labels))
    network = ByteNetwork.random(languages, seed)
    x, _ = _layout([w[:WINDOW] for w in windows])
    y = np.searchsorted(languages, labels)
    rng = np.random.default_rng(seed + 1)
    means = [np.zeros_like(w) for w in network.weights()]
    squares = [np.zeros_like(w) for w in network.weights()]
    t = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH):
            t += 1
            part = order[i : i + BATCH]
            _, gradients = network.step(x[part], y[part])
            for w, g, m, v in zip(network.weights(), gradients, means, squares):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.005 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return network


def _sample_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for order, lang, text in zip(batch["order"], batch["lang"], batch["text"]):
            if not text or not has_letter(text):
                continue
            rng = np.random.default_rng(abs(int(order)))
            last = max(0, len(text) - WINDOW)
            for at in sorted({int(i) for i in rng.integers(0, last + 1, SAMPLE_WINDOWS)}):
                out.append((order, at, lang, text[at : at + WINDOW]))
        yield pd.DataFrame(out, columns=["order", "place", "lang", "piece"])


def train(docs: DataFrame, usable: Column, text_col: str = "text", lang_col: str = "lang") -> ByteNetwork | None:
    """Network fitted on the sample of ``docs`` where ``usable`` holds; None if it has no labelled text."""
    order = F.xxhash64(F.col(f"`{text_col}`"))
    labelled = docs.where(usable & F.col(f"`{lang_col}`").isNotNull() & (F.octet_length(F.col(f"`{text_col}`")) > 0))
    # first among a 256th of a language's texts, then among what is left: no task sees them all
    few = F.row_number().over(Window.partitionBy("lang", F.pmod("order", F.lit(256))).orderBy("order"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    chosen = labelled.select(F.col(f"`{lang_col}`").alias("lang"), order.alias("order")).distinct()
    chosen = chosen.withColumn("rank", few).where(F.col("rank") <= SAMPLE_DOCS)
    chosen = chosen.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_DOCS).select("lang", "order")
    chosen = write_layer(chosen, new_folder(docs.sparkSession, "language-sample"))  # of known size: no need to shuffle the texts
    texts = labelled.select(F.col(f"`{lang_col}`").alias("lang"), order.alias("order"), utf8(text_col).alias("text"))
    once = texts.join(chosen, ["lang", "order"]).groupBy("lang", "order").agg(F.any_value("text").alias("text"))
    pieces = once.select("order", "lang", "text").mapInPandas(_sample_windows, "order bigint, place bigint, lang string, piece binary")
    rows = sorted((r.order, r.place, r.lang, bytes(r.piece)) for r in pieces.collect())
    return fit([r[3] for r in rows], [r[2] for r in rows]) if rows else None


def predict(text: Column, network: ByteNetwork | None) -> Column:
    """struct(lang, score) of UTF-8 bytes."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [("und", 0.0)] * len(batch)
            known = [i for i, t in enumerate(batch) if network is not None and t and has_letter(t)]
            for i, result in zip(known, network.predict([batch.iloc[i] for i in known]) if known else []):
                found[i] = result
            yield pd.DataFrame(found, columns=["lang", "score"])

    return F.pandas_udf(run, "lang string, score double")(text)
