"""Secret scan: patterns find candidates, a random forest removes the false positives.

Candidates are private keys from their header to their end line, keys in the formats of issuers, values
assigned to a name that ends like a secret's, quoted ones with their blanks, and any other unbroken run of 20 key
characters or more, each to its end. They are taken in this order, so a key of an issuer is found as such within an
address, a path or an assigned value, and no place belongs to two. For each candidate a few numbers are measured: its length, the transitions between kinds of characters, how much of it dictionary words
cover, what its path looks like, and the words next to it. A random forest (Spark's own) trained
from labelled findings then gives each candidate the probability of being a secret.

Findings can be labelled by the caller. Without labels, the column ``weak`` labels the certain ones:
placeholders are none; issuers' formats are secrets, in addresses too; other parts of addresses are none; assigned values
that mix letters and digits are secrets; runs without a digit are none; the rest stays unlabelled and is left to the forest.

The forest is fitted on the ``SAMPLE`` labelled findings of each label with the smallest hash. The
dictionary is counted over all texts: the ``DICTIONARY`` words that most texts use.

Null and empty texts have no findings; rows with equal ids or texts have findings each. Places are bytes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from breachlens.llm.common import unused_name, utf8
from breachlens.sources import new_folder
from breachlens.sources.layers import write_layer

#: Bound of the training sample, per label.
SAMPLE = 5_000
#: Words of the dictionary, a parameter of the model.
DICTIONARY = 20_000
TREES, DEPTH = 30, 6

#: Names that secrets are assigned to.
_NAMES = rb"passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential"
#: Formats of well-known issuers.
_ISSUED = (
    rb"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|gh[pousr]_[0-9A-Za-z]{36,}|xox[abpr]-[0-9A-Za-z-]{10,}"
    rb"|sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35}|eyJ[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]+"
)
_ISSUED_KEY = re.compile(rb"(?<![0-9A-Za-z])(?:" + _ISSUED + rb")")
_HEADER = re.compile(rb"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")
_END_LINE = re.compile(rb"-----END [A-Z ]{0,20}PRIVATE KEY-----")
#: What may stand in a private key whose end line is lost.
_KEY_BODY = re.compile(rb"(?:[\r\n]++(?:[0-9A-Za-z+/=]++(?=[\r\n]|\Z)|(?:Proc-Type|DEK-Info): [^\r\n]*+))*+")
_ASSIGNED = re.compile(
    rb"(?i:" + _NAMES + rb")[\"']?[ \t]*+(?>:=|=>|[:=])[ \t]*+"
    rb"(?:\"(?P<double>[^\"\r\n]{8,}+)\"|'(?P<single>[^'\r\n]{8,}+)'|[\"']?(?P<plain>[^\s\"']{8,}+))"
)
_NAME_TAIL = re.compile(rb"(?<![0-9A-Za-z_.-])[0-9A-Za-z_.-]*+\Z")
_RUN = re.compile(rb"(?<![0-9A-Za-z_+/=.-])[0-9A-Za-z_+/=.-]{20,}+")
_PLACEHOLDER = re.compile(rb"(?i)example|change.?me|placeholder|your[_-]|xxxx|dummy|<[a-z_ ]+>|\*\*\*")
_TEST_PATH = re.compile(r"(?i)test|example|sample|doc|fixture|mock")
_WORD = re.compile(rb"[a-z]{4,16}")
_DICTIONARY_WORD = re.compile(rb"(?<![a-z])[a-z]{4,12}(?![a-z])")

FEATURES = (
    "length", "entropy", "to_digit", "to_upper", "to_other", "digits", "bigrams", "coverage", "longest_word",
    "path_depth", "test_path", "named", "quoted", "assigned", "in_address", "neighbours_known",
)
FINDING = (
    "finding bigint, kind string, start bigint, stop bigint, value string, weak int, "
    + ", ".join(f"{name} double" for name in FEATURES)
)


# --- dictionary -----------------------------------------------------------------
def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of texts that use each word, for a batch of texts."""
    for batch in batches:
        counts: Counter[bytes] = Counter()
        for text in batch.column(0):
            text = text.as_py()
            if text:
                counts.update(set(_DICTIONARY_WORD.findall(text.lower())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> dict[bytes, int]:
    """At most ``size`` words that most texts use, with the number of those; counted over all texts.

    Words of the count at which the size would be passed are left out together, so the cut is a
    count: only the numbers of words per count are sorted, and no task or driver holds more words.
    """
    words = docs.select(utf8(text_col).alias("text")).mapInArrow(_text_words, "word binary, n bigint")
    counts = write_layer(words.groupBy("word").agg(F.sum("n").alias("n")), new_folder(docs.sparkSession, "words"))
    per_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    more = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = per_count.withColumn("held", F.sum("words").over(more)).where(F.col("held") <= size).agg(F.min("n")).first()[0]
    top = counts.where(F.col("n") >= least) if least is not None else counts.where("false")
    return {bytes(r.word): r.n for r in top.collect()}


# --- candidates -----------------------------------------------------------------
def _private_keys(text: bytes) -> Iterator[tuple[int, int]]:
    """From each header to its end line; to the end of what looks like a key if another header or nothing follows."""
    headers = list(_HEADER.finditer(text))
    for header, following in zip(headers, [*headers[1:], None]):
        last = following.start() if following else len(text)
        end = _END_LINE.search(text, header.end(), last)
        yield header.start(), end.end() if end else _KEY_BODY.match(text, header.end(), last).end()


def _name_start(text: bytes, at: int) -> int:
    """Where the name begins that holds the place ``at``."""
    return _NAME_TAIL.search(text, max(0, at - 256), at).start()


def candidates(text: bytes) -> list[tuple[int, int, str]]:
    """(start, stop, kind) of all candidates, in order; none overlap."""
    taken: list[tuple[int, int, str]] = []

    def add(spans: Iterable[tuple[int, int]], kind: str) -> None:
        """Those that touch none of the kinds before."""
        known, at, new = sorted(taken), 0, []
        for start, stop in spans:
            while at < len(known) and known[at][1] <= start:
                at += 1
            if at == len(known) or known[at][0] >= stop:
                new.append((start, stop, kind))
        taken.extend(new)

    add(_private_keys(text), "block")
    add((m.span() for m in _ISSUED_KEY.finditer(text)), "issued")
    assigned = {m.span(m.lastgroup): m.start() for m in _ASSIGNED.finditer(text)}
    add(assigned, "assigned")
    # a run begins or ends where a candidate or the name of one stands
    taken_up = [(_name_start(text, assigned[a, b]) if kind == "assigned" else a, b) for a, b, kind in taken]
    gaps, at = [], 0
    for start, stop in [*sorted(taken_up), (len(text), len(text))]:
        gaps.append((at, start))
        at = max(at, stop)
    add([m.span() for start, stop in gaps if start < stop for m in _RUN.finditer(text, start, stop)], "run")
    return sorted(taken)


class _Measures:
    def __init__(self, words: dict[bytes, int]):
        self.words = set(words)
        pairs: Counter[bytes] = Counter()
        for word, n in words.items():
            for i in range(len(word) - 1):
                pairs[word[i : i + 2]] += n
        total = sum(pairs.values()) or 1
        self.pairs = {pair: math.log((n + 1) / total) for pair, n in pairs.items()}
        self.unseen = math.log(1 / total)

    def known_letters(self, value: bytes) -> tuple[int, int]:
        """(letters inside dictionary words, longest such word), found greedily from the left."""
        covered = longest = 0
        for run in _WORD.finditer(value):
            text, at = run[0], 0
            while at < len(text) - 3:
                size = next((n for n in range(min(12, len(text) - at), 3, -1) if text[at : at + n] in self.words), 0)
                covered += size
                longest = max(longest, size)
                at += size or 1
        return covered, longest

    def of(self, text: bytes, kind: str, start: int, stop: int, path: str) -> list[float]:
        value = text[start:stop]
        n = len(value)
        kinds = [0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 for c in value]
        into = Counter(b for a, b in zip(kinds, kinds[1:]) if a != b)
        counts = Counter(value).values()
        lowered = value.lower()
        covered, longest = self.known_letters(lowered)
        pairs = [self.pairs.get(lowered[i : i + 2], self.unseen) for i in range(n - 1)]
        before, after = text[max(0, start - 40) : start], text[stop : stop + 40]
        near = re.findall(rb"[a-z]+", before.lower())[-2:] + re.findall(rb"[a-z]+", after.lower())[:2]
        return [
            float(n), -sum(c / n * math.log2(c / n) for c in counts), into[2] / n, into[1] / n, into[3] / n, kinds.count(2) / n,
            sum(pairs) / len(pairs) if pairs else 0.0, covered / n, float(longest), float(path.count("/") + path.count("\\")),
            float(bool(_TEST_PATH.search(path))), float(any(re.fullmatch(_NAMES, w) for w in near)),
            float(before[-1:] in (b'"', b"'") or after[:1] in (b'"', b"'")), float(kind == "assigned"),
            float(b"://" in text[max(0, start - 12) : stop] or before[-1:] in (b"/", b"@", b"#")),
            sum(w in self.words for w in near) / 4,
        ]


def _weak_label(kind: str, value: bytes, in_address: float) -> int | None:
    """1 for certain secrets, 0 for certain false findings, None where only a person could say."""
    if kind == "block":
        return 1
    if _PLACEHOLDER.search(value):
        return 0
    if kind == "issued":
        return 1
    if in_address:
        return 0
    mixed = any(48 <= c <= 57 for c in value) and any(c > 57 for c in value)
    if kind == "assigned" and mixed:
        return 1
    return None if kind == "run" and mixed else 0


def _candidates(words: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measures = _Measures(words)
        for batch in batches:
            rows = []
            for doc_id, text, path in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for number, (start, stop, kind) in enumerate(candidates(text or b"")):
                    found, value = measures.of(text, kind, start, stop, path or ""), text[start:stop]
                    weak = _weak_label(kind, value, found[FEATURES.index("in_address")])
                    rows.append((doc_id, number, kind, start, stop, value.decode(errors="replace"), weak, *found))
            names = ["doc_id", *(part.split()[0] for part in FINDING.split(", "))]
            types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32()]
            types += [pa.float64()] * len(FEATURES)
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    return run


def find_candidates(
    docs: DataFrame, words: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None
) -> DataFrame:
    """(doc_id, finding, kind, start, stop, value, weak, features...): one row per candidate."""
    path = F.col(f"`{path_col}`").cast("string") if path_col else F.lit("")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), utf8(text_col).alias("text"), path.alias("path"))
    return rows.mapInArrow(_candidates(words), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {FINDING}")


# --- forest ---------------------------------------------------------------------
def _vectors(findings: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(findings)


def train_forest(findings: DataFrame, label: str = "weak", seed: int = 7) -> RandomForestClassificationModel | None:
    """Forest fitted on a bounded sample of the labelled findings; None without findings of both labels."""
    order = F.xxhash64("value", "doc_id", "start")
    rank = F.row_number().over(Window.partitionBy("label").orderBy("order", *FEATURES))
    labelled = findings.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), order.alias("order"), *FEATURES)
    sample = labelled.withColumn("rank", rank).where(F.col("rank") <= SAMPLE)
    sample = write_layer(sample.select("label", "order", *FEATURES), new_folder(findings.sparkSession, "labelled-findings"))
    if sample.select("label").distinct().count() < 2:
        return None
    sample = sample.coalesce(1).sortWithinPartitions("label", "order", *FEATURES)  # bounded; the same trees in each run
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed).fit(_vectors(sample))


def score_findings(findings: DataFrame, forest: RandomForestClassificationModel | None) -> DataFrame:
    """Findings with ``score``, the probability of a secret. Without a forest the weak label is the score."""
    if forest is None:
        return findings.withColumn("score", F.coalesce(F.col("weak").cast("double"), F.lit(0.5)))
    scored = forest.transform(_vectors(findings))
    return scored.select(*findings.columns, vector_to_array("probability")[1].alias("score"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """One row per candidate: doc_id, finding, kind, start, stop, value, score, is_secret (score of 0.5 or more)."""
    words = dictionary(docs, text_col)
    found = write_layer(find_candidates(docs, words, id_col, text_col, path_col), new_folder(docs.sparkSession, "findings"))
    scored = score_findings(found, train_forest(found))
    return scored.select("doc_id", "finding", "kind", "start", "stop", "value", "score", (F.col("score") >= 0.5).alias("is_secret"))


def redact(docs: DataFrame, text_col: str = "text", **names: str) -> DataFrame:
    """``docs`` with every found secret replaced by ``[secret]``; all columns stay."""
    id_col = names.get("id_col", "doc_id")
    spans = scan_secrets(docs, text_col=text_col, **names).where("is_secret")
    spans = spans.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    key, own = unused_name(docs, "redacted_id"), unused_name(docs, "redacted_spans")
    joined = docs.join(
        spans.select(F.col("doc_id").alias(key), F.col("spans").alias(own)), F.col(f"`{id_col}`").eqNullSafe(F.col(key)), "left"
    )

    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, places in batches:
            out = []
            for text, spans in zip(texts, places):
                for span in reversed(spans if spans is not None else []):
                    text = text[: span["start"]] + b"[secret]" + text[span["stop"] :]
                out.append(None if text is None else text.decode(errors="replace"))
            yield pd.Series(out, dtype=object)

    new = F.pandas_udf(cut, "string")(F.when(F.col(own).isNotNull(), utf8(text_col)), F.col(own))
    text = F.when(F.col(own).isNotNull(), new).otherwise(F.col(f"`{text_col}`")).alias(text_col)
    return joined.select(*[text if c == text_col else F.col(f"`{c}`") for c in docs.columns])
