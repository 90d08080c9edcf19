"""Quality rules as a ledger of failure bits.

Every text is measured once and every rule is evaluated once per text. The ledger row keeps the
measurements and one bit per failed rule, so a policy (a versioned set of rules) is applied, and
its ablations are counted, by bit operations on the ledger without reading a text again.

Null and empty texts measure zero everywhere. Rows are independent of each other: repeated ids and
repeated texts give repeated rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from breachlens.llm.common import WHITE_SPACE, unused_name, utf8

SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_NOT_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC0))
_CONTINUED = bytes(range(0x80, 0xC0))

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_text_lines bigint, n_letters bigint, n_upper bigint"
)
MEASURE_NAMES = [part.split()[0] for part in MEASURES.split(", ")]


@dataclass(frozen=True)
class Rule:
    """A text fails the rule if ``fails``, an SQL condition on the measurements, holds."""

    bit: int
    name: str
    fails: str


#: Bits are never reused: a changed rule takes a new bit, so that old ledgers stay readable.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "many_symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "n_text_lines >= 4 AND 2 * n_dup_lines > n_text_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 25 * n_words"),
    Rule(6, "few_letters", "2 * n_letters < word_chars"),
    Rule(7, "capitals", "n_letters > 0 AND 10 * n_upper > 7 * n_letters"),
)

#: Policy version to rule names.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(rule.name for rule in RULES),
}


def mask_of(policy: str) -> int:
    names = POLICIES[policy]
    return sum(1 << rule.bit for rule in RULES if rule.name in names)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = {window for window, n in Counter(windows).items() if n > 1}
    found, end = 0, 0
    for at, window in enumerate(windows):
        if window in often:
            found += at + 3 - max(at, end)
            end = at + 3
    return found


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURE_NAMES)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(WHITE_SPACE)]
    return (
        len(words),
        len(text.translate(None, WHITE_SPACE + _CONTINUED)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(text.translate(None, _NOT_LETTERS)),
        len(text) - len(text.translate(None, _UPPER)),
    )


def _measure_batches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure(text) for text in batch], columns=MEASURE_NAMES)


def _measures(text: Column) -> Column:
    return F.pandas_udf(_measure_batches, MEASURES)(text)


def failure_bits(prefix: str = "") -> Column:
    """One bit for each rule that the measurements fail."""
    bits = F.lit(0).cast("bigint")
    for rule in RULES:
        condition = rule.fails
        for name in MEASURE_NAMES if prefix else ():
            condition = condition.replace(name, f"{prefix}.{name}")
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << rule.bit)).otherwise(0).cast("bigint"))
    return bits


def quality_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the measurements and ``failed``, the bits of failed rules."""
    measured = docs.select(F.col(f"`{id_col}`").alias("doc_id"), _measures(utf8(text_col)).alias("m"))
    return measured.select("doc_id", "m.*").withColumn("failed", failure_bits())


def passes(failed: str | Column, policy: str) -> Column:
    """Whether a ledger row passes the policy."""
    bits = F.col(failed) if isinstance(failed, str) else failed
    return bits.bitwiseAND(F.lit(mask_of(policy)).cast("bigint")) == 0


def ablations(ledger: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does: documents it rejects, and those that it alone rejects.

    The ledger is first counted per bit pattern, so what is shuffled is bounded by the patterns,
    not by the documents. ``kept_without`` is what the policy would keep if the rule were dropped.
    """
    mask = F.lit(mask_of(policy)).cast("bigint")
    patterns = ledger.groupBy(F.col("failed").bitwiseAND(mask).alias("failed")).agg(F.count(F.lit(1)).alias("docs"))
    rules = F.array(
        *[
            F.struct(F.lit(rule.name).alias("rule"), F.lit(1 << rule.bit).cast("bigint").alias("bit"))
            for rule in RULES
            if rule.name in POLICIES[policy]
        ]
    )
    spread = patterns.select("failed", "docs", F.inline(rules))
    rejected = F.col("failed").bitwiseAND(F.col("bit")) != 0
    alone = F.col("failed") == F.col("bit")
    return spread.groupBy("rule").agg(
        F.sum(F.when(rejected, F.col("docs")).otherwise(0)).alias("rejected"),
        F.sum(F.when(alone, F.col("docs")).otherwise(0)).alias("rejected_alone"),
        F.sum(F.when(alone | (F.col("failed") == 0), F.col("docs")).otherwise(0)).alias("kept_without"),
    )


def keep_quality(docs: DataFrame, policy: str = "v1", text_col: str = "text") -> DataFrame:
    """The documents that pass the policy, with all their columns; no shuffle."""
    m = unused_name(docs, "measures")
    return docs.withColumn(m, _measures(utf8(text_col))).where(passes(failure_bits(m), policy)).drop(m)
