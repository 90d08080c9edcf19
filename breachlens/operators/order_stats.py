"""Exact order statistics of many columns without a global sort.

``percentile`` keeps every distinct value in one task, so it cannot be used on columns whose
number of distinct values grows with the table. Here each pass groups the values into ordered
buckets, keeps (count, min, max) per bucket, and goes on inside the few buckets that hold a
wanted rank, until such a bucket holds a single value. What is grouped, sorted or collected is
bounded by the number of buckets, never by the number of rows.

The first pass uses logarithmic buckets (as in relative-error quantile sketches), the next
passes cut each open bucket into equal widths. Each later pass shrinks a bucket 65,536-fold and
a double has 52 bits of fraction, so no column needs more than five passes; money and counts
need two.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOG_STEPS = 1024.0  # buckets per factor e: at most 1.5 million over the whole double range
_LINEAR_STEPS = 65536.0

@dataclass(frozen=True)
class OrderStatistic:
    """The value at a rank, with the number of rows below it and equal to it."""

    value: float
    below: int
    equal: int


def unpivot(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """(name, value, rows) of all present values, one row each."""
    doubles = df.select(*[value.alias(name) for name, value in values.items()])
    long = doubles.unpivot([], list(values), "name", "value")
    return long.where(F.col("value").isNotNull() & ~F.isnan("value")).select(
        "name", (F.col("value") + F.lit(0.0)).alias("value"), F.lit(1).cast("long").alias("rows")
    )


def summary() -> list[Column]:
    """What is kept of a bucket. Summaries of parts of a table add up to that of the whole."""
    return [F.sum("rows").alias("rows"), F.min("value").alias("low_value"), F.max("value").alias("high_value")]


def log_bucket(value: Column) -> Column:
    # the logarithm and each product are monotone, so a larger value never gets a smaller bucket
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * F.lit(_LOG_STEPS))


def _linear_bucket(value: Column, low: Column, high: Column) -> Column:
    # halves, because high - low of two huge values could overflow
    share = (value * 0.5 - low * 0.5) / (high * 0.5 - low * 0.5)
    return (
        F.when(value == low, F.lit(-1))
        .when(value == high, F.lit(int(_LINEAR_STEPS) + 1))
        .otherwise(F.floor(share * F.lit(_LINEAR_STEPS)))
    )


def _holding_ranks(buckets: DataFrame, wanted: dict[str, list[int]]) -> DataFrame:
    """One row per wanted rank: the bucket that holds it, and how many values lie below."""
    ranks = F.create_map(
        *[F.lit(x) for pair in wanted.items() for x in pair]
    )[F.col("name")]
    up_to = Window.partitionBy("name", "low").orderBy("bucket")
    below = F.col("offset") + F.sum("rows").over(up_to) - F.col("rows")
    inside = lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("rows"))
    return buckets.withColumn("below", below).withColumn("rank", F.explode(F.filter(ranks, inside)))


def order_statistics(
    df: DataFrame, ranks: dict[str, set[int]]
) -> dict[tuple[str, int], OrderStatistic]:
    """Exact values at zero-based ranks of numeric columns, missing values left out.

    ``ranks`` maps a column to its wanted ranks. Ranks outside the column are left out of the
    result. ``df`` is scanned once per pass, reading only the named columns, so pass a written
    layer and not a long chain of work.
    """
    return search(_Columns(df, [name for name, many in ranks.items() if many]), ranks)


class Values(Protocol):
    """Where values come from: rows of a table, or an index of them."""

    def buckets(self) -> DataFrame:
        """(name, bucket, rows, low_value, high_value) by ``log_bucket``."""

    def inside(self, spans: dict[str, set[tuple[float, float, int]]]) -> DataFrame:
        """(name, value, rows), at least of all values within the spans (low, high, values below) of each name."""


class _Columns:
    def __init__(self, df: DataFrame, names: list[str]):
        self.df, self.columns = df, {name: F.col(f"`{name}`").cast("double") for name in names}

    def buckets(self) -> DataFrame:
        return unpivot(self.df, self.columns).groupBy("name", log_bucket(F.col("value")).alias("bucket")).agg(*summary())

    def inside(self, spans: dict[str, set[tuple[float, float, int]]]) -> DataFrame:
        narrowed, anywhere = {}, F.lit(False)
        for name, many in spans.items():
            inside = F.lit(False)
            for low, high, _ in sorted(many):
                inside = inside | self.columns[name].between(F.lit(low), F.lit(high))
            narrowed[name] = F.when(inside, self.columns[name])
            anywhere = anywhere | inside
        # few rows are left here, so the unpivot of the later passes is nearly free
        return unpivot(self.df.where(anywhere), narrowed)


def search(values: Values, ranks: dict[str, set[int]]) -> dict[tuple[str, int], OrderStatistic]:
    """The statistics at the wanted ranks, from buckets and then from ever finer ones of the open spans."""
    found: dict[tuple[str, int], OrderStatistic] = {}
    wanted = {name: sorted(int(r) for r in many) for name, many in ranks.items() if many}
    if not wanted:
        return found
    buckets = values.buckets().withColumns({"low": F.lit(0.0), "offset": F.lit(0).cast("long")})
    while True:
        spans: dict[str, set[tuple[float, float, int]]] = {}
        still: dict[str, list[int]] = {}
        for row in _holding_ranks(buckets, wanted).collect():
            if row["low_value"] == row["high_value"]:
                found[row["name"], row["rank"]] = OrderStatistic(row["low_value"], row["below"], row["rows"])
            else:
                spans.setdefault(row["name"], set()).add((row["low_value"], row["high_value"], row["below"]))
                still.setdefault(row["name"], []).append(row["rank"])
        wanted = still
        if not wanted:
            return found
        buckets = _refined(values, spans)


def _refined(values: Values, spans: dict[str, set[tuple[float, float, int]]]) -> DataFrame:
    """Finer buckets inside the open spans: at most one span per wanted rank, none overlap."""
    placed = values.inside(spans)
    listed = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"), F.lit(low).alias("low"), F.lit(high).alias("high"),
                F.lit(below).cast("long").alias("offset"),
            )
            for name, many in spans.items()
            for low, high, below in sorted(many)
        ]
    )
    open_spans = placed.sparkSession.range(1).select(F.inline(listed))
    held = placed.join(F.broadcast(open_spans), ["name"]).where(F.col("value").between(F.col("low"), F.col("high")))
    bucket = _linear_bucket(F.col("value"), F.col("low"), F.col("high")).alias("bucket")
    return held.groupBy("name", "low", "offset", bucket).agg(*summary())


def quantile_ranks(rows: int, share: float) -> tuple[int, int, float]:
    """The ranks around a quantile, equal if it falls on one, and the weight of the upper one."""
    position = (rows - 1) * share
    lower = int(position)
    return lower, lower + (position > lower), position - lower


def blend(lower: float, upper: float, weight: float) -> float:
    """Linear interpolation, in the order of operations numpy uses."""
    if lower == upper:
        return lower
    if weight >= 0.5:
        return upper - (upper - lower) * (1 - weight)
    return lower + (upper - lower) * weight


def quantiles(
    df: DataFrame, columns: list[str], shares: list[float]
) -> dict[tuple[str, float], float | None]:
    """Exact, linearly interpolated quantiles; None for a column without values."""
    counts = df.agg(
        *[F.count(F.nullif(F.col(c).cast("double"), F.lit(float("nan")))).alias(c) for c in columns]
    ).first()
    ranks = {
        c: {r for share in shares for r in quantile_ranks(counts[c], share)[:2]}
        for c in columns
        if counts[c]
    }
    return interpolated(counts.asDict(), columns, shares, order_statistics(df, ranks))


def interpolated(
    counts: dict[str, int], columns: list[str], shares: list[float], stats: dict[tuple[str, int], OrderStatistic]
) -> dict[tuple[str, float], float | None]:
    out: dict[tuple[str, float], float | None] = {}
    for c in columns:
        for share in shares:
            if not counts[c]:
                out[c, share] = None
                continue
            lower, upper, weight = quantile_ranks(counts[c], share)
            out[c, share] = blend(stats[c, lower].value, stats[c, upper].value, weight)
    return out
