"""Raw incidents -> clean incidents.

Cleaning needs global numbers twice: the medians that fill gaps, and the quartiles of the filled
and range-limited values that set the outlier fences. Both, and the medians the flag features
need later, are read from exact order statistics of the *unfilled* columns, because filling only
adds copies of one value and limiting is monotone. So one de-duplicated layer is written, its
seven number columns are scanned for the statistics, and the clean layer is then a projection of
that layer with constants in it.

Category text is normalised once per distinct spelling and looked up per row: the regular
expressions would cost more than all other work on the rows together.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachlens.functions import PARSED_COLUMNS, bounded, normalize_category, parsed, unreadable
from breachlens.operators import bounded_columns, category_counts, keep_first, look_up, order_statistics
from breachlens.operators.checks import (
    any_of,
    check_cleaned,
    check_header,
    check_required,
    clean_measures,
    count_if,
    measure,
    measure_written,
)
from breachlens.operators.order_stats import OrderStatistic, blend, quantile_ranks
from breachlens.operators.sizing import (
    NARROW_ROWS_PER_PARTITION,
    buckets_for,
    compiled,
    in_buckets,
    shuffle_sized_for,
)
from breachlens.schema import (
    CATEGORY_COLUMNS,
    EMPTY_COLUMN_NUMBER,
    FENCE_FACTOR,
    FENCED_COLUMNS,
    FLAG_COLUMNS,
    INCIDENT_COLUMNS,
    INCIDENT_DATE,
    INCIDENT_ID,
    MISSING_FLAG,
    NUMBER_COLUMNS,
    VALUE_RANGES,
)
from breachlens.sources.csv_files import SOURCE_ORDER, land_cells, land_values, read_header
from breachlens.sources.layers import write_buckets, write_layer
from breachlens.sources.workspace import new_folder

_SHARES = (0.25, 0.5, 0.75)


@dataclass(frozen=True)
class NumberStatistics:
    """What cleaning and the features need to know about one number column."""

    fill: float
    fences: tuple[float, float] | None
    clean_median: float


@dataclass
class Cleaned:
    """The clean layer, the cleaning report, and what was measured and written on the way."""

    df: DataFrame
    report: dict[str, Any]
    statistics: dict[str, NumberStatistics]
    measured: dict[str, Any]
    typed: DataFrame
    spellings: DataFrame
    #: of the typed and the clean layer, by incident id; a table with as many takes their rows without a shuffle
    buckets: int | None = None


# --- row-local part -----------------------------------------------------------
def typed_columns(df: DataFrame) -> list[Column]:
    """Every column in its clean type; values that are missing or unreadable become NULL.

    Gaps are still open here and category text is still as it came.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in df.columns:
        value = F.col(f"`{name}`")
        if name == INCIDENT_ID or name in CATEGORY_COLUMNS:
            value = value.cast("string")
        elif name in PARSED_COLUMNS:
            value = parsed(name, types[name])
        out.append(value.alias(name))
    return out


def values_of_cells() -> dict[str, Column]:
    """How the cells of a CSV file are read, by column; the others are text."""
    return {name: parsed(name, T.StringType()) for name in PARSED_COLUMNS}


def _settled(name: str, dtype: T.DataType) -> bool:
    """Whether any value of this type can be read as one of the column."""
    clean = T.DateType if name == INCIDENT_DATE else T.DoubleType if name in NUMBER_COLUMNS else T.BooleanType
    return isinstance(dtype, clean)


def unreadable_columns(df: DataFrame) -> list[str]:
    """The checked columns of ``df`` that hold a value which is present but cannot be read as its type; one scan of
    those that have another type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    measures = {name: F.bool_or(unreadable(name, types[name])) for name in PARSED_COLUMNS if not _settled(name, types[name])}
    if not measures:
        return []
    with compiled(df.sparkSession):
        found = measure(df, measures)
    return [name for name in measures if found[name]]


def check_readable(first: DataFrame, order_by: list[str]) -> None:
    """Raise for unreadable numbers, flags and dates, in this order. ``first`` may lack columns that are known to be readable."""
    types = {f.name: f.dataType for f in first.schema.fields}
    bad = {name: unreadable(name, types[name]) for name in PARSED_COLUMNS if name in types}
    # the rows that break a rule, moved and kept once for their numbers and their examples
    first = write_layer(first.where(any_of(bad.values())), new_folder(first.sparkSession, "unreadable"))
    counts = measure(first, {name: F.count_if(condition) for name, condition in bad.items()})
    name = next((name for name in bad if counts[name]), None)
    if name is None:
        return

    def examples(limit: int) -> list[str]:
        text = F.col(name).cast("string").alias("text")
        return [r["text"] for r in first.where(bad[name]).orderBy(*order_by).select(text).limit(limit).collect()]

    if name in NUMBER_COLUMNS:
        raise ValueError(f"{name}: {counts[name]} invalid numeric values")
    if name in FLAG_COLUMNS:
        raise ValueError(
            f"{name}: {counts[name]} values are neither yes nor no, such as {examples(1)[0]!r}"
        )
    raise ValueError(
        f"{counts[name]} invalid {INCIDENT_DATE} values are not year-month-day, such as {examples(5)}"
    )


# --- global statistics --------------------------------------------------------
@dataclass(frozen=True)
class _FilledColumn:
    """A number column whose gaps hold ``fill``, known by some order statistics of its values."""

    rows: int
    gaps: int
    fill: float
    held: dict[int, OrderStatistic]

    def at(self, rank: int) -> float:
        """Value at a rank.

        Sorted, the column is: the values below the fill, the fill itself (own copies and gaps),
        the values above. So a rank is served from the front or, shifted by the gaps, from the back.
        """
        if rank < self.rows - self.gaps and self.held[rank].value < self.fill:
            return self.held[rank].value
        if rank >= self.gaps and self.held[rank - self.gaps].value > self.fill:
            return self.held[rank - self.gaps].value
        return self.fill

    def quantile(self, share: float, low: float, high: float) -> float:
        """Interpolated quantile of the values pulled into [low, high], which keeps their order."""
        first, second, weight = quantile_ranks(self.rows, share)
        return blend(*[min(max(self.at(rank), low), high) for rank in (first, second)], weight)


def _median(at: Callable[[int], float], rows: int) -> float:
    low, high, _ = quantile_ranks(rows, 0.5)
    return at(low) if low == high else (at(low) + at(high)) / 2


def _wanted_ranks(rows: int, gaps: int) -> set[int]:
    present = rows - gaps
    ranks = set(quantile_ranks(present, 0.5)[:2])
    for share in _SHARES:
        for rank in quantile_ranks(rows, share)[:2]:
            ranks |= {r for r in (rank, rank - gaps) if 0 <= r < present}
    return ranks


def _column_statistics(
    name: str, rows: int, gaps: int, held: dict[int, OrderStatistic]
) -> NumberStatistics:
    present = rows - gaps
    fill = _median(lambda rank: held[rank].value, present) if present else EMPTY_COLUMN_NUMBER
    column = _FilledColumn(rows, gaps, fill, held)
    lower, upper = VALUE_RANGES[name]
    low = -math.inf if lower is None else lower
    high = math.inf if upper is None else upper
    fences = None
    if name in FENCED_COLUMNS:
        fences = outlier_fences(column.quantile(0.25, low, high), column.quantile(0.75, low, high))
    if fences is not None:
        low, high = max(low, fences[0]), min(high, fences[1])
    return NumberStatistics(fill, fences, _median(lambda rank: min(max(column.at(rank), low), high), rows))


def number_statistics(typed: DataFrame, missing: dict[str, int], rows: int) -> dict[str, NumberStatistics]:
    """Fill value, outlier fences and clean median of every number column, all exact.

    ``missing`` counts the gaps per column in ``typed``. Two scans of the seven columns.
    """
    if not rows:
        return {name: NumberStatistics(EMPTY_COLUMN_NUMBER, None, EMPTY_COLUMN_NUMBER) for name in NUMBER_COLUMNS}
    wanted = {name: _wanted_ranks(rows, missing[name]) for name in NUMBER_COLUMNS if missing[name] < rows}
    found = order_statistics(typed, wanted)
    return {
        name: _column_statistics(
            name, rows, missing[name], {rank: stat for (column, rank), stat in found.items() if column == name}
        )
        for name in NUMBER_COLUMNS
    }


def outlier_fences(q1: float, q3: float) -> tuple[float, float] | None:
    """The 1.5 * IQR fences; None where the quartiles coincide or are not finite."""
    spread = q3 - q1
    if math.isnan(spread) or spread == 0:
        return None
    return q1 - FENCE_FACTOR * spread, q3 + FENCE_FACTOR * spread


# --- composition --------------------------------------------------------------
def filled(name: str, stats: dict[str, NumberStatistics]) -> Column:
    return F.coalesce(F.col(name), F.lit(stats[name].fill))


def limited(name: str, stats: dict[str, NumberStatistics]) -> Column:
    return bounded(filled(name, stats), *VALUE_RANGES[name])


def fenced(name: str, stats: dict[str, NumberStatistics]) -> Column:
    fences = stats[name].fences
    return limited(name, stats) if fences is None else bounded(limited(name, stats), *fences)


def category_spellings(typed: DataFrame, folder: str) -> DataFrame:
    """(column, value, clean, rows): each distinct category text, its clean form, its row count."""
    counts = category_counts(typed, CATEGORY_COLUMNS)
    return write_layer(counts.withColumn("clean", normalize_category(F.col("value"))), folder)


def clean_columns(
    typed: DataFrame, stats: dict[str, NumberStatistics], spelled: set[str]
) -> list[Column]:
    """Projection of the typed layer onto clean values; the rows keep their number and place.

    Columns in ``spelled`` have their clean text in ``_clean_<name>``, looked up before.
    """
    out = []
    for name in typed.columns:
        value = F.col(f"`{name}`")
        if name in CATEGORY_COLUMNS:
            value = F.col(f"_clean_{name}") if name in spelled else normalize_category(value)
        elif name in NUMBER_COLUMNS:
            value = fenced(name, stats)
        elif name in FLAG_COLUMNS:
            value = F.coalesce(value, F.lit(MISSING_FLAG))
        out.append(value.alias(name))
    return out


def write_typed(
    raw: DataFrame, order_by: list[str], folder: str, buckets: int | None = None
) -> tuple[DataFrame, dict[str, Any]]:
    """Keep the first row per id, type the columns and write the layer the statistics read.

    Numbers and flags that are missing stay NULL. Raises if a value cannot be read: a scan of ``raw``, a landed layer,
    looks for such values, and the columns that have some are checked on the first rows before the others are moved, so
    the rows that are moved are known to be readable. They are typed before the shuffle, which then moves numbers instead of text. Returns the layer, in ``buckets`` by
    id, with its row count and the gaps per column.
    """
    spark = raw.sparkSession
    types = {f.name: f.dataType for f in raw.schema.fields}
    suspects = unreadable_columns(raw)
    if suspects:
        check_readable(keep_first(raw.select(*dict.fromkeys([INCIDENT_ID, *order_by, *suspects])), INCIDENT_ID, order_by), order_by)
    incidents = raw.drop(*[c for c in order_by if c not in INCIDENT_COLUMNS])
    places = {f"_order_{i}": F.col(f"`{c}`") for i, c in enumerate(order_by)}
    typed = raw.select(
        *typed_columns(incidents), F.col(INCIDENT_ID).alias("_raw_id"), *[place.alias(name) for name, place in places.items()],
    )
    # text ids are the same in both, so the layer's own ones say where a row lies
    key = INCIDENT_ID if isinstance(types[INCIDENT_ID], T.StringType) else "_raw_id"
    buckets = buckets or buckets_for(0)
    with in_buckets(spark, buckets):
        marked = keep_first(typed, key, list(places)).drop("_raw_id", *places)
        gaps = [*CATEGORY_COLUMNS, *NUMBER_COLUMNS, *FLAG_COLUMNS]
        measures = {f"missing:{c}": F.count_if(F.col(c).isNull()) for c in gaps}
        measured: dict[str, Any] = {}
        written = write_buckets(
            marked, folder, INCIDENT_ID, buckets, lambda write: measured.update(measure_written(marked, measures, write))
        )
    return written, measured


def write_clean(
    typed: DataFrame, stats: dict[str, NumberStatistics], spellings: DataFrame, folder: str, buckets: int | None = None
) -> tuple[DataFrame, dict[str, Any]]:
    """Spell, fill, limit and fence the typed layer, write it, and run the final checks on it."""
    spelled = bounded_columns(spellings)
    looked_up = typed
    for name in CATEGORY_COLUMNS:
        if name in spelled:
            looked_up = look_up(looked_up, spellings, name, "clean", f"_clean_{name}")
    columns = looked_up.select(*clean_columns(typed, stats, spelled))
    found: dict[str, Any] = {}
    with in_buckets(typed.sparkSession):
        clean = write_buckets(
            columns, folder, INCIDENT_ID, buckets or buckets_for(0),
            lambda write: found.update(measure_written(columns, clean_measures(columns), write)),
        )
    return clean, check_cleaned(clean, found)


def changed_values(typed: DataFrame, stats: dict[str, NumberStatistics]) -> dict[str, int]:
    """How many filled values the limits and then the fences changed, per column."""
    return measure(
        typed,
        {
            **{f"adjusted:{c}": count_if(filled(c, stats) != limited(c, stats)) for c in VALUE_RANGES},
            **{f"fenced:{c}": count_if(limited(c, stats) != fenced(c, stats)) for c in FENCED_COLUMNS},
        },
    )


def clean_incidents(
    raw: DataFrame,
    order_by: list[str],
    raw_rows: int | None = None,
    folder: str | None = None,
    clean_path: str | None = None,
    buckets: int | None = None,
) -> Cleaned:
    """Raw rows in, checked clean layer and cleaning report out.

    ``order_by`` names the columns that tell which of several rows with one id came first; they
    are dropped unless they belong to the incident columns. ``raw`` is read more than once unless
    ``raw_rows`` is given: hand in a landed layer.
    Working layers go to ``folder`` (default: a fresh one in the shared folder), the clean layer
    to ``clean_path`` (default: next to them). They lie in ``buckets`` by id (default: by the rows); a raw layer that
    does so too is not shuffled.
    """
    if not order_by:
        raise ValueError("order_by must name the columns that say which row of an id came first.")
    check_required(raw.columns, "Missing Columns")
    spark = raw.sparkSession
    folder = folder or new_folder(spark, "clean")
    if raw_rows is None:
        raw_rows = raw.count()
    buckets = buckets or buckets_for(raw_rows)
    typed, first_pass = write_typed(raw, order_by, f"{folder}/typed", buckets)
    rows = first_pass["rows"]
    gaps = {name: first_pass[f"missing:{name}"] for name in NUMBER_COLUMNS}
    stats = number_statistics(typed, gaps, rows)
    with shuffle_sized_for(spark, rows, NARROW_ROWS_PER_PARTITION):
        spellings = category_spellings(typed, f"{folder}/spellings")
    clean, measured = write_clean(typed, stats, spellings, clean_path or f"{folder}/clean", buckets)
    changed = changed_values(typed, stats)
    filled_roles = [*CATEGORY_COLUMNS, *NUMBER_COLUMNS, *FLAG_COLUMNS]
    fenced_counts = {c: changed[f"fenced:{c}"] for c in FENCED_COLUMNS if changed[f"fenced:{c}"]}
    report = {
        "initial_rows": raw_rows,
        "final_rows": measured["rows"],
        "duplicates_removed": raw_rows - rows,
        "missing_values_filled": sum(first_pass[f"missing:{c}"] for c in filled_roles),
        "outliers_capped": sum(fenced_counts.values()),
        "outliers_capped_by_column": fenced_counts,
        "range_adjustments_by_column": {
            c: changed[f"adjusted:{c}"] for c in VALUE_RANGES if changed[f"adjusted:{c}"]
        },
    }
    return Cleaned(clean, report, stats, measured, typed, spellings, buckets)


def read_clean_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """A clean layer that was exported as CSV, typed again and landed as Parquet.

    Read as strictly as a raw file: text that is not UTF-8, surplus fields and values that cannot be
    read as their column's type raise.
    """
    check_header(read_header(spark, path))
    folder = new_folder(spark, "clean-csv")
    typed, _ = land_values(spark, path, f"{folder}/typed", values_of_cells(), multi_line)
    if typed is None:
        cells, _ = land_cells(spark, path, f"{folder}/cells", multi_line)
        check_readable(cells, SOURCE_ORDER)
        raise ValueError("The clean file has values that cannot be read.")
    return typed.drop(*SOURCE_ORDER)
