"""Data-quality checks. They raise ``ValueError``; rows are never set aside or dropped.

Each stage is checked on the layer it has written. One aggregate with a handful of functions
counts the rows that break any rule; only if there are some, a second one counts per column and
rule to name the first broken one.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachlens.functions.numbers import is_infinite, is_missing
from breachlens.operators.sizing import NARROW_ROWS_PER_PARTITION, shuffle_sized_for
from breachlens.schema import (
    FLAG_COLUMNS,
    INCIDENT_COLUMNS,
    INCIDENT_DATE,
    INCIDENT_ID,
    NUMBER_COLUMNS,
    VALUE_RANGES,
)

log = logging.getLogger("breachlens")


# --- column names (no job) --------------------------------------------------
def check_header(names: Iterable[str]) -> None:
    """Reject blank and repeated column names, then missing required ones."""
    names = list(names)
    if any(not name.strip() for name in names):
        raise ValueError("A column name is blank.")
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"Column names are repeated: {repeated}")
    missing = sorted(set(INCIDENT_COLUMNS) - set(names))
    if missing:
        raise ValueError(f"Missing Columns: {missing}")


def check_required(names: Iterable[str], message: str) -> None:
    present = set(names)
    missing = [name for name in INCIDENT_COLUMNS if name not in present]
    if missing:
        raise ValueError(f"{message}: {missing}")


# --- aggregate expressions --------------------------------------------------
def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def measure(df: DataFrame, measures: dict[str, Column]) -> dict[str, Any]:
    """All measures in one scan."""
    return df.agg(*[c.alias(name) for name, c in measures.items()]).first().asDict()


def measure_written(df: DataFrame, measures: dict[str, Column], write: Callable[[DataFrame], Any]) -> dict[str, Any]:
    """Write ``df`` and measure the rows on their way, without a scan of their own; ``rows`` is their number.

    The measures belong to the last stage of the write, whose tasks count once each, even if one is run again.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in measures.items()]))
    return seen.get


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def incomplete(df: DataFrame) -> Column:
    """Whether a row has a missing or an infinite value in any column."""
    broken = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            # false for NaN and infinities, null for NULL
            broken.append(~F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False)))
        else:
            broken.append(value.isNull())
    return any_of(broken)


def row_measures(df: DataFrame) -> dict[str, Column]:
    """Rows, and per column the missing and the infinite values."""
    measures = {"rows": F.count(F.lit(1))}
    for field in df.schema.fields:
        measures[f"missing:{field.name}"] = F.count_if(is_missing(F.col(f"`{field.name}`"), field.dataType))
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            measures[f"infinite:{field.name}"] = count_if(is_infinite(F.col(f"`{field.name}`")))
    return measures


def outside_range(name: str) -> Column:
    """Whether the value lies outside the inclusive range of its column."""
    lower, upper = VALUE_RANGES[name]
    outside = F.lit(False)
    if lower is not None:
        outside = outside | (F.col(name) < lower)
    if upper is not None:
        outside = outside | (F.col(name) > upper)
    return outside


def range_measures() -> dict[str, Column]:
    return {f"outside:{name}": count_if(outside_range(name)) for name in VALUE_RANGES}


def flag_measures(df: DataFrame) -> dict[str, Column]:
    """Per flag column the values that are neither 0 nor 1."""
    return {
        f"unflag:{name}": F.lit(0).cast("long")
        if isinstance(df.schema[name].dataType, T.BooleanType)
        else count_if(~F.col(name).isin(0, 1))
        for name in FLAG_COLUMNS
    }


def missing_columns(measured: dict[str, Any]) -> dict[str, int]:
    """Column -> missing values, only columns that have some."""
    return {
        name.split(":", 1)[1]: n for name, n in measured.items() if name.startswith("missing:") and n
    }


def infinite_columns(measured: dict[str, Any]) -> list[str]:
    return [name.split(":", 1)[1] for name, n in measured.items() if name.startswith("infinite:") and n]


def duplicate_count(df: DataFrame, rows: int, key: str = INCIDENT_ID) -> int:
    """Rows beyond the first of each key, null as one key. Shuffles the key column only.

    ``rows`` is the size of ``df``, known from an earlier check, and sets the shuffle width.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    extra = per_key.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("n"))
    with shuffle_sized_for(df.sparkSession, rows, NARROW_ROWS_PER_PARTITION):
        return extra.first()["n"]


# --- raising ----------------------------------------------------------------
def check_loaded(rows: int, missing_ids: int) -> None:
    if rows == 0:
        raise ValueError("The source has no rows.")
    if missing_ids:
        raise ValueError(f"Some rows have no {INCIDENT_ID}.")


def warn_duplicates(duplicates: int) -> None:
    if duplicates:
        log.warning("%d duplicate incident IDs found; cleaning keeps the first of each.", duplicates)


def clean_measures(clean: DataFrame) -> dict[str, Column]:
    broken = incomplete(clean) | any_of(outside_range(name) for name in VALUE_RANGES)
    return {"broken": count_if(broken), "latest": F.max(INCIDENT_DATE)}


def check_cleaned(clean: DataFrame, found: dict[str, Any] | None = None) -> dict[str, Any]:
    """Final check of the written clean layer; returns its row count and latest date.

    ``found`` has the ``clean_measures`` and ``rows`` if they were taken while it was written.
    """
    found = found or measure(clean, {"rows": F.count(F.lit(1)), **clean_measures(clean)})
    if not found["rows"]:
        raise ValueError("Cleaning left no rows.")
    if not found["broken"]:
        return found
    details = measure(clean, {**row_measures(clean), **range_measures()})
    missing = missing_columns(details)
    if INCIDENT_ID in missing:
        raise ValueError(f"Some rows have no {INCIDENT_ID}.")
    if missing:
        raise ValueError(f"Cleaning left gaps: {missing}")
    if infinite_columns(details):
        raise ValueError(f"Cleaning left infinite values in {infinite_columns(details)}")
    name = next(name for name in VALUE_RANGES if details[f"outside:{name}"])
    raise ValueError(
        f"Cleaning left {details[f'outside:{name}']} values of {name} out of range"
    )


def complete_measures(df: DataFrame) -> dict[str, Column]:
    flags = [c for c in FLAG_COLUMNS if c in df.columns and df.schema[c].dataType != T.BooleanType()]
    no_flag = any_of(~F.coalesce(F.col(c).isin(0, 1), F.lit(True)) for c in flags)
    return {"broken": count_if(incomplete(df)), "no_flag": count_if(no_flag)}


def check_complete(df: DataFrame, label: str, expected_rows: int | None = None) -> int:
    """A written engineered layer: the expected rows, nothing missing or infinite, flags 0 or 1.

    Returns the row count. One scan if all is well.
    """
    return check_measured(measure(df, {"rows": F.count(F.lit(1)), **complete_measures(df)}), df, label, expected_rows)


def check_measured(found: dict[str, Any], df: DataFrame, label: str, expected_rows: int | None = None) -> int:
    """The same from ``rows`` and ``complete_measures``; ``df`` is read only to name what is wrong."""
    if not found["rows"]:
        raise ValueError(f"{label} has no rows.")
    if expected_rows is not None and found["rows"] != expected_rows:
        raise ValueError(f"{label} has {found['rows']} rows instead of {expected_rows}.")
    if found["broken"]:
        details = measure(df, row_measures(df))
        missing = missing_columns(details)
        if INCIDENT_ID in missing:
            raise ValueError(f"{label} has rows without {INCIDENT_ID}.")
        if missing:
            raise ValueError(f"{label} has gaps in {sorted(missing)}")
        raise ValueError(f"{label} has invalid numeric values in {infinite_columns(details)}")
    if found["no_flag"]:
        details = measure(df, flag_measures(df))
        name = next(name for name in FLAG_COLUMNS if details[f"unflag:{name}"])
        raise ValueError(f"{label} has flags other than 0 and 1 in {name}.")
    return found["rows"]


def check_feature_input(raw: DataFrame, typed: DataFrame) -> dict[str, Any]:
    """Input of the feature stage: ``raw`` as given, ``typed`` with unreadable values as NULL."""
    watched = [INCIDENT_ID, INCIDENT_DATE, *NUMBER_COLUMNS, *FLAG_COLUMNS]
    found = measure(
        typed,
        {
            "rows": F.count(F.lit(1)),
            "broken": count_if(incomplete(typed.select(*watched))),
            "latest": F.max(INCIDENT_DATE),
        },
    )
    if not found["rows"]:
        raise ValueError("The feature input has no rows.")
    details = measure(typed, row_measures(typed.select(*watched))) if found["broken"] else {}
    if details and details[f"missing:{INCIDENT_ID}"]:
        raise ValueError(f"Some rows have no {INCIDENT_ID}.")
    if duplicate_count(raw, found["rows"]):
        raise ValueError(f"Some {INCIDENT_ID} values are repeated.")
    if not details:
        return found
    if details[f"missing:{INCIDENT_DATE}"]:
        raise ValueError("Some rows have an invalid incident_date or none.")
    for name in NUMBER_COLUMNS:
        if details[f"missing:{name}"] or details[f"infinite:{name}"]:
            raise ValueError(f"{name} has invalid numeric values.")
    given = measure(raw, row_measures(raw.select(*FLAG_COLUMNS)))
    name = next(name for name in FLAG_COLUMNS if details[f"missing:{name}"])
    what = "missing" if given[f"missing:{name}"] else "invalid"
    raise ValueError(f"{name} has {what} yes/no values.")
