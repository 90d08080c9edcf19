"""Numeric expressions. Missing is NULL everywhere; NaN is folded to NULL on entry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's own cast also takes Java suffixes such as 1d or 1.0f, so the text is checked first
_NUMBER_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def nan_to_null(number: Column) -> Column:
    # adding 0.0 turns -0.0 into 0.0, so that equal numbers are also equal as group keys
    return F.when(~F.isnan(number), number + F.lit(0.0))


def parse_number(value: Column, dtype: T.DataType) -> Column:
    """DOUBLE, or NULL where the value is missing or is no number."""
    if isinstance(dtype, T.StringType):
        # no such text is NaN, and each mention of the cast would be evaluated: only -0.0 is left to turn into 0.0
        return F.when(value.rlike(_NUMBER_TEXT), value.try_cast("double")) + F.lit(0.0)
    return nan_to_null(value.cast("double"))


def is_missing(value: Column, dtype: T.DataType) -> Column:
    """Missing in the pandas sense: NULL or, for floating point, NaN."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def is_infinite(number: Column) -> Column:
    return F.abs(number) == F.lit(float("inf"))


def bounded(number: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """The number pulled into [lower, upper]. NULL stays NULL, unlike with least/greatest."""
    out = number
    if lower is not None:
        out = F.when(out < F.lit(lower), F.lit(lower)).otherwise(out)
    if upper is not None:
        out = F.when(out > F.lit(upper), F.lit(upper)).otherwise(out)
    return out


def round_half_even(number: Column, digits: int) -> Column:
    """Round the scaled double half to even, as numpy does; SQL ``round`` goes half up."""
    scale = F.lit(float(10**digits))
    return F.rint(number * scale) / scale


def safe_ratio(top: Column, bottom: Column) -> Column:
    """top / bottom; 0.0 where the bottom is zero or the quotient is not finite."""
    ratio = top / F.nullif(bottom, F.lit(0.0))
    return F.when(F.abs(ratio) < F.lit(float("inf")), ratio).otherwise(F.lit(0.0))
