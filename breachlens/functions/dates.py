"""Date expressions."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_day(value: Column, dtype: T.DataType) -> Column:
    """DATE, or NULL where the value is missing or is not year-month-day.

    Month and day may have one digit; a bare date cast would also take ``2025-12`` and
    timestamps in text, so the shape is checked first.
    """
    if isinstance(dtype, T.DateType):
        return value
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return value.cast("date")
    return F.when(value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), value.try_cast("date"))


def reference_day(value: str | datetime.date) -> datetime.date:
    """A reference date given as a date or as year-month-day text; other text raises."""
    if isinstance(value, datetime.datetime):
        return value.date()
    if isinstance(value, datetime.date):
        return value
    parts = re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", str(value).strip())
    try:
        return datetime.date(*map(int, parts.groups()))
    except (AttributeError, ValueError) as error:
        raise ValueError(f"The reference date must be a day as YYYY-MM-DD, not {value!r}.") from error
