"""Which expression reads which column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachlens.functions.dates import parse_day
from breachlens.functions.flags import parse_flag
from breachlens.functions.numbers import is_missing, parse_number
from breachlens.schema import FLAG_COLUMNS, INCIDENT_DATE, NUMBER_COLUMNS

# columns whose values can be unreadable, in the order in which that is reported
PARSED_COLUMNS = [*NUMBER_COLUMNS, *FLAG_COLUMNS, INCIDENT_DATE]


def parsed(name: str, dtype: T.DataType) -> Column:
    """The column in its clean type, NULL where it is missing or unreadable."""
    if name == INCIDENT_DATE:
        return parse_day(F.col(name), dtype)
    parse = parse_number if name in NUMBER_COLUMNS else parse_flag
    return parse(F.col(name), dtype)


def unreadable(name: str, dtype: T.DataType) -> Column:
    """Whether the value is present but cannot be read as the column's type."""
    return ~is_missing(F.col(name), dtype) & parsed(name, dtype).isNull()
