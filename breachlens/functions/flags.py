"""Yes/no expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachlens.functions.numbers import parse_number
from breachlens.schema import FALSE_WORDS, TRUE_WORDS


def parse_flag(value: Column, dtype: T.DataType) -> Column:
    """BOOLEAN, or NULL where the value is missing or is not an accepted yes/no spelling.

    Numbers equal to 1 or 0, such as ``1.00`` and ``0e0``, count also in text, because a text scan
    cannot tell a number column with gaps from a word column.
    """
    if isinstance(dtype, T.BooleanType):
        return value
    if isinstance(dtype, T.NumericType):
        return F.when(value == 1, True).when(value == 0, False)
    # the plain trim settles nearly all values; other white space is only looked for in the rest
    stripped = F.regexp_replace(value, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    number = parse_number(stripped, dtype)
    return F.coalesce(
        _flag_of(F.lower(F.trim(value))), _flag_of(F.lower(stripped)), F.when(number == 1, True).when(number == 0, False)
    )


def _flag_of(word: Column) -> Column:
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)
