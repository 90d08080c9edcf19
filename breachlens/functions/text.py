"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from breachlens.schema import ACRONYMS, MISSING_CELLS, UNKNOWN_CATEGORY

_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}"
_UNICODE_SPACES = r"(?U)[\s\x1c-\x1f]+"


def missing_cell_to_null(cell: Column) -> Column:
    """Null for a cell whose whole, unstripped text is one of the missing-value spellings."""
    return F.when(~cell.isin(MISSING_CELLS), cell)


def squeeze_spaces(text: Column) -> Column:
    """Trim, and turn each run of whitespace into one space."""
    return F.trim(F.regexp_replace(text, _UNICODE_SPACES, " "))


def title_case(text: Column) -> Column:
    """Capitalise each run of letters, so ``o'brien`` gives ``O'Brien`` and ``7days`` ``7Days``.

    ``initcap`` only breaks words at spaces. The text holds no double space here, so a double
    space is put before each letter run that follows another sign and taken out again afterwards.
    """
    letter_run = rf"(?<=[^ {_CASED}])(?=[{_CASED}])"
    return F.replace(F.initcap(F.regexp_replace(text, letter_run, "  ")), F.lit("  "), F.lit(""))


def normalize_category(value: Column) -> Column:
    """Category text in its standard spelling; null and blank become ``Unknown``."""
    text = title_case(squeeze_spaces(value.cast("string")))
    for plain, spelled in ACRONYMS:
        text = F.replace(text, F.lit(plain), F.lit(spelled))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(UNKNOWN_CATEGORY))
