"""Column expressions. All of them are built-in functions, so they stay inside codegen."""

from breachlens.functions.dates import parse_day, reference_day
from breachlens.functions.flags import parse_flag
from breachlens.functions.numbers import (
    bounded,
    nan_to_null,
    parse_number,
    round_half_even,
    safe_ratio,
)
from breachlens.functions.roles import PARSED_COLUMNS, parsed, unreadable
from breachlens.functions.text import missing_cell_to_null, normalize_category

__all__ = [
    "PARSED_COLUMNS",
    "bounded",
    "missing_cell_to_null",
    "nan_to_null",
    "normalize_category",
    "parse_day",
    "parse_flag",
    "parse_number",
    "parsed",
    "reference_day",
    "round_half_even",
    "safe_ratio",
    "unreadable",
]
