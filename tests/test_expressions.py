"""Column expressions against hand-set values and against plain Python."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachlens.functions import (
    bounded,
    missing_cell_to_null,
    normalize_category,
    parse_day,
    parse_flag,
    parse_number,
    round_half_even,
    safe_ratio,
)
from breachlens.schema import MISSING_CELLS


def apply(spark, values, expression, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.out for r in rows.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_category_spelling(spark):
    cases = {
        "dDOS wave": "DDoS Wave", "rest API abuse": "Rest API Abuse", "dns tunnel": "DNS Tunnel", "iot worm": "IoT Worm",
        "mfa fatigue": "MFA Fatigue", "blind SQL": "Blind SQL", "stolen ssh key": "Stolen SSH Key", "rdp": "RDP",
        "\u00a0 public   sector\t": "Public Sector", None: "Unknown", "": "Unknown", " \r\n ": "Unknown", " null ": "Null",
        "https": "HTTPs", "apiary": "APIary", "d'arcy": "D'Arcy", "3rd party": "3Rd Party", "nation-state": "Nation-State",
        "arm_v8": "Arm_V8", "über": "Über", "dosage": "DoSage", "ipx": "IPx", "a-1b": "A-1B",
    }
    assert apply(spark, list(cases), normalize_category) == list(cases.values())


def test_all_white_space_counts(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [f"{s}a{s}{s}b{s}" for s in spaces]
    assert apply(spark, texts, normalize_category) == ["A B"] * len(texts)
    yes = [f"{s}yes{s}" for s in spaces]
    assert apply(spark, yes, lambda c: parse_flag(c, T.StringType())) == [True] * len(yes)


def test_category_spelling_is_idempotent(spark):
    values = ["apip", "https api", "a-b'c", "ip iot DOS ddos", "  x  "]
    once = apply(spark, values, normalize_category)
    assert apply(spark, once, normalize_category) == once


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="abzAZ019 -_'./éÉñß日本\t\n  ", max_size=12), min_size=150, max_size=200))
def test_title_case_equals_python(spark, texts):
    from breachlens.functions.text import squeeze_spaces, title_case

    expected = [" ".join(t.split()).title() for t in texts]
    assert apply(spark, texts, lambda c: title_case(squeeze_spaces(c))) == expected


def test_missing_cells(spark):
    assert apply(spark, MISSING_CELLS, missing_cell_to_null) == [None] * len(MISSING_CELLS)
    kept = [" NA ", "none", "0", "Nan", "-"]
    assert apply(spark, kept, missing_cell_to_null) == kept


def test_numbers_from_text(spark):
    good = {"1": 1.0, " 2.5 ": 2.5, "-3": -3.0, "+4": 4.0, ".5": 0.5, "6.": 6.0, "1e3": 1000.0,
            "inf": math.inf, "-Infinity": -math.inf, "-0.0": 0.0}
    parse = lambda c: parse_number(c, T.StringType())
    assert apply(spark, list(good), parse) == list(good.values())
    bad = ["1d", "1.0f", "1,000", "abc", "", " ", "nan", "1 2", "0x1F", "1e", "--1", None]
    assert apply(spark, bad, parse) == [None] * len(bad)


def test_nan_is_missing(spark):
    assert apply(spark, [math.nan, 1.0, None], lambda c: parse_number(c, T.DoubleType()), "v double") == [None, 1.0, None]


def test_flags(spark):
    parse = lambda c: parse_flag(c, T.StringType())
    yes = ["true", "T", " Yes ", "y", "1", "TRUE", "1.0", "\tYES\n"]
    no = ["false", "F", "no", " N ", "0", "0.0"]
    assert apply(spark, yes, parse) == [True] * len(yes)
    assert apply(spark, no, parse) == [False] * len(no)
    assert apply(spark, ["maybe", "", "2", "truee", None], parse) == [None] * 5
    assert apply(spark, [1, 0, 2, None], lambda c: parse_flag(c, T.IntegerType()), "v int") == [True, False, None, None]


def test_days(spark):
    parse = lambda c: parse_day(c, T.StringType()).cast("string")
    assert apply(spark, ["2025-12-05", "2025-1-5", "2024-02-29"], parse) == ["2025-12-05", "2025-01-05", "2024-02-29"]
    bad = ["2025-12", "2025-12-05T00:00:00", "2025-02-30", "not-a-date", "05-12-2025", "2025/12/05", "2025-13-01", "", "2025-01-05\n", None]
    assert apply(spark, bad, parse) == [None] * len(bad)


def test_bounded_keeps_null(spark):
    assert apply(spark, [-1.0, 5.0, 800.0, None, math.inf], lambda c: bounded(c, 0.0, 720.0), "v double") == [
        0.0, 5.0, 720.0, None, 720.0]


def test_ratio_and_rounding(spark):
    rows = spark.createDataFrame(
        [(0, 1.0, 0.0), (1, 1.0, 8.0), (2, 1e308, 1e-10), (3, 0.0, 0.0), (4, 3.0, 8.0)], "i int, a double, b double"
    )
    out = rows.select("i", safe_ratio(F.col("a"), F.col("b")).alias("r")).orderBy("i").collect()
    assert [r.r for r in out] == [0.0, 0.125, 0.0, 0.0, 0.375]
    values = [0.125, 0.375, 2.675, 1.005, -0.125, 2.5]
    assert apply(spark, values, lambda c: round_half_even(c, 2), "v double") == [0.12, 0.38, 2.68, 1.0, -0.12, 2.5]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_rounding_equals_numpy(spark, n):
    import numpy as np

    rng = np.random.default_rng(n)
    values = [float(v) for v in np.concatenate([rng.normal(0, 1000, 500), rng.integers(0, 5000, 500) / 8])]
    assert apply(spark, values, lambda c: round_half_even(c, n), "v double") == [float(v) for v in np.round(values, n)]
