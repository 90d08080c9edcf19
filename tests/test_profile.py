"""The profile against pandas on the same rows."""

import random

import numpy as np
import pandas as pd
import pytest
from conftest import SCHEMA
from pyspark.sql import functions as F

from breachlens.plans import profile
from breachlens.schema import CATEGORY_COLUMNS, INCIDENT_COLUMNS, NUMBER_COLUMNS


@pytest.fixture(scope="module")
def both(spark):
    pick = random.Random(11)
    rows = []
    for i in range(400):
        numbers = [round(pick.lognormvariate(4, 2), 1), pick.randrange(720), float(pick.choice([0, 0, pick.randrange(9999)])),
                   pick.randrange(90), pick.randrange(11), pick.randrange(1, 100), pick.randrange(5) * 250.5]
        rows.append((
            f"INC-{i:04d}", f"{pick.choice([2020, 2022])}-{pick.choice([1, 2, 7, 12]):02d}-{pick.randrange(1, 29):02d}",
            pick.choice("abc"), "one", f"type {pick.randrange(25)}", None if i % 7 == 0 else f"actor {pick.randrange(3)}",
            *[None if pick.random() < 0.05 else float(n) for n in numbers],
            *[pick.random() < 0.3 for _ in range(3)],
        ))
    names = [f.strip().split(" ")[0] for f in SCHEMA.split(",")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("incident_date", F.col("incident_date").cast("date"))
    return df.repartition(3), pd.DataFrame(rows, columns=names)


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("exact", [True, False])
def test_column_quality(both, exact):
    df, want = both
    got = rows(profile.column_quality(df, exact))
    assert [r["column"] for r in got][:1] == [want.isna().sum().idxmax()]
    assert [r["missing"] for r in got] == sorted((int(n) for n in want.isna().sum()), reverse=True)
    for r in got:
        column = want[r["column"]]
        assert r["missing"] == column.isna().sum()
        assert r["missing_pct"] == round(column.isna().mean() * 100, 2)
        if exact:
            assert r["unique"] == column.nunique(dropna=False)
        else:
            assert r["unique"] == pytest.approx(column.nunique(dropna=False), rel=0.15, abs=1)


def test_missing_report_and_summary(both):
    df, want = both
    assert {r["column"]: r["missing"] for r in rows(profile.missing_report(df))} == want.isna().sum().to_dict()
    summary = rows(profile.dataset_summary(df))
    assert [r["column"] for r in summary] == INCIDENT_COLUMNS
    assert {(r["rows"], r["columns"]) for r in summary} == {(400, 16)}


def test_describe(both):
    df, want = both
    described = want[NUMBER_COLUMNS].describe().T.round(2)
    for r in rows(profile.describe_numbers(df)):
        assert list(r.values())[1:] == pytest.approx(list(described.loc[r["column"]]), abs=0.0101)
        assert [r["p25"], r["p50"], r["p75"]] == list(described.loc[r["column"]][["25%", "50%", "75%"]])


def test_top_categories(both):
    df, want = both
    got = rows(profile.top_categories(df))
    for c in CATEGORY_COLUMNS:
        counts = want[c].value_counts(dropna=False)
        mine = [r for r in got if r["column"] == c]
        assert [r["count"] for r in mine] == list(counts.head(10))
        for r in mine:
            assert r["count"] == (want[c].isna().sum() if r["value"] is None else counts[r["value"]])


def test_monthly_fills_empty_months(both):
    df, want = both
    dates = pd.to_datetime(want["incident_date"])
    monthly = pd.Series(1, index=dates).resample("ME").size()
    got = rows(profile.monthly_incidents(df))
    assert [(str(r["month_end"]), r["incident_count"]) for r in got] == [
        (str(day.date()), n) for day, n in monthly.items()
    ]
    assert 0 in monthly.values


def test_histogram(both, spark):
    df, want = both
    counts, edges = np.histogram(want["severity_score"].dropna(), bins=10)
    got = rows(profile.severity_histogram(df))
    assert [r["incidents"] for r in got] == list(counts)
    assert [r["lower_edge"] for r in got] == pytest.approx(list(edges[:-1]))
    assert [r["upper_edge"] for r in got] == pytest.approx(list(edges[1:]))
    constant = spark.createDataFrame([(4.0,), (4.0,)], "severity_score double")
    counts, edges = np.histogram([4.0, 4.0], bins=10)
    got = rows(profile.severity_histogram(constant))
    assert [r["incidents"] for r in got] == list(counts)
    assert got[0]["lower_edge"] == 3.5 and got[-1]["upper_edge"] == 4.5


def test_totals_and_rates(both):
    df, want = both
    for r in rows(profile.money_totals(df)):
        assert r["total_usd"] == pytest.approx(want[r["column"]].sum())
    for r in rows(profile.flag_rates(df)):
        assert r["true_rate_percent"] == round(float(want[r["column"]].mean() * 100), 2)


def test_correlations(both):
    df, want = both
    matrix = want[NUMBER_COLUMNS].corr().round(2)
    got = rows(profile.correlations(df))
    assert len(got) == 49
    for r in got:
        assert r["r"] == pytest.approx(matrix.loc[r["column_a"], r["column_b"]], abs=0.0101)
    whole = df.na.drop()
    matrix = want.dropna()[NUMBER_COLUMNS].corr().round(2)
    for r in rows(profile.correlations(whole)):
        assert r["r"] == pytest.approx(matrix.loc[r["column_a"], r["column_b"]], abs=0.0101)
    constant = rows(profile.correlations(df.withColumn("severity_score", F.lit(5.0))))
    assert {r["r"] for r in constant if "severity_score" in (r["column_a"], r["column_b"])} == {None}


def test_profile_input_checks(both):
    df, _ = both
    profile.check_profile_input(df)
    with pytest.raises(ValueError, match="lacks columns"):
        profile.check_profile_input(df.drop("region"))
    with pytest.raises(ValueError, match="no rows"):
        profile.check_profile_input(df.limit(0))
    with pytest.raises(ValueError, match="repeated"):
        profile.check_profile_input(df.union(df))
    with pytest.raises(ValueError, match="invalid incident_date"):
        profile.check_profile_input(df.withColumn("incident_date", F.lit(None).cast("date")))


def test_whole_profile(both):
    df, _ = both
    parts = profile.incident_profile(df)
    assert len(parts) == 8 and all(part.count() > 0 for part in parts.values())


def test_nan_counts_as_missing(both):
    df, want = both
    holes = df.withColumn("severity_score", F.when(F.col("severity_score") > 6, F.lit(float("nan"))).otherwise(F.col("severity_score")))
    gaps = want["severity_score"].where(~(want["severity_score"] > 6))
    described = {r["column"]: r for r in rows(profile.describe_numbers(holes))}["severity_score"]
    assert described["count"] == gaps.count() and described["max"] == pytest.approx(gaps.max())
    assert described["mean"] == pytest.approx(gaps.mean(), abs=0.0051)
    assert sum(r["incidents"] for r in rows(profile.severity_histogram(holes))) == gaps.count()
    frame = want.assign(severity_score=gaps)[NUMBER_COLUMNS].corr().round(2)
    for r in rows(profile.correlations(holes)):
        assert r["r"] == pytest.approx(frame.loc[r["column_a"], r["column_b"]], abs=0.0101)
    quality = {r["column"]: r for r in rows(profile.column_quality(holes))}["severity_score"]
    assert quality["missing"] == gaps.isna().sum() and quality["unique"] == gaps.nunique() + 1


def test_tiny_numbers_do_not_divide_by_zero(both):
    df, _ = both
    tiny = df.withColumn("severity_score", F.col("severity_score") * 1e-200)
    assert len(rows(profile.correlations(tiny))) == 49
