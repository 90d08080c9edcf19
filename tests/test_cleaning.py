import json
import math

import pytest
from conftest import ROWS, SCHEMA, cleaned_of
from pyspark.sql import functions as F

from breachlens.plans.cleaning import clean_incidents, outlier_fences
from breachlens.schema import INCIDENT_COLUMNS, NUMBER_COLUMNS


def by_id(df):
    return {r["incident_id"]: r.asDict() for r in df.collect()}


def test_valid_rows_stay_as_they_are(make):
    done = cleaned_of(make())
    assert done.df.columns == INCIDENT_COLUMNS
    rows = by_id(done.df)
    for want in ROWS:
        got = list(rows[want[0]].values())
        assert str(got[1]) == want[1]
        assert [got[0], *got[2:]] == [want[0], *want[2:]]
    assert done.report == {
        "initial_rows": 3, "final_rows": 3, "duplicates_removed": 0, "missing_values_filled": 0,
        "outliers_capped": 0, "outliers_capped_by_column": {}, "range_adjustments_by_column": {},
    }


def test_first_duplicate_wins(spark, make):
    again = make([{"sector": "Transport"}]).where("incident_id = 'INC-001'")
    done = cleaned_of(make().union(again).coalesce(1))
    assert done.report["duplicates_removed"] == 1 and done.report["final_rows"] == 3
    assert by_id(done.df)["INC-001"]["sector"] == "Energy"


def test_gaps_limits_and_report(make):
    changes = [
        {"records_affected": None, "sector": None, "downtime_hours": 900, "data_exfiltration": None},
        {"records_affected": -5, "severity_score": 12, "sector": "  "},
        {"response_team_size": 0, "detection_time_hours": None, "threat_actor": "apt-7"},
    ]
    done = cleaned_of(make(changes))
    rows = by_id(done.df)
    # the median is taken before limits: median(-5, 200)
    assert rows["INC-001"]["records_affected"] == 97.5
    assert rows["INC-002"]["records_affected"] == 0.0
    assert rows["INC-001"]["sector"] == "Unknown" and rows["INC-002"]["sector"] == "Unknown"
    assert rows["INC-001"]["downtime_hours"] == 720.0
    assert rows["INC-002"]["severity_score"] == 10.0
    assert rows["INC-003"]["response_team_size"] == 1.0
    assert rows["INC-003"]["detection_time_hours"] == 7.5
    assert rows["INC-003"]["threat_actor"] == "APT-7"
    assert rows["INC-001"]["data_exfiltration"] is False
    assert done.report["missing_values_filled"] == 4  # a blank category is not missing
    assert done.report["range_adjustments_by_column"] == {
        "severity_score": 1, "downtime_hours": 1, "response_team_size": 1, "records_affected": 1,
    }


def test_column_without_values_becomes_zero_then_limited(make):
    done = cleaned_of(make([{"response_team_size": None, "ransom_demand_usd": None}] * 3))
    rows = done.df.collect()
    assert {r["response_team_size"] for r in rows} == {1.0}
    assert {r["ransom_demand_usd"] for r in rows} == {0.0}


def test_outliers_go_to_the_fences(make):
    values = [10, 11, 12, 13, 14, 15, 16, 1000, 12, 13]
    done = cleaned_of(make(n=10).drop("records_affected").withColumn(
        "records_affected", F.element_at(F.array(*[F.lit(float(v)) for v in values]),
                                         F.substring("incident_id", 5, 3).cast("int") + 1)
    ).select(*INCIDENT_COLUMNS))
    import numpy as np
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert done.statistics["records_affected"].fences == (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert done.df.agg(F.max("records_affected")).first()[0] == q3 + 1.5 * (q3 - q1)
    assert done.report["outliers_capped_by_column"]["records_affected"] == 1
    assert outlier_fences(5.0, 5.0) is None and outlier_fences(-math.inf, math.inf) is not None
    assert outlier_fences(math.inf, math.inf) is None


def test_equal_quartiles_leave_outliers(make):
    done = cleaned_of(make([{"records_affected": 7}, {"records_affected": 7}, {"records_affected": 7}]))
    assert done.statistics["records_affected"].fences is None


def pandas_clean(rows, columns):
    """The same work on a pandas frame, as the brute-force answer."""
    import pandas as pd
    from breachlens.schema import FENCED_COLUMNS, VALUE_RANGES

    df = pd.DataFrame(rows, columns=columns).drop_duplicates("incident_id", keep="first").copy()
    flag_medians = {}
    for c in NUMBER_COLUMNS:
        df[c] = df[c].astype(float)
        fill = df[c].median()
        df[c] = df[c].fillna(0.0 if pd.isna(fill) else fill).clip(*VALUE_RANGES[c])
        if c in FENCED_COLUMNS:
            q1, q3 = df[c].quantile(0.25), df[c].quantile(0.75)
            if q3 != q1:
                df[c] = df[c].clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        flag_medians[c] = df[c].median()
    return df.set_index("incident_id"), flag_medians


@pytest.mark.parametrize("seed", range(6))
def test_random_numbers_equal_pandas(spark, seed):
    import random

    pick = random.Random(seed)
    columns = [f.strip().split(" ")[0] for f in SCHEMA.split(",")]
    rows = []
    for i in range(pick.choice([1, 2, 7, 160, 161])):
        row = list(ROWS[i % 3])
        row[0] = f"INC-{pick.randrange(120)}"
        for j in range(6, 13):
            kind = pick.random()
            row[j] = None if kind < 0.25 else pick.choice([0.0, -4.0, 3.0, 55.5]) if kind < 0.6 else pick.gauss(60, 400)
        rows.append(tuple(row))
    want, medians = pandas_clean(rows, columns)
    done = cleaned_of(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    got = by_id(done.df)
    assert set(got) == set(want.index)
    for key, row in got.items():
        for c in NUMBER_COLUMNS:
            assert row[c] == pytest.approx(want.loc[key, c], rel=1e-12, abs=1e-12), (key, c)
    for c in NUMBER_COLUMNS:
        assert done.statistics[c].clean_median == pytest.approx(medians[c], rel=1e-12, abs=1e-12)


@pytest.mark.parametrize(
    "change, message",
    [
        ({"records_affected": "abc"}, "records_affected: 1 invalid numeric values"),
        ({"severity_score": "1d"}, "invalid numeric"),
        ({"ransom_demand_usd": "1,000"}, "invalid numeric"),
        ({"zero_day_used": "maybe"}, "zero_day_used: 1 values are neither yes nor no, such as 'maybe'"),
        ({"incident_date": "not-a-date"}, r"1 invalid incident_date .*\['not-a-date'\]"),
        ({"incident_date": "2025-12"}, "invalid incident_date"),
        ({"incident_date": "2025-12-05T00:00:00"}, "invalid incident_date"),
        ({"incident_date": "2025-02-30"}, "invalid incident_date"),
        ({"incident_date": None}, "gaps: {'incident_date': 1}"),
        ({"incident_id": None}, "no incident_id"),
        ({"detection_time_hours": "inf"}, "infinite"),
        # the numeric check comes before the flag check, and that before the date check
        ({"records_affected": "x", "zero_day_used": "x", "incident_date": "x"}, "records_affected"),
        ({"zero_day_used": "x", "incident_date": "x"}, "neither yes nor no"),
    ],
)
def test_bad_input_raises(make, text_schema, change, message):
    with pytest.raises(ValueError, match=message):
        cleaned_of(make([change], schema=text_schema))


def test_text_input_equals_typed_input(make, text_schema):
    text = cleaned_of(make([{"incident_date": "2025-3-1"}], schema=text_schema))
    assert by_id(text.df) == by_id(cleaned_of(make()).df)


def test_infinite_downtime_is_limited(make):
    rows = by_id(cleaned_of(make([{"downtime_hours": math.inf}])).df)
    assert rows["INC-001"]["downtime_hours"] == 720.0


def test_infinite_impact_is_fenced(make):
    """One infinite value lies beyond the upper fence; many push the fence to infinity and fail."""
    spread = F.substring("incident_id", 5, 3).cast("double")
    numbers = make(n=20).withColumn("records_affected", spread)
    one = numbers.withColumn("records_affected", F.when(spread == 3, F.lit(math.inf)).otherwise(spread))
    done = cleaned_of(one)
    assert by_id(done.df)["INC-003"]["records_affected"] == done.statistics["records_affected"].fences[1]
    many = numbers.withColumn("records_affected", F.when(spread > 9, F.lit(math.inf)).otherwise(spread))
    with pytest.raises(ValueError, match="infinite"):
        cleaned_of(many)


def test_missing_column_and_extra_columns(make):
    with pytest.raises(ValueError, match="Missing Columns"):
        cleaned_of(make().drop("region"))
    extra = make().withColumn("note one", F.lit("x"))
    assert cleaned_of(extra).df.columns == [*INCIDENT_COLUMNS, "note one"]
    with pytest.raises(ValueError, match="gaps"):
        cleaned_of(make().withColumn("note", F.when(F.col("region") == "South", "x")))


def test_extra_columns_pass_all_stages(spark, make, tmp_path):
    """Names with dots and spaces, text and numbers, through to the table and the profile."""
    from breachlens.plans.features import engineer_features
    from breachlens.plans.profile import column_quality, dataset_summary
    from breachlens.sources import IncidentTable

    extra = make().withColumns({"source.system": F.lit("siem"), "analyst hours": F.lit(2.5)})
    cleaned = cleaned_of(extra)
    table = IncidentTable(spark, str(tmp_path / "extra"), "t_extra_columns")
    table.store(engineer_features(cleaned), expected_rows=3)
    row = spark.table("t_extra_columns").first().asDict()
    assert row["source.system"] == "siem" and row["analyst hours"] == 2.5 and len(row) == 45
    quality = {r["column"]: r for r in column_quality(cleaned.df).collect()}
    assert quality["source.system"]["unique"] == 1 and quality["analyst hours"]["dtype"] == "double"
    assert column_quality(cleaned.df, exact=False).count() == dataset_summary(cleaned.df).count() == 18


def test_empty_input(make):
    with pytest.raises(ValueError, match="no rows"):
        cleaned_of(make().limit(0))


def test_long_value_lists_are_not_broadcast(spark, make, monkeypatch):
    """With the bound at zero the text is normalised in place and the frequencies are shuffled."""
    import breachlens.operators.frequency as frequency
    import breachlens.plans.cleaning as cleaning
    import breachlens.plans.features as features

    usual = by_id(features.engineer_features(cleaned_of(make())))
    monkeypatch.setattr(cleaning, "bounded_columns", lambda values: set())
    monkeypatch.setattr(frequency, "bounded_columns", lambda values, rows: set())
    assert by_id(features.engineer_features(cleaned_of(make()))) == usual


def test_report_round_trip(spark, make, tmp_path):
    from breachlens.sources.layers import write_json_report

    report = cleaned_of(make([{"severity_score": 99}])).report
    saved = write_json_report(spark, report, str(tmp_path / "report")).first().asDict()
    assert saved == report
    text = next((tmp_path / "report").glob("part-*.json")).read_text()
    assert json.loads(text)["range_adjustments_by_column"] == {"severity_score": 1}


def test_a_source_without_an_order_is_refused(make):
    with pytest.raises(ValueError, match="order_by"):
        clean_incidents(make(), [])
