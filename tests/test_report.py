"""All grouped questions from one scan, against each asked alone."""

import __spark_entry__ as registered
from breachlens.plans.analytics import QUESTIONS
from breachlens.plans.report import ANSWERS, grouped_figures, report

SMALL = "/root/testdata/sf0.001"


def test_each_answer_equals_its_question(spark, tmp_path):
    table = registered.incidents(spark, SMALL)
    answers = report(table, str(tmp_path / "figures"))
    assert set(answers) == set(ANSWERS) < set(QUESTIONS)
    for name, answer in answers.items():
        alone = QUESTIONS[name](table)
        assert answer.columns == alone.columns, name
        assert [tuple(r) for r in answer.collect()] == [tuple(r) for r in alone.collect()], name


def test_null_keys_are_groups_of_their_own(spark, tmp_path):
    columns = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in (
        "severity_score", "downtime_hours", "records_affected", "risk_score", "total_financial_impact", "detection_time_hours",
        "response_team_size", "resolved_within_7_days"))
    table = spark.sql(
        f"SELECT sector, CAST(NULL AS STRING) AS region, 'a' AS attack_type, 't' AS threat_actor, 0 AS zero_day_used, 1 AS data_exfiltration, "
        f"0 AS is_weekend, 2020 AS incident_year, 1 AS incident_month, {columns} FROM VALUES ('x'), (NULL), (NULL) AS v(sector)"
    )
    answers = report(table, str(tmp_path / "figures"))
    assert sorted(map(str, map(tuple, answers["q04_by_sector"].collect()))) == ["('x', 1)", "(None, 2)"]
    assert [tuple(r) for r in answers["q05_by_region"].collect()] == [(None, 3)]
    assert answers["q01_total_incidents"].first()[0] == 3


def test_one_scan_and_one_shuffle(spark, tmp_path):
    table = registered.incidents(spark, SMALL)
    context = spark.sparkContext
    context.setJobGroup("figures", "figures")
    grouped_figures(table, str(tmp_path / "figures"))
    jobs = context.statusTracker().getJobIdsForGroup("figures")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 2  # a stage that shuffles and one that writes
