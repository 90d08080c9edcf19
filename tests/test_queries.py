"""Every registered query against its SQL counterpart in DuckDB, and the shape of the plans."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as registered
from breachlens.operators import keep_first
from breachlens.fixture import ORDER_COLUMNS, raw_incidents

# the optional subpackage tests its own queries
NAMES = [name for name in registered.queries() if not re.match(r"op\d+_|pipeline$", name)]
SMALL = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return connection


def comparable(frame):
    def cell(value):
        if value is None or isinstance(value, str):
            return value
        return None if math.isnan(value) else float(value)

    names = sorted(frame.columns)
    return names, sorted(([cell(v) for v in row] for row in frame[names].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got = registered.queries()[name](spark, SMALL).toPandas()
    want = duck.execute(registered.oracle_sql()[name]).df()
    assert len(got) > 0
    assert comparable(got) == comparable(want)


def test_every_query_has_sql():
    assert set(NAMES) <= set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    row = registered.entry(spark).first()
    assert row["total_incidents"] == 4599


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_workers_and_no_cross_joins(spark):
    for name in NAMES:
        if name == "dq_rejections":  # a list of outcomes
            continue
        plan = plan_of(registered.queries()[name](spark, SMALL))
        for word in ("EvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, (name, word)


def test_engineered_plan_does_not_shuffle_rows(spark):
    """From the clean layer to the 43 columns: broadcasts of value lists only."""
    plan = plan_of(registered.layers(spark, SMALL).engineered)
    assert plan.count("BroadcastExchange") == 4
    assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan
    assert "Window" not in plan and "Sort" not in plan


def test_rows_are_shuffled_once_for_the_whole_chain(spark):
    plan = plan_of(keep_first(raw_incidents(spark, SMALL), "incident_id", ORDER_COLUMNS))
    assert plan.count("Exchange hashpartitioning(incident_id") == 1
    assert plan.count("WindowGroupLimit") == 2


def test_top_lists_are_top_k(spark):
    for name in ("q03_most_severe", "q10_highest_impact", "q11_highest_risk", "q20_costliest_sectors",
                 "q23_longest_downtime", "q24_most_complex", "table_preview"):
        assert "TakeOrderedAndProject" in plan_of(registered.queries()[name](spark, SMALL)), name
    plan = plan_of(registered.queries()["q22_leading_actors"](spark, SMALL))
    assert "WindowGroupLimit" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(registered.queries()["q18_high_severity"](spark, SMALL))
    assert "GreaterThanOrEqual(severity_score,8.0)" in plan
    assert "ReadSchema: struct<incident_id:string,sector:string,severity_score:double>" in plan


def test_number_of_jobs_is_bounded(spark):
    """Cleaning and features need a fixed number of actions, whatever the data."""
    context = spark.sparkContext
    context.setJobGroup("count-jobs", "layers")
    registered.build_layers(spark, SMALL)
    jobs = context.statusTracker().getJobIdsForGroup("count-jobs")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 80  # AQE runs each stage and each broadcast as a job of its own
