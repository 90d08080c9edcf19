"""Operators against brute force on small data, and their plans."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from breachlens.operators import (
    attach_frequency,
    category_counts,
    keep_first,
    order_statistics,
    quantiles,
)


def frame(spark, columns):
    names = list(columns)
    rows = list(zip(*[[None if v is None else float(v) for v in columns[n]] for n in names]))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(4)


RNG = np.random.default_rng(7)
SHAPES = {
    "normal": RNG.normal(0, 1e4, 1500),
    "money": np.round(RNG.lognormal(8, 3, 1500), 2),
    "small_integers": RNG.integers(0, 11, 1500),
    "one_value_holds_a_third": np.where(RNG.random(1500) < 0.34, 480.0, RNG.normal(500, 50, 1500)),
    "constant": np.full(1500, 7.25),
    "close_together": 1e6 + RNG.integers(0, 400, 1500) * 2.0**-30,
    "huge_range": np.concatenate([10.0 ** RNG.uniform(-300, 300, 750), -(10.0 ** RNG.uniform(-300, 300, 750))]),
    "tiny": RNG.integers(-3, 4, 1500) * 5e-324,
}


def test_order_statistics_equal_sorting(spark):
    df = frame(spark, SHAPES)
    ranks = {n: {0, 1, 374, 375, 749, 750, 1124, 1125, 1498, 1499} for n in SHAPES}
    found = order_statistics(df, ranks)
    for name, values in SHAPES.items():
        ordered = np.sort(np.asarray(values, dtype=float))
        for rank in ranks[name]:
            stat = found[name, rank]
            assert stat.value == ordered[rank], (name, rank)
            assert stat.below == int((ordered < ordered[rank]).sum())
            assert stat.equal == int((ordered == ordered[rank]).sum())


def test_order_statistics_with_gaps_and_infinities(spark):
    df = frame(spark, {"a": [math.inf, None, 3, -math.inf, math.nan, 1]})
    found = order_statistics(df, {"a": {0, 1, 2, 3, 9}})
    assert [found["a", r].value for r in range(4)] == [-math.inf, 1, 3, math.inf]
    assert ("a", 9) not in found


def test_quantiles_equal_numpy(spark):
    df = frame(spark, {**SHAPES, "empty": [None] * 1500})
    shares = [0.25, 0.5, 0.75]
    found = quantiles(df, [*SHAPES, "empty"], shares)
    for name, values in SHAPES.items():
        for share in shares:
            assert found[name, share] == np.quantile(np.asarray(values, dtype=float), share), (name, share)
    assert found["empty", 0.5] is None


def test_keep_first_takes_the_first_by_order(spark):
    rows = [("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 5, "n"), (None, 4, "m")]
    df = spark.createDataFrame(rows, "k string, o int, v string").repartition(3)
    kept = {(r.k, r.v) for r in keep_first(df, "k", ["o"]).collect()}
    assert kept == {("a", "y"), ("b", "z"), (None, "m")}


def test_keep_first_limits_each_key_before_the_shuffle(spark):
    df = spark.range(0, 10_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("o"),
    )
    kept = keep_first(df, "k", ["o"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial, 1") if "Partial, 1" in plan else plan.index("Partial")
    assert "WindowGroupLimit" in plan
    assert plan.index("Exchange hashpartitioning") < partial  # the plan prints the root first
    assert kept.where("k = 'hot'").first()["o"] == 0
    assert kept.count() == 1 + sum(1 for i in range(10_000) if i % 3)


def brute_frequency(df, column):
    counts = {}
    for r in df.collect():
        counts[r[column]] = counts.get(r[column], 0) + 1
    return sorted((r["id"], counts[r[column]]) for r in df.collect())


@pytest.mark.parametrize("broadcast_rows", [1000, 5])
def test_frequency_by_broadcast_and_by_hot_and_tail(spark, broadcast_rows):
    """A third of the rows shares one value; long value lists are not broadcast whole."""
    df = spark.range(0, 3000, 1, 4).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("v"), F.pmod(F.col("id"), F.lit(97)))).alias("c"),
        F.when(F.col("id") >= 0, "same").alias("d"),
    )
    counts = category_counts(df, ["c", "d"]).cache()
    out = attach_frequency(df, counts, {"c": "c_rows", "d": "d_rows"}, "id", broadcast_rows, hot_values=2)
    assert out.columns == ["id", "c", "d", "c_rows", "d_rows"]
    got = sorted((r.id, r.c_rows) for r in out.collect())
    assert got == brute_frequency(df, "c")
    assert {r.d_rows for r in out.select("d_rows").distinct().collect()} == {3000}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_rows_are_spread_by_the_shuffle(spark):
    """The tail is joined by a shuffle here, and a third of the rows must not meet in one task."""
    df = spark.range(0, 30_000, 1, 4).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("c")
    )
    counts = category_counts(df, ["c"]).cache()
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = attach_frequency(df, counts, {"c": "n"}, "id", broadcast_rows=5, hot_values=3)
        plan = out._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        got = {(r["n"], r["count"]) for r in out.groupBy("n").count().collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan
    assert len(sizes) == 16 and max(sizes) < 1.3 * sum(sizes) / 16
    assert got == {(10_000, 10_000), (1, 20_000)}


def test_frequency_counts_every_null_category(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, c string")
    out = attach_frequency(df, category_counts(df, ["c"]), {"c": "n"}, "id")
    assert {(r.id, r.n) for r in out.collect()} == {(1, 2), (2, 2), (3, 1)}
    assert pd.isna(out.where("id = 1").first()["c"])
