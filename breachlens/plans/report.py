"""The grouped and overall questions asked together: one scan, one shuffle, for all of them.

``grouped_figures`` groups the table by all their keys at once (``GROUPING SETS``) and takes every measure that
any of them needs. What it returns has a row per key value, so the answers, one DataFrame per question with the
columns and order of the question asked alone, cost next to nothing. Lists of single incidents are not grouped
and stay as they are in ``analytics``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breachlens.sources.layers import write_layer

SETS = [
    (), ("sector",), ("region",), ("attack_type",), ("threat_actor",), ("zero_day_used",), ("data_exfiltration",),
    ("is_weekend",), ("incident_year", "incident_month"), ("region", "threat_actor"),
]
KEYS = list(dict.fromkeys(key for keys in SETS for key in keys))
_MEANS = [
    "severity_score", "downtime_hours", "records_affected", "risk_score", "total_financial_impact", "detection_time_hours",
    "response_team_size", "resolved_within_7_days",
]


def grouped_figures(t: DataFrame, folder: str) -> DataFrame:
    """(set, keys..., rows, high_risk, impact, mean of each measured column), written to ``folder``."""
    columns = [F.col(c) for c in KEYS]
    grouped = t.groupingSets([[F.col(k) for k in keys] for keys in SETS], *columns).agg(
        F.grouping_id(*columns).alias("set"),
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("risk_score") >= 20).alias("high_risk"),
        F.sum("total_financial_impact").alias("impact"),
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in _MEANS],
    )
    return write_layer(grouped, folder)


def _set_id(keys: tuple[str, ...]) -> int:
    """Spark's number of a grouping set: a bit for each key that it leaves out, the first key highest."""
    return sum(1 << len(KEYS) - 1 - i for i, key in enumerate(KEYS) if key not in keys)


def _of(figures: DataFrame, *keys: str) -> DataFrame:
    return figures.where(F.col("set") == _set_id(keys))


def _mean(column: str, name: str) -> Column:
    return F.round(f"mean_{column}", 2).alias(name)


def _rate(name: str) -> Column:
    return F.round(F.col("mean_resolved_within_7_days") * 100, 2).alias(name)


def _by(key: str, measure: Callable[[], Column], name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda f: _of(f, key).select(key, measure()).orderBy(F.desc(name), key)


def _count(name: str) -> Callable[[], Column]:
    return lambda: F.col("rows").alias(name)


def _overall(*measures: Callable[[], Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda f: _of(f).select(*[make() for make in measures])


def _split(flag: str) -> Callable[[DataFrame], DataFrame]:
    return lambda f: _of(f, flag).select(flag, F.col("rows").alias("incidents")).orderBy(F.desc(flag))


def _leading_actors(f: DataFrame) -> DataFrame:
    place = F.rank().over(Window.partitionBy("region").orderBy(F.desc("rows")))
    first = _of(f, "region", "threat_actor").withColumn("place", place).where("place = 1")
    return first.select("region", "threat_actor", F.col("rows").alias("incidents")).orderBy("region", "threat_actor")


def _total() -> Column:
    return F.round("impact", 2)


ANSWERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "q01_total_incidents": _overall(_count("total_incidents")),
    "q02_average_severity": _overall(lambda: _mean("severity_score", "average_severity")),
    "q04_by_sector": _by("sector", _count("total_incidents"), "total_incidents"),
    "q05_by_region": _by("region", _count("total_incidents"), "total_incidents"),
    "q06_by_attack_type": _by("attack_type", _count("incidents"), "incidents"),
    "q07_by_threat_actor": _by("threat_actor", _count("incidents"), "incidents"),
    "q08_monthly_trend": lambda f: _of(f, "incident_year", "incident_month")
    .select("incident_year", "incident_month", F.col("rows").alias("total_incidents"))
    .orderBy("incident_year", "incident_month"),
    "q09_downtime_by_sector": _by("sector", lambda: _mean("downtime_hours", "avg_downtime"), "avg_downtime"),
    "q12_zero_day_split": _split("zero_day_used"),
    "q13_exfiltration_split": _split("data_exfiltration"),
    "q14_average_detection": _overall(lambda: _mean("detection_time_hours", "average_detection_time")),
    "q15_average_team": _overall(lambda: _mean("response_team_size", "average_team_size")),
    "q16_resolution_rate": _overall(lambda: _rate("success_rate")),
    "q17_records_by_attack": _by("attack_type", lambda: _mean("records_affected", "average_records"), "average_records"),
    "q19_weekend_split": _split("is_weekend"),
    "q20_costliest_sectors": lambda f: _of(f, "sector")
    .select("sector", _total().alias("total_loss"))
    .orderBy(F.desc("total_loss"), "sector")
    .limit(5),
    "q21_risk_by_sector": _by("sector", lambda: _mean("risk_score", "avg_risk"), "avg_risk"),
    "q22_leading_actors": _leading_actors,
    "q25_dashboard": _overall(
        _count("total_incidents"), lambda: _mean("severity_score", "avg_severity"), lambda: _mean("downtime_hours", "avg_downtime"),
        lambda: _total().alias("total_financial_loss"), lambda: _mean("risk_score", "average_risk_score"),
        lambda: _rate("resolution_success_rate"), lambda: _mean("detection_time_hours", "avg_detection_time"),
    ),
    "q26_high_risk_count": _overall(lambda: F.col("high_risk").alias("high_risk_incidents")),
    "q27_impact_by_attack": lambda f: _of(f, "attack_type")
    .select(
        "attack_type", F.col("rows").alias("incidents"), _total().alias("total_financial_impact"),
        _mean("total_financial_impact", "avg_financial_impact"),
    )
    .orderBy(F.desc("total_financial_impact"), "attack_type"),
    "q28_resolution_by_sector": lambda f: _of(f, "sector")
    .select("sector", F.col("rows").alias("incidents"), _rate("resolution_rate"))
    .orderBy(F.desc("resolution_rate"), "sector"),
}


def report(t: DataFrame, folder: str) -> dict[str, DataFrame]:
    """The answers to all grouped and overall questions, from one scan of the table."""
    figures = grouped_figures(t, folder)
    return {name: answer(figures) for name, answer in ANSWERS.items()}
