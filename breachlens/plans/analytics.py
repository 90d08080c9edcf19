"""The 29 analytical questions, each a function of the query table.

All of them read only the columns they need. Groupings combine before the shuffle, and every
top list is a top-k, never a full sort.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Question = Callable[[DataFrame], DataFrame]
# columns need a running session, so the questions hold makers of columns
Measure = Callable[[], Column]


def _count(name: str) -> Measure:
    return lambda: F.count(F.lit(1)).alias(name)


def _mean(column: str, name: str) -> Measure:
    return lambda: F.round(F.avg(column), 2).alias(name)


def _total(column: str, name: str) -> Measure:
    return lambda: F.round(F.sum(column), 2).alias(name)


def _percent(flag: str, name: str) -> Measure:
    return lambda: F.round(F.avg(F.col(flag).cast("double")) * 100, 2).alias(name)


def _overall(*measures: Measure) -> Question:
    return lambda t: t.agg(*[make() for make in measures])


def _by(key: str, measure: Measure, name: str) -> Question:
    """One measure per key value, the largest first, equal ones by key."""
    return lambda t: t.groupBy(key).agg(measure()).orderBy(F.desc(name), key)


def _split(flag: str) -> Question:
    """Incidents with and without a flag."""
    return lambda t: t.groupBy(flag).agg(_count("incidents")()).orderBy(F.desc(flag))


def _top(column: str, *more: str) -> Question:
    """The ten incidents with the largest value, equal ones by id."""
    return lambda t: (
        t.select("incident_id", column, *more).orderBy(F.desc(column), "incident_id").limit(10)
    )


def monthly_trend(t: DataFrame) -> DataFrame:
    month = ["incident_year", "incident_month"]
    return t.groupBy(*month).agg(_count("total_incidents")()).orderBy(*month)


def high_severity_list(t: DataFrame) -> DataFrame:
    severe = t.where(F.col("severity_score") >= 8)
    return severe.select("incident_id", "severity_score", "sector").orderBy(
        F.desc("severity_score"), "incident_id"
    )


def costliest_sectors(t: DataFrame) -> DataFrame:
    losses = t.groupBy("sector").agg(_total("total_financial_impact", "total_loss")())
    return losses.orderBy(F.desc("total_loss"), "sector").limit(5)


def leading_actors(t: DataFrame) -> DataFrame:
    """The most frequent threat actor of each region; ties give several rows."""
    per_actor = t.groupBy("region", "threat_actor").agg(_count("incidents")())
    place = F.rank().over(Window.partitionBy("region").orderBy(F.desc("incidents")))
    first = per_actor.withColumn("place", place).where("place = 1").drop("place")
    return first.orderBy("region", "threat_actor")


def impact_by_attack(t: DataFrame) -> DataFrame:
    sums = t.groupBy("attack_type").agg(
        _count("incidents")(),
        _total("total_financial_impact", "total_impact")(),
        _mean("total_financial_impact", "avg_financial_impact")(),
    )
    named = sums.withColumnRenamed("total_impact", "total_financial_impact")
    return named.orderBy(F.desc("total_financial_impact"), "attack_type")


def resolution_by_sector(t: DataFrame) -> DataFrame:
    rates = t.groupBy("sector").agg(
        _count("incidents")(), _percent("resolved_within_7_days", "resolution_rate")()
    )
    return rates.orderBy(F.desc("resolution_rate"), "sector")


def table_sanity(t: DataFrame) -> DataFrame:
    """Rows, distinct ids and gaps. Grouping by id first keeps the shuffled record narrow."""

    def gaps(column: str) -> Column:
        return F.count_if(F.col(column).isNull())

    per_id = t.groupBy("incident_id").agg(
        F.count(F.lit(1)).alias("rows"),
        gaps("severity_score").alias("severity_gaps"),
        gaps("incident_date").alias("date_gaps"),
    )
    return per_id.agg(
        F.sum("rows").alias("total_rows"),
        F.count("incident_id").alias("distinct_incident_ids"),
        F.sum(F.when(F.col("incident_id").isNull(), F.col("rows")).otherwise(0)).alias("null_incident_ids"),
        F.sum("severity_gaps").alias("null_severity_scores"),
        F.sum("date_gaps").alias("null_incident_dates"),
    )


QUESTIONS: dict[str, Question] = {
    "q01_total_incidents": _overall(_count("total_incidents")),
    "q02_average_severity": _overall(_mean("severity_score", "average_severity")),
    "q03_most_severe": _top("severity_score", "attack_type", "sector"),
    "q04_by_sector": _by("sector", _count("total_incidents"), "total_incidents"),
    "q05_by_region": _by("region", _count("total_incidents"), "total_incidents"),
    "q06_by_attack_type": _by("attack_type", _count("incidents"), "incidents"),
    "q07_by_threat_actor": _by("threat_actor", _count("incidents"), "incidents"),
    "q08_monthly_trend": monthly_trend,
    "q09_downtime_by_sector": _by("sector", _mean("downtime_hours", "avg_downtime"), "avg_downtime"),
    "q10_highest_impact": _top("total_financial_impact"),
    "q11_highest_risk": _top("risk_score", "attack_type"),
    "q12_zero_day_split": _split("zero_day_used"),
    "q13_exfiltration_split": _split("data_exfiltration"),
    "q14_average_detection": _overall(_mean("detection_time_hours", "average_detection_time")),
    "q15_average_team": _overall(_mean("response_team_size", "average_team_size")),
    "q16_resolution_rate": _overall(_percent("resolved_within_7_days", "success_rate")),
    "q17_records_by_attack": _by(
        "attack_type", _mean("records_affected", "average_records"), "average_records"
    ),
    "q18_high_severity": high_severity_list,
    "q19_weekend_split": _split("is_weekend"),
    "q20_costliest_sectors": costliest_sectors,
    "q21_risk_by_sector": _by("sector", _mean("risk_score", "avg_risk"), "avg_risk"),
    "q22_leading_actors": leading_actors,
    "q23_longest_downtime": _top("downtime_hours", "attack_type"),
    "q24_most_complex": _top("incident_complexity_score"),
    "q25_dashboard": _overall(
        _count("total_incidents"),
        _mean("severity_score", "avg_severity"),
        _mean("downtime_hours", "avg_downtime"),
        _total("total_financial_impact", "total_financial_loss"),
        _mean("risk_score", "average_risk_score"),
        _percent("resolved_within_7_days", "resolution_success_rate"),
        _mean("detection_time_hours", "avg_detection_time"),
    ),
    "q26_high_risk_count": lambda t: t.where(F.col("risk_score") >= 20).agg(_count("high_risk_incidents")()),
    "q27_impact_by_attack": impact_by_attack,
    "q28_resolution_by_sector": resolution_by_sector,
    "q29_table_sanity": table_sanity,
}
