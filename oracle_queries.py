"""DuckDB text for every registered query, over the same Parquet tables.

One chain of common table expressions repeats the whole work in plain SQL: raw rows, keep-first,
typed values, medians, limits, fences, clean rows, features. Each query adds its own last step.
"""

from __future__ import annotations

from breachlens.fixture import DIRTY_SQL, ORDER_COLUMNS, RAW_SQL, SOURCE_TABLES
from breachlens.plans.features import FEATURE_GROUPS
from breachlens.schema import (
    ACRONYMS,
    CATEGORY_COLUMNS,
    FEATURE_COLUMNS,
    FEATURE_TYPES,
    FENCED_COLUMNS,
    FLAG_COLUMNS,
    FREQUENCY_FEATURES,
    INCIDENT_COLUMNS,
    MISSING_CELLS,
    NUMBER_COLUMNS,
    REFERENCE_DATE,
    VALUE_RANGES,
    table_type,
)

LETTERS = r"\p{Lu}\p{Ll}\p{Lt}"


def sql_round(x: str, digits: int = 2) -> str:
    """Half up on the decimal text of the double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def half_even(x: str, digits: int = 2) -> str:
    return f"(round_even(({x}) * {10**digits}, 0) / {10**digits})"


def spelled(column: str) -> str:
    squeezed = rf"trim(regexp_replace({column}, '\s+', ' ', 'g'))"
    pieces = f"regexp_extract_all({squeezed}, '([{LETTERS}]+|[^{LETTERS}]+)')"
    text = f"array_to_string(list_transform({pieces}, lambda c: upper(c[1]) || lower(c[2:])), '')"
    for plain, right in ACRONYMS:
        text = f"replace({text}, '{plain}', '{right}')"
    return f"coalesce(nullif({text}, ''), 'Unknown')"


def flag(column: str) -> str:
    return (
        f"CASE WHEN lower(trim({column})) IN ('true','t','yes','y','1') THEN 1 "
        f"WHEN lower(trim({column})) IN ('false','f','no','n','0') THEN 0 ELSE NULL END"
    )


def limit(column: str) -> str:
    lower, upper = VALUE_RANGES[column]
    text = f"greatest({column}, {lower})"
    return text if upper is None else f"least({text}, {upper})"


def ratio(top: str, bottom: str, digits: int) -> str:
    return half_even(f"coalesce({top} / nullif({bottom}, 0), 0)", digits)


def cut(column: str) -> str:
    fenced = (
        f"least(greatest({column}, {column}_q1 - 1.5 * ({column}_q3 - {column}_q1)), "
        f"{column}_q3 + 1.5 * ({column}_q3 - {column}_q1))"
    )
    return f"CASE WHEN {column}_q3 = {column}_q1 THEN {column} ELSE {fenced} END"


def _list(items) -> str:
    return ", ".join(items)


def chain(last: str) -> str:
    """The chain up to and including the step named ``last``."""
    steps = {
        "raw": RAW_SQL.format(**{name: name for name in SOURCE_TABLES}),
        "dedup": f"SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY {_list(ORDER_COLUMNS)}) = 1",
        "medians": f"SELECT {_list(f'coalesce(median({c}), 0) AS {c}_mid' for c in NUMBER_COLUMNS)} FROM dedup",
        "filled": f"""SELECT incident_id, CAST(incident_date AS DATE) AS incident_date,
  {_list(f'{spelled(c)} AS {c}' for c in CATEGORY_COLUMNS)},
  {_list(f'coalesce({c}, {c}_mid) AS {c}' for c in NUMBER_COLUMNS)},
  {_list(f'coalesce({flag(c)}, 0) AS {c}' for c in FLAG_COLUMNS)}
FROM dedup, medians""",
        "limited": f"SELECT * REPLACE ({_list(f'{limit(c)} AS {c}' for c in NUMBER_COLUMNS)}) FROM filled",
        "quartiles": f"SELECT {_list(f'quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3' for c in FENCED_COLUMNS)} FROM limited",
        "clean": f"""SELECT {_list(cut(c) + f' AS {c}' if c in FENCED_COLUMNS else c for c in INCIDENT_COLUMNS)}
FROM limited, quartiles""",
        "mids": "SELECT median(ransom_demand_usd) AS ransom_mid, median(records_affected) AS records_mid, median(downtime_hours) AS downtime_mid FROM clean",
        "ranked": """SELECT *, ransom_demand_usd + regulatory_fine_usd AS total_financial_impact,
  count(*) OVER () AS n, rank() OVER (ORDER BY ransom_demand_usd + regulatory_fine_usd) AS first_place,
  count(*) OVER (PARTITION BY ransom_demand_usd + regulatory_fine_usd) AS ties FROM clean""",
        "flagged": """SELECT *, CAST(ransom_demand_usd >= ransom_mid AS INTEGER) AS high_ransom_flag,
  CAST(records_affected >= records_mid AS INTEGER) AS large_breach_flag,
  CAST(downtime_hours >= downtime_mid AS INTEGER) AS long_downtime_flag,
  (first_place + (ties - 1) / 2.0) / n AS share FROM ranked, mids""",
        "engineered": f"""SELECT {_list(INCIDENT_COLUMNS)},
  CAST(year(incident_date) AS INTEGER) AS incident_year, CAST(month(incident_date) AS INTEGER) AS incident_month,
  CAST(day(incident_date) AS INTEGER) AS incident_day, CAST(week(incident_date) AS INTEGER) AS incident_week,
  CAST(quarter(incident_date) AS INTEGER) AS incident_quarter, dayname(incident_date) AS incident_weekday,
  CAST(isodow(incident_date) >= 6 AS INTEGER) AS is_weekend, monthname(incident_date) AS month_name,
  CAST(date_diff('day', incident_date, DATE '{REFERENCE_DATE}') AS INTEGER) AS incident_age_days,
  'Q' || quarter(incident_date) AS quarter_label,
  {ratio('ransom_demand_usd', 'records_affected', 2)} AS ransom_per_record,
  {ratio('regulatory_fine_usd', 'records_affected', 2)} AS fine_per_record, total_financial_impact,
  {ratio('downtime_hours', 'records_affected', 4)} AS downtime_per_record,
  {ratio('response_team_size', 'detection_time_hours', 2)} AS response_efficiency,
  CASE WHEN detection_time_hours <= 6 THEN 'Very Fast' WHEN detection_time_hours <= 24 THEN 'Fast'
       WHEN detection_time_hours <= 72 THEN 'Moderate' ELSE 'Slow' END AS detection_speed,
  CASE WHEN share <= 0.25 THEN 'Low' WHEN share <= 0.5 THEN 'Medium' WHEN share <= 0.75 THEN 'High'
       ELSE 'Critical' END AS incident_cost_category,
  CAST(severity_score >= 8 AS INTEGER) AS high_severity_flag, high_ransom_flag, large_breach_flag, long_downtime_flag,
  {_list(f'count(*) OVER (PARTITION BY {c}) AS {f}' for c, f in FREQUENCY_FEATURES.items())},
  severity_score * 3 + zero_day_used * 2 + data_exfiltration * 2 + high_ransom_flag + large_breach_flag AS risk_score,
  {half_even('severity_score + ln(1 + records_affected) + downtime_hours / 24 + detection_time_hours / 24')} AS incident_complexity_score
FROM flagged""",
    }
    names = list(steps)
    used = names[: names.index(last) + 1]
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({steps[name]})" for name in used) + "\n"


def on(last: str, select: str) -> str:
    return chain(last) + select


def long_form(last: str, values: dict[str, list[str]], names: list[str], table: str | None = None) -> str:
    """One SELECT per entry, as rows."""
    selects = [
        f"SELECT '{key}' AS {names[0]}, " + ", ".join(f"{x} AS {n}" for x, n in zip(many, names[1:]))
        + f" FROM {table or last}"
        for key, many in values.items()
    ]
    return chain(last) + " UNION ALL ".join(selects)


def _grouped(key: str, measure: str) -> str:
    return on("engineered", f"SELECT {key}, {measure} FROM engineered GROUP BY {key}")


def _one(measures: str) -> str:
    return on("engineered", f"SELECT {measures} FROM engineered")


def _top10(column: str, more: str = "") -> str:
    return on(
        "engineered",
        f"SELECT incident_id, {column}{more} FROM engineered ORDER BY {column} DESC, incident_id LIMIT 10",
    )


def _shown(columns: list[str], table: str) -> str:
    """Columns as registered queries give them: dates as text."""
    return ", ".join(
        "CAST(incident_date AS VARCHAR) AS incident_date" if c == "incident_date" else c for c in columns
    ) + f" FROM {table}"


QUESTIONS = {
    "q01_total_incidents": _one("count(*) AS total_incidents"),
    "q02_average_severity": _one(f"{sql_round('avg(severity_score)')} AS average_severity"),
    "q03_most_severe": _top10("severity_score", ", attack_type, sector"),
    "q04_by_sector": _grouped("sector", "count(*) AS total_incidents"),
    "q05_by_region": _grouped("region", "count(*) AS total_incidents"),
    "q06_by_attack_type": _grouped("attack_type", "count(*) AS incidents"),
    "q07_by_threat_actor": _grouped("threat_actor", "count(*) AS incidents"),
    "q08_monthly_trend": _grouped("incident_year, incident_month", "count(*) AS total_incidents"),
    "q09_downtime_by_sector": _grouped("sector", f"{sql_round('avg(downtime_hours)')} AS avg_downtime"),
    "q10_highest_impact": _top10("total_financial_impact"),
    "q11_highest_risk": _top10("risk_score", ", attack_type"),
    "q12_zero_day_split": _grouped("zero_day_used", "count(*) AS incidents"),
    "q13_exfiltration_split": _grouped("data_exfiltration", "count(*) AS incidents"),
    "q14_average_detection": _one(f"{sql_round('avg(detection_time_hours)')} AS average_detection_time"),
    "q15_average_team": _one(f"{sql_round('avg(response_team_size)')} AS average_team_size"),
    "q16_resolution_rate": _one(f"{sql_round('avg(resolved_within_7_days) * 100')} AS success_rate"),
    "q17_records_by_attack": _grouped("attack_type", f"{sql_round('avg(records_affected)')} AS average_records"),
    "q18_high_severity": on(
        "engineered", "SELECT incident_id, severity_score, sector FROM engineered WHERE severity_score >= 8"
    ),
    "q19_weekend_split": _grouped("is_weekend", "count(*) AS incidents"),
    "q20_costliest_sectors": _grouped("sector", f"{sql_round('sum(total_financial_impact)')} AS total_loss")
    + " ORDER BY total_loss DESC, sector LIMIT 5",
    "q21_risk_by_sector": _grouped("sector", f"{sql_round('avg(risk_score)')} AS avg_risk"),
    "q22_leading_actors": on(
        "engineered",
        "SELECT * FROM (SELECT region, threat_actor, count(*) AS incidents FROM engineered "
        "GROUP BY region, threat_actor) QUALIFY rank() OVER (PARTITION BY region ORDER BY incidents DESC) = 1",
    ),
    "q23_longest_downtime": _top10("downtime_hours", ", attack_type"),
    "q24_most_complex": _top10("incident_complexity_score"),
    "q25_dashboard": _one(
        f"count(*) AS total_incidents, {sql_round('avg(severity_score)')} AS avg_severity, "
        f"{sql_round('avg(downtime_hours)')} AS avg_downtime, "
        f"{sql_round('sum(total_financial_impact)')} AS total_financial_loss, "
        f"{sql_round('avg(risk_score)')} AS average_risk_score, "
        f"{sql_round('avg(resolved_within_7_days) * 100')} AS resolution_success_rate, "
        f"{sql_round('avg(detection_time_hours)')} AS avg_detection_time"
    ),
    "q26_high_risk_count": on(
        "engineered", "SELECT count(*) AS high_risk_incidents FROM engineered WHERE risk_score >= 20"
    ),
    "q27_impact_by_attack": _grouped(
        "attack_type",
        f"count(*) AS incidents, {sql_round('sum(total_financial_impact)')} AS total_financial_impact, "
        f"{sql_round('avg(total_financial_impact)')} AS avg_financial_impact",
    ),
    "q28_resolution_by_sector": _grouped(
        "sector", f"count(*) AS incidents, {sql_round('avg(resolved_within_7_days) * 100')} AS resolution_rate"
    ),
    "q29_table_sanity": _one(
        "count(*) AS total_rows, count(DISTINCT incident_id) AS distinct_incident_ids, "
        "count(*) FILTER (incident_id IS NULL) AS null_incident_ids, "
        "count(*) FILTER (severity_score IS NULL) AS null_severity_scores, "
        "count(*) FILTER (incident_date IS NULL) AS null_incident_dates"
    ),
}


def _missing_cell(c: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in MISSING_CELLS)
    return f"CASE WHEN CAST({c} AS VARCHAR) IN ({tokens}) THEN NULL ELSE {c} END AS {c}"


ENGINEERED_COLUMNS = [*INCIDENT_COLUMNS, *FEATURE_COLUMNS]

_CLEAN_DTYPES = {
    **{c: "string" for c in ["incident_id", *CATEGORY_COLUMNS]},
    "incident_date": "date",
    **{c: "double" for c in NUMBER_COLUMNS},
    **{c: "boolean" for c in FLAG_COLUMNS},
}

_REPORT = [
    ("initial_rows", "", "(SELECT count(*) FROM raw)"),
    ("final_rows", "", "(SELECT count(*) FROM clean)"),
    ("duplicates_removed", "", "(SELECT count(*) - count(DISTINCT incident_id) FROM raw)"),
    (
        "missing_values_filled",
        "",
        "(SELECT "
        + " + ".join(
            f"count(*) FILTER ({c} IS NULL)" for c in [*CATEGORY_COLUMNS, *NUMBER_COLUMNS, *FLAG_COLUMNS]
        )
        + " FROM dedup)",
    ),
    *[
        (
            "outliers_capped_by_column",
            c,
            f"(SELECT count(*) FROM limited l JOIN clean c USING (incident_id) WHERE l.{c} <> c.{c})",
        )
        for c in FENCED_COLUMNS
    ],
    *[
        (
            "range_adjustments_by_column",
            c,
            f"(SELECT count(*) FROM filled f JOIN limited l USING (incident_id) WHERE f.{c} <> l.{c})",
        )
        for c in VALUE_RANGES
    ],
]


ENGINEERED_DOUBLES = [*NUMBER_COLUMNS, *(f.name for f in FEATURE_TYPES.fields if f.dataType.typeName() == "double")]

#: Rules of ``dq_rejections``: error, words of the message, rows that break the rule. {x} stands for a number from ``_FAULTS``.
REJECTIONS = [
    ("V1 empty", "ValueError", "has no rows", "0"),
    ("V2 blank name", "ValueError", "name is blank", "{raw}"),
    ("V3 repeated name", "ValueError", "repeated: ['sector']", "{raw}"),
    ("V4 lacking column", "ValueError", "Missing Columns: ['region']", "{raw}"),
    ("V5 no id", "ValueError", "have no incident_id", "{raw_faulty}"),
    ("V6 number", "ValueError", "records_affected: {faulty} invalid numeric", "{faulty}"),
    ("V7 date", "ValueError", "{faulty} invalid incident_date", "{faulty}"),
    ("V8 flag", "ValueError", "zero_day_used: {faulty} values are neither yes nor no", "{faulty}"),
    ("V9 final ids", "ValueError", "must stay unique", "{clean}"),
    ("V10 gap", "ValueError", "gaps: {'sector': {faulty}}", "{faulty}"),
    ("V11 infinite", "ValueError", "infinite values in ['records_affected']", "{faulty}"),
    ("V12 range", "ValueError", "{faulty} values of severity_score out of range", "{faulty}"),
    ("V13 feature input", "ValueError", "invalid incident_date or none", "{faulty}"),
    ("V14 future", "ValueError", "in the future of the reference date 2017-01-05", "{future}"),
    ("V15 feature output", "ValueError", "Output has gaps in ['risk_score']", "{faulty}"),
    ("V16 counts", "ValueError", "{less} rows instead of {clean}", "1"),
    ("V17 status", "ValueError", "not read back as a success", "1"),
    ("V18 flag values", "ValueError", "flags other than 0 and 1 in zero_day_used", "{faulty}"),
    ("V19 profile input", "ValueError", "invalid incident_date or none in some rows", "{faulty}"),
    ("S3 no file", "FileNotFoundError", "Dataset not found", "0"),
    ("S12 schema", "ValueError", "lacks the columns ['risk_score']", "{clean}"),
    ("S15 table", "ValueError", "no table absent_table", "0"),
    ("S16 repeated insert", "ValueError", "present and unique", "{faulty}"),
]
_FAULTS = {
    "raw": "(SELECT count(*) FROM raw)",
    "raw_faulty": "(SELECT count(*) FROM raw WHERE incident_id LIKE '%-7')",
    "clean": "(SELECT count(*) FROM clean)",
    "less": "(SELECT count(*) - 1 FROM clean)",
    "faulty": "(SELECT count(*) FROM clean WHERE incident_id LIKE '%-7')",
    "future": "(SELECT count(*) FROM clean WHERE incident_date > DATE '2017-01-05')",
}


def rejections() -> str:
    def filled_in(words: str) -> str:
        text = "'" + words.replace("'", "''") + "'"
        for name, number in _FAULTS.items():
            text = text.replace(f"{{{name}}}", f"' || {number} || '")
        return text

    def counted(rows: str) -> str:
        return _FAULTS.get(rows.strip("{}"), rows)

    return chain("clean") + " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{error}' AS error, {filled_in(words)} AS message, CAST({counted(rows)} AS BIGINT) AS rows"
        for rule, error, words, rows in REJECTIONS
    )


def dirty_checks() -> str:
    """Counts of the faults in the dirty rows, read with DuckDB's own casts."""
    day = "TRY_CAST(incident_date AS DATE)"
    number = {c: f"TRY_CAST({c} AS DOUBLE)" for c in NUMBER_COLUMNS}
    counts = {
        **{f"unreadable:{c}": f"{c} IS NOT NULL AND {x} IS NULL" for c, x in number.items()},
        **{f"unreadable:{c}": f"{c} IS NOT NULL AND ({flag(c)}) IS NULL" for c in FLAG_COLUMNS},
        "unreadable:incident_date": f"incident_date IS NOT NULL AND {day} IS NULL",
        **{f"missing:{c}": f"{c} IS NULL" for c in ["incident_id", *CATEGORY_COLUMNS]},
        "missing:incident_date": f"{day} IS NULL",
        **{f"missing:{c}": f"{x} IS NULL" for c, x in number.items()},
        **{f"missing:{c}": f"({flag(c)}) IS NULL" for c in FLAG_COLUMNS},
        **{f"infinite:{c}": f"isinf({x})" for c, x in number.items()},
        **{
            f"outside:{c}": f"{number[c]} < {lo}" + ("" if hi is None else f" OR {number[c]} > {hi}")
            for c, (lo, hi) in VALUE_RANGES.items()
        },
        "future": f"{day} > DATE '{REFERENCE_DATE}'",
        "profile:no_date": f"{day} IS NULL",
        **{f"unflag:{c}": "src_partkey % 29 = 0" for c in FLAG_COLUMNS},
        "missing_ids": "incident_id IS NULL",
    }
    dirty = DIRTY_SQL.format(**{name: name for name in SOURCE_TABLES})
    selects = [f"SELECT '{k}' AS \"check\", count(*) FILTER ({x}) AS rows FROM dirty" for k, x in counts.items()]
    selects.append("SELECT 'rows', count(*) FROM dirty")
    selects.append(
        "SELECT 'duplicate_ids', count(*) - count(DISTINCT incident_id) - max(CASE WHEN incident_id IS NULL THEN 1 ELSE 0 END) FROM dirty"
    )
    return f"WITH dirty AS MATERIALIZED ({dirty})\n" + " UNION ALL ".join(selects)


#: Keys and figures of the questions that ``grouped_report`` answers together.
_REPORTED = {
    "q01_total_incidents": ([], ["total_incidents"]),
    "q02_average_severity": ([], ["average_severity"]),
    "q04_by_sector": (["sector"], ["total_incidents"]),
    "q05_by_region": (["region"], ["total_incidents"]),
    "q06_by_attack_type": (["attack_type"], ["incidents"]),
    "q07_by_threat_actor": (["threat_actor"], ["incidents"]),
    "q08_monthly_trend": (["incident_year", "incident_month"], ["total_incidents"]),
    "q09_downtime_by_sector": (["sector"], ["avg_downtime"]),
    "q12_zero_day_split": (["zero_day_used"], ["incidents"]),
    "q13_exfiltration_split": (["data_exfiltration"], ["incidents"]),
    "q14_average_detection": ([], ["average_detection_time"]),
    "q15_average_team": ([], ["average_team_size"]),
    "q16_resolution_rate": ([], ["success_rate"]),
    "q17_records_by_attack": (["attack_type"], ["average_records"]),
    "q19_weekend_split": (["is_weekend"], ["incidents"]),
    "q20_costliest_sectors": (["sector"], ["total_loss"]),
    "q21_risk_by_sector": (["sector"], ["avg_risk"]),
    "q22_leading_actors": (["region", "threat_actor"], ["incidents"]),
    "q25_dashboard": ([], [
        "total_incidents", "avg_severity", "avg_downtime", "total_financial_loss", "average_risk_score", "resolution_success_rate",
        "avg_detection_time",
    ]),
    "q26_high_risk_count": ([], ["high_risk_incidents"]),
    "q27_impact_by_attack": (["attack_type"], ["incidents", "total_financial_impact", "avg_financial_impact"]),
    "q28_resolution_by_sector": (["sector"], ["incidents", "resolution_rate"]),
}


def grouped_report() -> str:
    before, parts = chain("engineered"), []
    for question, (keys, figures) in _REPORTED.items():
        key = f"concat_ws('/', {_list(keys)})" if keys else "''"
        for figure in figures:
            parts.append(
                f"SELECT '{question}' AS question, {key} AS key, '{figure}' AS figure, CAST({figure} AS DOUBLE) AS value "
                f"FROM ({QUESTIONS[question].removeprefix(before)})"
            )
    return before + " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    out = dict(QUESTIONS)
    out["grouped_report"] = grouped_report()
    raw_columns = [c for c in INCIDENT_COLUMNS]
    out["clean_dedupe"] = on("dedup", f"SELECT {_list(raw_columns)} FROM dedup")
    out["clean_text"] = on("filled", f"SELECT incident_id, {_list(CATEGORY_COLUMNS)} FROM filled")
    out["clean_spellings"] = chain("dedup") + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, {spelled(c)} AS clean, count(*) AS rows FROM dedup GROUP BY ALL"
        for c in CATEGORY_COLUMNS
    )
    out["clean_impute"] = on("filled", f"SELECT incident_id, {_list(NUMBER_COLUMNS)} FROM filled")
    out["clean_flags"] = on("filled", f"SELECT incident_id, {_list(FLAG_COLUMNS)} FROM filled")
    out["clean_dates"] = on("filled", "SELECT incident_id, CAST(incident_date AS VARCHAR) AS incident_date FROM filled")
    out["clean_clip"] = on("limited", f"SELECT incident_id, {_list(NUMBER_COLUMNS)} FROM limited")
    out["clean_fence"] = on("clean", f"SELECT incident_id, {_list(FENCED_COLUMNS)} FROM clean")
    out["clean_incidents"] = on("clean", "SELECT " + _shown(INCIDENT_COLUMNS, "clean"))
    out["clean_statistics"] = chain("mids") + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", (SELECT {c}_mid FROM medians) AS fill, "
        + (
            f"(SELECT {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) FROM quartiles) AS lower_fence, "
            f"(SELECT {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) FROM quartiles) AS upper_fence, "
            if c in FENCED_COLUMNS
            else "CAST(NULL AS DOUBLE) AS lower_fence, CAST(NULL AS DOUBLE) AS upper_fence, "
        )
        + f"(SELECT median({c}) FROM clean) AS clean_median"
        for c in NUMBER_COLUMNS
    )
    capped_total = "(SELECT sum(rows) FROM report WHERE metric = 'outliers_capped_by_column')"
    out["quality_report"] = (
        chain("clean")
        + ", report AS ("
        + " UNION ALL ".join(
            f"SELECT '{m}' AS metric, '{c}' AS \"column\", CAST({x} AS BIGINT) AS rows" for m, c, x in _REPORT
        )
        + ") SELECT * FROM report WHERE \"column\" = '' OR rows > 0 "
        + f"UNION ALL SELECT 'outliers_capped', '', CAST({capped_total} AS BIGINT)"
    )
    for name, columns in FEATURE_GROUPS.items():
        out[name] = on("engineered", f"SELECT incident_id, {_list(columns)} FROM engineered")
    engineered = on("engineered", "SELECT " + _shown(ENGINEERED_COLUMNS, "engineered"))
    out["engineered"] = engineered
    out["engineered_standalone"] = engineered
    out["eda_quality"] = long_form(
        "clean",
        {
            c: [
                f"'{_CLEAN_DTYPES[c]}'",
                f"count(*) FILTER ({c} IS NULL)",
                half_even(f"count(*) FILTER ({c} IS NULL) * 100.0 / count(*)"),
                f"count(DISTINCT {c}) + max(CAST({c} IS NULL AS INTEGER))",
            ]
            for c in INCIDENT_COLUMNS
        },
        ['"column"', "dtype", "missing", "missing_pct", '"unique"'],
    )
    out["eda_describe"] = long_form(
        "clean",
        {
            c: [
                f"count({c})", half_even(f"avg({c})"), half_even(f"stddev_samp({c})"), half_even(f"min({c})"),
                half_even(f"quantile_cont({c}, 0.25)"), half_even(f"quantile_cont({c}, 0.5)"),
                half_even(f"quantile_cont({c}, 0.75)"), half_even(f"max({c})"),
            ]
            for c in NUMBER_COLUMNS
        },
        ['"column"', '"count"', "mean", "std", '"min"', "p25", "p50", "p75", '"max"'],
    )
    out["eda_top_categories"] = chain("clean") + " UNION ALL ".join(
        f"(SELECT '{c}' AS \"column\", {c} AS value, count(*) AS \"count\" FROM clean GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} LIMIT 10)"
        for c in CATEGORY_COLUMNS
    )
    out["eda_monthly"] = (
        chain("clean")
        + ", months AS (SELECT last_day(CAST(m AS DATE)) AS month_end FROM (SELECT unnest(generate_series("
        "date_trunc('month', (SELECT min(incident_date) FROM clean)), "
        "date_trunc('month', (SELECT max(incident_date) FROM clean)), INTERVAL 1 MONTH)) AS m)) "
        "SELECT CAST(month_end AS VARCHAR) AS month_end, count(incident_id) AS incident_count "
        "FROM months LEFT JOIN clean ON last_day(incident_date) = month_end GROUP BY month_end"
    )
    out["eda_histogram"] = (
        chain("clean")
        + ", ends AS (SELECT min(severity_score) AS low, max(severity_score) AS high FROM clean), "
        "bins AS (SELECT CAST(unnest(generate_series(1, 10)) AS INTEGER) AS bin), "
        "placed AS (SELECT least(CAST(floor((severity_score - low) / (high - low) * 10) AS INTEGER) + 1, 10) AS bin "
        "FROM clean, ends) "
        "SELECT bins.bin AS bin, low + (bins.bin - 1) * ((high - low) / 10) AS lower_edge, "
        "low + bins.bin * ((high - low) / 10) AS upper_edge, "
        "(SELECT count(*) FROM placed WHERE placed.bin = bins.bin) AS incidents FROM bins, ends"
    )
    out["eda_totals"] = long_form(
        "clean", {c: [f"sum({c})"] for c in ["ransom_demand_usd", "regulatory_fine_usd"]}, ['"column"', "total_usd"]
    )
    out["eda_flag_rates"] = long_form(
        "clean", {c: [sql_round(f"avg({c}) * 100")] for c in FLAG_COLUMNS}, ['"column"', "true_rate_percent"]
    )
    out["eda_correlations"] = chain("clean") + " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {half_even(f'corr({a}, {b})')} AS r FROM clean"
        for a in NUMBER_COLUMNS
        for b in NUMBER_COLUMNS
    )
    raw_type = {**{c: "string" for c in INCIDENT_COLUMNS}, **{c: "double" for c in NUMBER_COLUMNS}}
    out["missing_report"] = long_form(
        "raw", {c: [f"count(*) FILTER ({c} IS NULL)"] for c in INCIDENT_COLUMNS}, ['"column"', "missing"]
    )
    out["dataset_summary"] = long_form(
        "raw",
        {
            c: [f"{i}", f"'{raw_type[c]}'", f"count(*) FILTER ({c} IS NULL)", "count(*)", f"{len(INCIDENT_COLUMNS)}"]
            for i, c in enumerate(INCIDENT_COLUMNS, 1)
        },
        ['"column"', '"position"', "dtype", "missing", "rows", '"columns"'],
    )
    checks = {
        "rows": "count(*)",
        **{f"missing:{c}": f"count(*) FILTER ({c} IS NULL)" for c in ENGINEERED_COLUMNS},
        **{
            f"outside:{c}": f"count(*) FILTER ({c} < {lo}" + (")" if hi is None else f" OR {c} > {hi})")
            for c, (lo, hi) in VALUE_RANGES.items()
        },
        **{f"unflag:{c}": f"count(*) FILTER ({c} NOT IN (0, 1))" for c in FLAG_COLUMNS},
        **{f"infinite:{c}": f"count(*) FILTER (isinf({c}))" for c in ENGINEERED_DOUBLES},
        "duplicates": "count(*) - count(DISTINCT incident_id)",
        "future": f"count(*) FILTER (incident_date > DATE '{REFERENCE_DATE}')",
    }
    out["dq_checks"] = long_form("engineered", {k: [v] for k, v in checks.items()}, ['"check"', "rows"])
    out["dq_raw_checks"] = chain("dedup") + " UNION ALL ".join(
        [
            "SELECT 'rows' AS \"check\", count(*) AS rows FROM raw",
            "SELECT 'missing_ids', count(*) FILTER (incident_id IS NULL) FROM raw",
            "SELECT 'duplicate_ids', count(*) - count(DISTINCT incident_id) FROM raw",
            *[
                f"SELECT 'unreadable:{c}', count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) FROM dedup"
                for c in NUMBER_COLUMNS
            ],
            *[
                f"SELECT 'unreadable:{c}', count(*) FILTER ({c} IS NOT NULL AND ({flag(c)}) IS NULL) FROM dedup"
                for c in FLAG_COLUMNS
            ],
            "SELECT 'unreadable:incident_date', count(*) FILTER (incident_date IS NOT NULL "
            "AND TRY_CAST(incident_date AS DATE) IS NULL) FROM dedup",
        ]
    )
    out["dq_dirty_checks"] = dirty_checks()
    out["dq_rejections"] = rejections()
    out["feat_other_day"] = on(
        "clean",
        "SELECT incident_id, CAST(date_diff('day', incident_date, DATE '2026-01-05') AS INTEGER) AS incident_age_days FROM clean",
    )
    out["table_statement"] = on("engineered", "SELECT attack_type, count(*) AS incidents FROM engineered GROUP BY attack_type")
    types = {c: table_type(c).simpleString() for c in INCIDENT_COLUMNS}
    types |= {f.name: f.dataType.simpleString() for f in FEATURE_TYPES.fields}
    out["table_schema"] = chain("engineered") + " UNION ALL ".join(
        f"SELECT '{c}' AS name, '{kind}' AS type, {int(c == 'incident_id')} AS is_key, count({c}) AS values FROM engineered"
        for c, kind in types.items()
    )
    out["table_quantiles"] = chain("engineered") + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", rank, value, below, equal FROM ("
        f"SELECT {c} AS value, row_number() OVER (ORDER BY {c}) - 1 AS rank, rank() OVER (ORDER BY {c}) - 1 AS below, "
        f"count(*) OVER (PARTITION BY {c}) AS equal, count(*) OVER () - 1 AS last FROM engineered) "
        "WHERE rank IN (0, last // 4, last * 2 // 4, last * 3 // 4, last)"
        for c in NUMBER_COLUMNS
    )
    out["csv_line_breaks"] = on(
        "raw",
        "SELECT incident_id, CASE WHEN src_partkey % 7 = 0 THEN attack_type || chr(10) || '\"' || region || '\"' || chr(10) "
        "ELSE attack_type END AS attack_type, region, severity_score FROM raw",
    )
    out["run_summary"] = on(
        "engineered",
        "SELECT 'SUCCESS' AS status, (SELECT count(*) FROM raw) AS raw_records, "
        "(SELECT count(*) FROM clean) AS clean_records, count(*) AS engineered_records, "
        "count(*) AS database_records, CAST(16 AS BIGINT) AS original_features, "
        "CAST(43 AS BIGINT) AS engineered_features, CAST(27 AS BIGINT) AS new_features_created FROM engineered",
    )
    out["csv_round_trip"] = on(
        "raw",
        "SELECT "
        + ", ".join(
            f"CAST({c} AS DOUBLE) AS {c}" if c in NUMBER_COLUMNS else _missing_cell(c) for c in INCIDENT_COLUMNS
        )
        + " FROM raw",
    )
    out["clean_csv"] = out["clean_incidents"]
    out["engineered_csv"] = engineered
    out["csv_pipeline"] = engineered
    out["table_rows"] = on("engineered", "SELECT count(*) AS rows FROM engineered")
    out["table_preview"] = on(
        "engineered", "SELECT " + _shown(ENGINEERED_COLUMNS, "engineered") + " ORDER BY incident_id LIMIT 5"
    )
    out["table_parameters"] = on(
        "engineered",
        "SELECT region, count(*) AS incidents FROM engineered "
        "WHERE severity_score >= 8 AND attack_type = 'DDoS' GROUP BY region",
    )
    out["table_rewrite"] = on(
        "engineered",
        "SELECT incident_year, count(*) AS incidents, sum(severity_score) AS severity FROM engineered "
        "WHERE is_weekend = 0 GROUP BY incident_year",
    )
    out["table_append"] = on(
        "engineered",
        "SELECT sector, count(*) AS incidents, count(total_financial_impact) AS with_impact FROM ("
        "SELECT sector, total_financial_impact FROM engineered WHERE is_weekend = 0 UNION ALL "
        "SELECT sector, NULL FROM engineered WHERE is_weekend = 1) GROUP BY sector",
    )
    out["table_export"] = on(
        "engineered",
        "SELECT sector, region, count(*) AS incidents, sum(severity_score) AS severity FROM engineered GROUP BY ALL",
    )
    return out
