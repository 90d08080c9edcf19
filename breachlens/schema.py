"""Column roles, limits and names of the incident table.

Everything in the first block is a fixed value: results depend on it, so it is
stated as is and in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
INCIDENT_ID = "incident_id"
INCIDENT_DATE = "incident_date"

CATEGORY_COLUMNS = ["sector", "region", "attack_type", "threat_actor"]

NUMBER_COLUMNS = [
    "records_affected",
    "downtime_hours",
    "ransom_demand_usd",
    "detection_time_hours",
    "severity_score",
    "response_team_size",
    "regulatory_fine_usd",
]

FLAG_COLUMNS = ["resolved_within_7_days", "data_exfiltration", "zero_day_used"]

INCIDENT_COLUMNS = [INCIDENT_ID, INCIDENT_DATE, *CATEGORY_COLUMNS, *NUMBER_COLUMNS, *FLAG_COLUMNS]

UNKNOWN_CATEGORY = "Unknown"
EMPTY_COLUMN_NUMBER = 0.0
MISSING_FLAG = False

# column -> (lower, upper), both inclusive; None means open
VALUE_RANGES = {
    "severity_score": (0.0, 10.0),
    "downtime_hours": (0.0, 720.0),
    "detection_time_hours": (0.0, None),
    "response_team_size": (1.0, 100.0),
    "records_affected": (0.0, None),
    "ransom_demand_usd": (0.0, None),
    "regulatory_fine_usd": (0.0, None),
}

# columns whose outliers are pulled to the 1.5 * IQR fences
FENCED_COLUMNS = ["records_affected", "ransom_demand_usd", "regulatory_fine_usd"]
FENCE_FACTOR = 1.5

# replaced one after the other, as substrings, in this order
ACRONYMS = [
    ("Api", "API"),
    ("Apt", "APT"),
    ("Ddos", "DDoS"),
    ("Dos", "DoS"),
    ("Dns", "DNS"),
    ("Http", "HTTP"),
    ("Https", "HTTPS"),
    ("Iot", "IoT"),
    ("Ip", "IP"),
    ("Mfa", "MFA"),
    ("Rdp", "RDP"),
    ("Sql", "SQL"),
    ("Ssh", "SSH"),
    ("Vpn", "VPN"),
    ("Xss", "XSS"),
]

TRUE_WORDS = ["true", "t", "yes", "y", "1"]
FALSE_WORDS = ["false", "f", "no", "n", "0"]

# cells that a pandas CSV scan reads as missing by default, compared unstripped
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

REFERENCE_DATE = "2025-12-31"
TABLE_NAME = "cybersecurity_incidents"

DETECTION_SPEEDS = [(6.0, "Very Fast"), (24.0, "Fast"), (72.0, "Moderate"), (None, "Slow")]
COST_QUARTILES = [(0.25, "Low"), (0.50, "Medium"), (0.75, "High"), (None, "Critical")]
HIGH_SEVERITY = 8
# ---------------------------------------------------------------------------

# category column -> name of its frequency feature
FREQUENCY_FEATURES = {
    "sector": "sector_frequency",
    "region": "region_frequency",
    "attack_type": "attack_frequency",
    "threat_actor": "threat_actor_frequency",
}

FEATURE_TYPES = T.StructType(
    [
        T.StructField("incident_year", T.IntegerType()),
        T.StructField("incident_month", T.IntegerType()),
        T.StructField("incident_day", T.IntegerType()),
        T.StructField("incident_week", T.IntegerType()),
        T.StructField("incident_quarter", T.IntegerType()),
        T.StructField("incident_weekday", T.StringType()),
        T.StructField("is_weekend", T.IntegerType()),
        T.StructField("month_name", T.StringType()),
        T.StructField("incident_age_days", T.IntegerType()),
        T.StructField("quarter_label", T.StringType()),
        T.StructField("ransom_per_record", T.DoubleType()),
        T.StructField("fine_per_record", T.DoubleType()),
        T.StructField("total_financial_impact", T.DoubleType()),
        T.StructField("downtime_per_record", T.DoubleType()),
        T.StructField("response_efficiency", T.DoubleType()),
        T.StructField("detection_speed", T.StringType()),
        T.StructField("incident_cost_category", T.StringType()),
        T.StructField("high_severity_flag", T.IntegerType()),
        T.StructField("high_ransom_flag", T.IntegerType()),
        T.StructField("large_breach_flag", T.IntegerType()),
        T.StructField("long_downtime_flag", T.IntegerType()),
        T.StructField("sector_frequency", T.LongType()),
        T.StructField("region_frequency", T.LongType()),
        T.StructField("attack_frequency", T.LongType()),
        T.StructField("threat_actor_frequency", T.LongType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("incident_complexity_score", T.DoubleType()),
    ]
)

FEATURE_COLUMNS = FEATURE_TYPES.fieldNames()


def clean_type(column: str) -> T.DataType:
    """Spark type of a column in the clean layer; columns outside the 16 stay text."""
    if column == INCIDENT_DATE:
        return T.DateType()
    if column in NUMBER_COLUMNS:
        return T.DoubleType()
    if column in FLAG_COLUMNS:
        return T.BooleanType()
    return T.StringType()


def table_type(column: str) -> T.DataType:
    """Spark type of a column in the query table, where flags are 0/1 integers."""
    if column in FLAG_COLUMNS:
        return T.IntegerType()
    return clean_type(column)
