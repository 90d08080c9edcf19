"""Incident rows derived from the star-schema tables, one per line item.

The text, with the tables filled in, runs in Spark SQL and in DuckDB, so both share one raw layer.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from breachlens.operators.sizing import WIDE_ROWS_PER_PARTITION, compiled, shuffle_sized_for
from breachlens.schema import FLAG_COLUMNS, NUMBER_COLUMNS

# the row of an incident id that counts as the first one
ORDER_COLUMNS = ["src_partkey", "src_suppkey", "src_price"]
SOURCE_TABLES = ["lineitem", "orders", "customer", "nation", "region", "part", "supplier"]

RAW_SQL = """
SELECT concat('INC-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS incident_id,
  l_partkey AS src_partkey, l_suppkey AS src_suppkey, l_extendedprice AS src_price,
  CAST(CAST(l_shipdate + INTERVAL 24 YEAR AS DATE) AS STRING) AS incident_date,
  CASE WHEN l_orderkey % 50 = 0 THEN NULL WHEN l_orderkey % 50 = 1 THEN '   '
       WHEN l_orderkey % 3 = 0 THEN concat('  ', lower(c_mktsegment), '  services ')
       ELSE concat(c_mktsegment, ' services') END AS sector,
  lower(r_name) AS region,
  CASE p_type WHEN 'MEDIUM' THEN 'ddos' WHEN 'STANDARD' THEN 'sql injection' WHEN 'ECONOMY' THEN 'phishing'
              WHEN 'SMALL' THEN 'ransomware' WHEN 'PROMO' THEN 'HTTP flood' ELSE 'iot  botnet' END AS attack_type,
  CASE WHEN s_nationkey % 9 = 0 THEN NULL
       WHEN s_nationkey % 2 = 0 THEN concat('apt-', CAST(s_nationkey AS STRING))
       ELSE 'state-sponsored' END AS threat_actor,
  CASE WHEN l_orderkey % 41 = 0 THEN NULL WHEN l_orderkey % 43 = 0 THEN CAST(-5 AS DOUBLE)
       WHEN l_quantity < 3 THEN CAST(0 AS DOUBLE)
       WHEN l_partkey % 97 = 0 THEN l_quantity * p_size * 1000
       ELSE l_quantity * p_size END AS records_affected,
  CAST(l_quantity * CAST(round(l_discount * 100) AS INT) * 2 AS DOUBLE) AS downtime_hours,
  CASE WHEN l_returnflag = 'N' THEN CAST(0 AS DOUBLE)
       WHEN l_partkey % 89 = 0 THEN CAST(CAST(round(l_extendedprice) AS BIGINT) * 10 AS DOUBLE)
       ELSE CAST(CAST(round(l_extendedprice) AS BIGINT) AS DOUBLE) END AS ransom_demand_usd,
  CASE WHEN l_orderkey % 37 = 0 THEN NULL
       ELSE CAST(CAST(round(l_tax * 100) AS INT) * 10 + l_linenumber AS DOUBLE) END AS detection_time_hours,
  CAST((l_suppkey + l_linenumber) % 13 AS DOUBLE) AS severity_score,
  CAST(p_size * 3 - 4 AS DOUBLE) AS response_team_size,
  CASE WHEN l_linestatus = 'O' THEN CAST(0 AS DOUBLE)
       WHEN l_orderkey % 31 = 0 THEN CAST(CAST(round(o_totalprice) AS BIGINT) * 5 AS DOUBLE)
       ELSE CAST(CAST(round(o_totalprice) AS BIGINT) AS DOUBLE) END AS regulatory_fine_usd,
  CASE WHEN l_linestatus = 'F' THEN 'Yes' ELSE ' no ' END AS resolved_within_7_days,
  CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN 'FALSE' ELSE NULL END AS data_exfiltration,
  CASE WHEN l_linenumber = 1 THEN 't' ELSE 'N' END AS zero_day_used
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
  JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
""".strip()


#: The same joins for Spark, which keeps their order: orders meet the customers before they meet the line items, so
#: that the far more numerous line items are shuffled by order and by part only.
_ORDERS = "JOIN {orders} ON l_orderkey = o_orderkey"
_OF_ORDERS = (
    "JOIN {customer} ON o_custkey = c_custkey\n"
    "  JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"
)


def orders_first(sql: str) -> str:
    flat = f"{_ORDERS} {_OF_ORDERS}"
    if flat not in sql:
        raise ValueError("The text has no joins of orders and customers.")
    return sql.replace(flat, f"JOIN (SELECT * FROM {{orders}} {_OF_ORDERS}) ON l_orderkey = o_orderkey")


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in SOURCE_TABLES}
    cores, lines = spark.sparkContext.defaultParallelism, tables["lineitem"]
    if lines.rdd.getNumPartitions() < cores:  # a file of one row group would keep the whole join in one task
        tables["lineitem"] = lines.repartition(cores)
    return tables


@contextmanager
def joins_sized(spark: SparkSession, sf_dir: str) -> Iterator[int]:
    """Within the block, the joins of these rows shuffle and sort in parts by the number of line items; whoever runs
    the plan of ``raw_incidents`` or ``dirty_incidents`` does so in it. Gives that number."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # from the files' footers
    with shuffle_sized_for(spark, lines, WIDE_ROWS_PER_PARTITION), compiled(spark):
        yield lines


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer with its three order columns, over all rows of the tables in ``sf_dir``."""
    return spark.sql(orders_first(RAW_SQL), **_tables(spark, sf_dir))


def _dirty_number(place: int, name: str) -> str:
    return (
        f"CASE WHEN src_partkey % 53 = {place} THEN '12abc' WHEN src_partkey % 47 = {place} THEN 'inf' "
        f"WHEN src_partkey % 43 = {place} THEN '-7' ELSE CAST({name} AS STRING) END AS {name}"
    )


#: The raw rows as text with faults on known shares of them, each kind in each column that can have it.
DIRTY_SQL = f"""
SELECT src_partkey, src_suppkey, src_price,
  CASE WHEN src_partkey % 71 = 0 THEN NULL WHEN src_partkey % 73 = 0 THEN 'INC-TWICE' ELSE incident_id END AS incident_id,
  CASE WHEN src_partkey % 67 = 0 THEN '2025/13/45' WHEN src_partkey % 59 = 0 THEN NULL
       WHEN src_partkey % 61 = 0 THEN '2999-01-31' ELSE incident_date END AS incident_date,
  sector, region, attack_type, threat_actor,
  {", ".join(_dirty_number(i, name) for i, name in enumerate(NUMBER_COLUMNS))},
  {", ".join(f"CASE WHEN src_partkey % 41 = {i} THEN 'maybe' ELSE {name} END AS {name}" for i, name in enumerate(FLAG_COLUMNS))}
FROM ({RAW_SQL})
""".strip()


def dirty_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer with faults, over all rows of the tables in ``sf_dir``."""
    return spark.sql(orders_first(DIRTY_SQL), **_tables(spark, sf_dir))
