"""Written layers: Parquet for rows, JSON for the cleaning report."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachlens.operators.sizing import turns_for, writing_turns
from breachlens.sources.workspace import folder_exists, remove_folder

#: How the rows of large layers and tables are packed: some fifth smaller than by Spark's default.
PACKED = "zstd"


def write_layer(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and return the layer read back, cut off from what made it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_buckets(
    df: DataFrame, path: str, key: str, buckets: int, write: Callable[[Callable[[DataFrame], None]], None] | None = None
) -> DataFrame:
    """``write_layer`` in buckets by ``key``: what is made of the layer row by row can be written in these buckets
    without a shuffle. ``write`` gets the function that writes, if more is to happen on the way.

    The rows are not moved: hand them in with each key in one partition, or each task writes a file per bucket.
    """
    spark, name = df.sparkSession, f"layer_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression '{PACKED}') CLUSTERED BY ({quoted(key)}) "
        f"INTO {buckets} BUCKETS LOCATION {text_literal(path)}"
    )
    try:
        if write:
            write(lambda rows: rows.write.insertInto(name))
        else:
            df.write.insertInto(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the definition only: the layer is known by its folder


def deal_buckets(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """``write_buckets`` of rows that may lie anywhere; those that lie in these buckets stay there.

    If there are many buckets, the rows are written once as they come, apart by the turn of their bucket, and then
    shuffled one turn after the other: disks hold the shuffle of one turn, not that of all rows and of the plan
    behind them. ``df`` runs one time.
    """
    spark, turns, placed = df.sparkSession, turns_for(buckets), df.repartition(buckets, key)
    if turns == 1 or "Exchange" not in placed._jdf.queryExecution().executedPlan().toString():
        return write_buckets(placed, path, key, buckets)
    turn, staged = f"turn_{uuid.uuid4().hex[:12]}", f"{path}-turns"
    bucket = F.pmod(F.hash(F.col(quoted(key))), F.lit(buckets))
    with writing_turns(spark, turns):
        df.withColumn(turn, bucket % turns).write.option("compression", PACKED).partitionBy(turn).parquet(staged)

    def write(insert: Callable[[DataFrame], None]) -> None:
        for number in range(turns):
            part = f"{staged}/{turn}={number}"
            if folder_exists(spark, part):
                insert(spark.read.schema(df.schema).parquet(part).repartition(buckets, key))
                remove_folder(spark, part)
        remove_folder(spark, staged)

    return write_buckets(df, path, key, buckets, write)


def write_json_report(spark: SparkSession, report: dict[str, Any], path: str) -> DataFrame:
    """Write a report of counts and count maps as one JSON record and return it read back."""
    columns = []
    for name, value in report.items():
        if isinstance(value, dict):
            text = F.lit(json.dumps(value))
            columns.append(F.from_json(text, "map<string,bigint>").alias(name))
        else:
            columns.append(F.lit(value).cast("bigint").alias(name))
    row = spark.range(1).select(*columns)
    row.coalesce(1).write.mode("overwrite").json(path)
    return spark.read.schema(row.schema).json(path)
