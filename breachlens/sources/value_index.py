"""Exact order statistics that survive an append.

An index has a segment for each batch of rows that was added: the distinct values of every column with
their rows, in order, and a summary of them by bucket (count, min, max). Summaries of segments add up, so the
bucket that holds a rank is found without reading values, and only that bucket's values are read, as the
order of a segment lets Parquet skip the rest. Adding rows costs what the rows cost; no older segment is
read or written. ``compact`` makes one segment of many.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachlens.operators.order_stats import OrderStatistic, interpolated, log_bucket, quantile_ranks, search, summary, unpivot
from breachlens.operators.sizing import NARROW_ROWS_PER_PARTITION, shuffle_sized_for
from breachlens.sources.workspace import folder_exists

_VALUES = "name string, value double, rows bigint"
#: Stands for the row itself, so that the index knows its rows.
ROWS = "_rows"
_BUCKETS = "name string, bucket bigint, rows bigint, low_value double, high_value double"


class ValueIndex:
    """Index of number columns in ``folder``. Missing values (NULL, NaN) are left out, -0.0 counts as 0.0."""

    def __init__(self, spark: SparkSession, folder: str, columns: list[str]):
        self.spark, self.folder, self.columns = spark, folder.rstrip("/"), columns

    # --- segments ---------------------------------------------------------------
    def exists(self) -> bool:
        return folder_exists(self.spark, f"{self.folder}/buckets")

    def add(self, df: DataFrame) -> None:
        """Index the rows of ``df`` beside those that are there. They are counted first, to shuffle their values in enough parts."""
        values = unpivot(df, {ROWS: F.lit(0.0), **{c: F.col(f"`{c}`").cast("double") for c in self.columns}})
        self._write(values, df.count())

    def rows(self) -> int:
        """Rows that were added."""
        return self._counted().get(ROWS, 0)

    def _write(self, values: DataFrame, rows: int, into: str | None = None) -> None:
        """Write the (name, value, rows) of so many table rows as a segment."""
        into = into or self.folder
        distinct = values.groupBy("name", "value").agg(F.sum("rows").alias("rows"))
        part = uuid.uuid4().hex[:12]
        ordered = distinct.repartitionByRange("name", "value").sortWithinPartitions("name", "value")
        with shuffle_sized_for(self.spark, rows * len(self.columns), NARROW_ROWS_PER_PARTITION):
            ordered.write.parquet(f"{into}/values/segment={part}")
        written = self.spark.read.schema(_VALUES).parquet(f"{into}/values/segment={part}")
        buckets = written.groupBy("name", log_bucket(F.col("value")).alias("bucket")).agg(*summary())
        # written last: a segment counts from here on
        buckets.write.parquet(f"{into}/buckets/segment={part}")

    def compact(self, folder: str) -> ValueIndex:
        """One segment with the same values, as an index in another folder."""
        whole = ValueIndex(self.spark, folder, self.columns)
        self._write(self._values(), self.rows(), folder)
        return whole

    # --- values -----------------------------------------------------------------
    def _read(self, what: str, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, segment string").option("basePath", f"{self.folder}/{what}").parquet(f"{self.folder}/{what}")

    def _values(self) -> DataFrame:
        """Values of the finished segments."""
        done = [r.segment for r in self._read("buckets", _BUCKETS).select("segment").distinct().collect()]  # one per batch
        return self._read("values", _VALUES).where(F.col("segment").isin(done)).drop("segment")

    def buckets(self) -> DataFrame:
        each = self._read("buckets", _BUCKETS)
        return each.groupBy("name", "bucket").agg(
            F.sum("rows").alias("rows"), F.min("low_value").alias("low_value"), F.max("high_value").alias("high_value")
        )

    def inside(self, spans: dict[str, set[tuple[float, float, int]]]) -> DataFrame:
        wanted = F.lit(False)
        for name, many in spans.items():
            for low, high, _ in sorted(many):
                wanted = wanted | ((F.col("name") == name) & (F.col("value") >= low) & (F.col("value") <= high))
        return self._values().where(wanted)

    def counts(self) -> dict[str, int]:
        """Present values per column."""
        found = self._counted()
        return {c: found.get(c, 0) for c in self.columns}

    def _counted(self) -> dict[str, int]:
        return {r["name"]: r["rows"] for r in self.buckets().groupBy("name").agg(F.sum("rows").alias("rows")).collect()}

    # --- statistics -------------------------------------------------------------
    def order_statistics(self, ranks: dict[str, set[int]]) -> dict[tuple[str, int], OrderStatistic]:
        """As ``order_statistics`` of all rows that were added."""
        return search(self, ranks)

    def quantiles(self, columns: list[str], shares: list[float]) -> dict[tuple[str, float], float | None]:
        """As ``quantiles`` of all rows that were added."""
        counts = self.counts()
        ranks = {c: {r for share in shares for r in quantile_ranks(counts[c], share)[:2]} for c in columns if counts[c]}
        return interpolated(counts, columns, shares, self.order_statistics(ranks))
