"""Shuffle width and buckets by table size."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

WIDE_ROWS_PER_PARTITION = 800_000  # about 200 MB of incident rows
NARROW_ROWS_PER_PARTITION = 5_000_000  # about 200 MB of ids or category texts

#: Buckets of a layer or table with few rows.
LEAST_BUCKETS = 8

#: Generated methods beyond this many bytes are not compiled by the JVM and run an order slower; Spark then splits
#: the expressions instead. The wide projections of incident rows are beyond it.
JIT_LIMIT = {"spark.sql.codegen.hugeMethodLimit": "8000"}

#: Shuffle files are removed when the statement that made them ends; else they stay until the driver collects garbage.
SHUFFLES_REMOVED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: Buckets whose rows are shuffled at once when rows from elsewhere are dealt into them.
BUCKETS_IN_A_TURN = 48

#: Files that a task keeps open, if it writes rows for several turns as they come.
MOST_WRITERS = 16

_one_at_a_time = threading.RLock()


def buckets_for(rows: int) -> int:
    """Buckets of some ``WIDE_ROWS_PER_PARTITION`` rows, twice as many as these rows ask for."""
    return max(LEAST_BUCKETS, 2 * -(-rows // WIDE_ROWS_PER_PARTITION))


def turns_for(buckets: int) -> int:
    """In how many turns rows are dealt into so many buckets."""
    return -(-buckets // BUCKETS_IN_A_TURN)


@contextmanager
def _set_for_a_time(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    with _one_at_a_time:
        before = {name: spark.conf.get(name) for name in settings}
        try:
            for name, value in settings.items():
                spark.conf.set(name, value)
            yield
        finally:
            for name, value in before.items():
                spark.conf.set(name, value)


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Within the block, wide projections and many aggregates at once run in methods that the JVM compiles."""
    with _set_for_a_time(spark, {**JIT_LIMIT, **SHUFFLES_REMOVED}):
        yield


@contextmanager
def in_buckets(spark: SparkSession, buckets: int | None = None) -> Iterator[None]:
    """Within the block, a layer or table in buckets is read bucket by bucket, so rows that stay in their buckets
    are written again without a shuffle. With ``buckets``, shuffles get that many partitions: one for each bucket.
    A task that holds one bucket writes its rows as they come, not sorted by bucket first."""
    settings = {
        "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
        "spark.sql.maxConcurrentOutputFileWriters": "2",
        **JIT_LIMIT,
        **SHUFFLES_REMOVED,
    }
    if buckets:
        settings["spark.sql.shuffle.partitions"] = str(buckets)
    with _set_for_a_time(spark, settings):
        yield


@contextmanager
def shuffle_sized_for(spark: SparkSession, rows: int, rows_per_partition: int) -> Iterator[None]:
    """Within the block, shuffles get enough partitions for ``rows``, never fewer than configured.

    Adaptive execution merges small partitions but does not split large ones, so the number has
    to grow with the table. The setting only changes plans, never results. It belongs to the session,
    so threads take turns; a plan must run inside the block to get the width.
    """
    setting = "spark.sql.shuffle.partitions"
    with _one_at_a_time:
        width = max(int(spark.conf.get(setting)), -(-rows // rows_per_partition))
        with _set_for_a_time(spark, {setting: str(width), **SHUFFLES_REMOVED}):
            yield


@contextmanager
def writing_turns(spark: SparkSession, turns: int) -> Iterator[None]:
    """Within the block, a task keeps a file open for each of so many turns instead of sorting its rows by turn."""
    with _set_for_a_time(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(min(turns, MOST_WRITERS))}):
        yield
