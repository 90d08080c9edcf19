"""How often each category value occurs, and that number attached to every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
HOT_VALUES = 10_000


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, rows) for all columns in one scan; null is a value of its own.

    The counts are combined before the shuffle, so a value that holds a third of all rows
    costs one record per task.
    """
    names = {c: F.col("`" + c.replace("`", "``") + "`") for c in columns}
    texts = df.select(*[value.cast("string").alias(c) for c, value in names.items()])
    return (
        texts.unpivot([], list(names.values()), "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def bounded_columns(
    values: DataFrame, broadcast_rows: int = BROADCAST_ROWS, broadcast_bytes: int = BROADCAST_BYTES
) -> set[str]:
    """The columns of a (column, value, ...) list that are measured to be small enough to broadcast."""
    sizes = values.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + 64).alias("bytes"),
    )
    small = (F.col("rows") <= broadcast_rows) & (F.col("bytes") <= broadcast_bytes)
    return {row["column"] for row in sizes.where(small).collect()}


def look_up(df: DataFrame, listed: DataFrame, column: str, result: str, output: str) -> DataFrame:
    """``df`` with ``result`` of a small (column, value, result) list added as ``output``.

    ``listed`` must be within the bounds of ``bounded_columns`` for this column.
    """
    own = listed.where(F.col("column") == column).select(
        F.col("value").alias("_value"), F.col(result).alias(output)
    )
    return df.join(F.broadcast(own), F.col(column).eqNullSafe(F.col("_value")), "left").drop("_value")


def attach_frequency(
    df: DataFrame,
    counts: DataFrame,
    features: dict[str, str],
    spread_by: str,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_values: int = HOT_VALUES,
) -> DataFrame:
    """Add one row-count column per category column; ``features`` maps column to new name.

    The size of each column's value list is measured first. A list within the bounds is
    broadcast, so the wide table is not shuffled. Beyond them only the most frequent values are
    broadcast and the others are joined by a shuffle, where the rows already served are spread
    by their ``spread_by`` value: a key that is left holds one row in ``hot_values`` at most, which
    adaptive skew splitting takes apart. The sizes choose the plan only; the result is the same.
    ``counts`` is read several times, so pass a written result of ``category_counts``.
    """
    small = bounded_columns(counts, broadcast_rows)
    order = df.columns
    for column, feature in features.items():
        if column in small:
            df = look_up(df, counts, column, "rows", feature)
        else:
            listed = counts.where(F.col("column") == column).select(
                F.col("value").alias("_value"), F.col("rows").alias("_rows")
            )
            df = _hot_and_tail(df, listed, column, feature, spread_by, hot_values)
    return df.select(
        *[F.col(f"`{c}`") for c in order],
        *[F.coalesce(f, F.lit(0).cast("long")).alias(f) for f in features.values()],
    )


def _hot_and_tail(
    df: DataFrame, listed: DataFrame, column: str, feature: str, spread_by: str, hot_values: int
) -> DataFrame:
    # digests instead of the values, so the broadcast is bounded by their number alone
    top = listed.orderBy(F.desc("_rows"), "_value").limit(hot_values)
    hot = top.select(F.sha2("_value", 256).alias("_hot"), F.col("_rows").alias("_hot_rows"))
    cold = F.sha2("_value", 256).eqNullSafe(F.col("_hot"))
    tail = listed.join(F.broadcast(hot.select("_hot")), cold, "left_anti").select(
        F.col("_value").alias("_tail"), F.col("_rows").alias("_tail_rows")
    )
    # Rows already served get a key of their own from the id, so the shuffle spreads them evenly.
    # The salt has to be in the key: a separate constant column would be folded out of the join.
    served = F.col("_hot_rows").isNotNull()
    own_key = F.concat(F.lit("\u0000"), F.xxhash64(spread_by).cast("string"))
    salted = df.join(
        F.broadcast(hot), F.sha2(F.col(column), 256).eqNullSafe(F.col("_hot")), "left"
    ).withColumn("_key", F.when(served, own_key).otherwise(F.col(column)))
    match = F.col("_key").eqNullSafe(F.col("_tail")) & F.col("_hot_rows").isNull()
    return (
        salted.join(tail, match, "left")
        .withColumn(feature, F.coalesce("_hot_rows", "_tail_rows"))
        .drop("_hot", "_hot_rows", "_key", "_tail", "_tail_rows")
    )
