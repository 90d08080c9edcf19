"""Exploratory profile of the clean layer."""

from __future__ import annotations

import math
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from breachlens.functions import nan_to_null, parse_day, round_half_even
from breachlens.functions.numbers import is_missing
from breachlens.operators import category_counts, quantiles
from breachlens.operators.checks import check_required, duplicate_count, measure
from breachlens.schema import CATEGORY_COLUMNS, FLAG_COLUMNS, INCIDENT_DATE, INCIDENT_ID, NUMBER_COLUMNS

MONEY_COLUMNS = ["ransom_demand_usd", "regulatory_fine_usd"]


def profile_input_measures(df: DataFrame) -> dict[str, Column]:
    """Rows, rows without id and rows without a readable date."""
    day = parse_day(F.col(INCIDENT_DATE), df.schema[INCIDENT_DATE].dataType)
    return {
        "rows": F.count(F.lit(1)),
        "no_id": F.count_if(F.col(INCIDENT_ID).isNull()),
        "no_date": F.count_if(day.isNull()),
    }


def check_profile_input(df: DataFrame) -> None:
    """Required columns, at least one row, ids present and unique, dates readable."""
    check_required(df.columns, "The profile input lacks columns")
    found = measure(df, profile_input_measures(df))
    if not found["rows"]:
        raise ValueError("The profile input has no rows.")
    if found["no_id"] or duplicate_count(df, found["rows"]):
        raise ValueError(f"Some {INCIDENT_ID} values are absent or repeated in the profile input.")
    if found["no_date"]:
        raise ValueError(f"The profile input has an invalid {INCIDENT_DATE} or none in some rows.")


def _folded(df: DataFrame) -> DataFrame:
    """Number columns with NaN as NULL, so that every part counts it as missing."""
    numbers = [c for c in NUMBER_COLUMNS if c in df.columns]
    return df.withColumns({c: nan_to_null(F.col(c).cast("double")) for c in numbers})


def _long(df: DataFrame, values: dict[str, dict[str, Column]], key: str) -> DataFrame:
    """One aggregate over ``df``, then one row per entry of ``values``."""
    flat = {f"{name}|{what}": c for name, many in values.items() for what, c in many.items()}
    row = df.agg(*[c.alias(n) for n, c in flat.items()])
    entries = [
        F.struct(F.lit(name).alias(key), *[F.col(f"`{name}|{what}`").alias(what) for what in many])
        for name, many in values.items()
    ]
    return row.select(F.inline(F.array(*entries)))


def column_quality(df: DataFrame, exact: bool = True) -> DataFrame:
    """Type, missing count and share, and distinct values (null is one) of each column.

    The exact count is one scan and one shuffle: every row gives a (column, digest) pair per column, and equal pairs
    are combined before the shuffle. The digest has 128 bits, from the value in its own type. With
    ``exact=False`` distinct values are estimated from sketches, without a shuffle of values.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    type_of = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    if exact:
        names = F.array(*[F.lit(c) for c in df.columns])
        # the expansion copies its whole input per column, so it sees nothing but digests
        pairs = df.select(*[_digest(_one_gap(df, c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
        per_value = (
            pairs.unpivot([], pairs.columns, "place", "digest")
            .groupBy("place", "digest")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        counted = per_value.groupBy("place").agg(
            F.sum("n").alias("rows"), F.sum(F.when(F.col("digest").isNull(), F.col("n")).otherwise(0)).alias("missing"),
            F.count(F.lit(1)).alias("unique"),
        )
        place = F.substring("place", 2, 9).cast("int")
        counted = counted.select(F.get(names, place).alias("column"), "rows", "missing", "unique")
    else:
        gap = {c: is_missing(F.col(f"`{c}`"), df.schema[c].dataType) for c in df.columns}
        counted = _long(
            df,
            {
                c: {
                    "rows": F.count(F.lit(1)),
                    "missing": F.count_if(gap[c]),
                    "unique": F.approx_count_distinct(F.col(f"`{c}`")) + F.max(gap[c].cast("long")),
                }
                for c in df.columns
            },
            "column",
        )
    return counted.select(
        "column",
        type_of[F.col("column")].alias("dtype"),
        "missing",
        round_half_even(F.col("missing") / F.col("rows") * 100, 2).alias("missing_pct"),
        "unique",
    ).orderBy(F.desc("missing"), "column")


def _digest(value: Column) -> Column:
    """128 bits from two hashes with different seeds; NULL for NULL."""
    return F.when(value.isNotNull(), F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b")))


def _one_gap(df: DataFrame, name: str) -> Column:
    """The column's values, with NaN as NULL and -0.0 as 0.0."""
    value = F.col(f"`{name}`")
    return nan_to_null(value) if df.schema[name].dataType.typeName() in ("double", "float") else value


def missing_report(df: DataFrame) -> DataFrame:
    """Missing values per column, the most first."""
    gaps = {
        c: {"missing": F.count_if(is_missing(F.col(f"`{c}`"), df.schema[c].dataType))}
        for c in df.columns
    }
    return _long(df, gaps, "column").orderBy(F.desc("missing"), "column")


def dataset_summary(df: DataFrame) -> DataFrame:
    """Position, type and missing values of each column with the table's row and column count."""
    described = {
        c: {
            "position": F.lit(i),
            "dtype": F.lit(df.schema[c].dataType.simpleString()),
            "missing": F.count_if(is_missing(F.col(f"`{c}`"), df.schema[c].dataType)),
            "rows": F.count(F.lit(1)),
            "columns": F.lit(len(df.columns)),
        }
        for i, c in enumerate(df.columns, 1)
    }
    return _long(df, described, "column").orderBy("position")


def describe_numbers(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of the number columns."""
    df = _folded(df)
    cuts = quantiles(df, NUMBER_COLUMNS, [0.25, 0.5, 0.75])

    def shown(value: Column) -> Column:
        return round_half_even(value, 2)

    def cut(c: str, share: float) -> Column:
        return shown(F.lit(cuts[c, share]).cast("double"))

    return _long(
        df,
        {
            c: {
                "count": F.count(c),
                "mean": shown(F.avg(c)),
                "std": shown(F.stddev_samp(c)),
                "min": shown(F.min(c)),
                "p25": cut(c, 0.25),
                "p50": cut(c, 0.5),
                "p75": cut(c, 0.75),
                "max": shown(F.max(c)),
            }
            for c in NUMBER_COLUMNS
        },
        "column",
    )


def top_categories(df: DataFrame, limit: int = 10) -> DataFrame:
    """The most frequent values of each category column; equal counts go by value.

    The rank is limited before the shuffle, so a long value list sends ``limit`` rows per task.
    """
    counts = category_counts(df, CATEGORY_COLUMNS)
    order = Window.partitionBy("column").orderBy(F.desc("rows"), "value")
    ranked = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit)
    return ranked.select("column", "value", F.col("rows").alias("count")).orderBy(
        "column", F.desc("count"), "value"
    )


def monthly_incidents(df: DataFrame) -> DataFrame:
    """Incidents per month end from the first to the last month, empty months as zero."""
    per_month = df.groupBy(F.last_day(INCIDENT_DATE).alias("month_end")).agg(
        F.count(F.lit(1)).alias("incidents")
    )
    span = per_month.agg(
        F.trunc(F.min("month_end"), "month").alias("first"),
        F.trunc(F.max("month_end"), "month").alias("last"),
    )
    months = span.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("month")
    ).select(F.last_day("month").alias("month_end"))
    joined = months.join(per_month, "month_end", "left")
    return joined.select(
        "month_end", F.coalesce("incidents", F.lit(0).cast("long")).alias("incident_count")
    ).orderBy("month_end")


def severity_histogram(df: DataFrame, bins: int = 10) -> DataFrame:
    """Equal-width bins between the extremes, the last one closed; empty bins as zero.

    Equal extremes are widened by a half to each side.
    """
    df = _folded(df)
    ends = df.agg(F.min("severity_score").alias("low"), F.max("severity_score").alias("high")).first()
    low, high = ends["low"], ends["high"]
    if low is None:
        raise ValueError("No severity scores to count.")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    number = F.least(F.width_bucket("severity_score", F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    counts = df.where(F.col("severity_score").isNotNull()).groupBy(number.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    edges = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    return (
        edges.join(F.broadcast(counts), "bin", "left")
        .select(
            F.col("bin").cast("int").alias("bin"),
            (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("lower_edge"),
            (F.lit(low) + F.col("bin") * F.lit(width)).alias("upper_edge"),
            F.coalesce("rows", F.lit(0).cast("long")).alias("incidents"),
        )
        .orderBy("bin")
    )


def money_totals(df: DataFrame) -> DataFrame:
    return _long(_folded(df), {c: {"total_usd": F.sum(c)} for c in MONEY_COLUMNS}, "column")


def flag_rates(df: DataFrame) -> DataFrame:
    """Share of true values in percent."""
    rates = {
        c: {"true_rate_percent": F.round(F.avg(F.col(c).cast("int").cast("double")) * 100, 2)}
        for c in FLAG_COLUMNS
    }
    return _long(df, rates, "column")


#: A shift is too far off if its distance from a mean is over so many deviations: digits would be lost.
_FAR = 1e4


def correlations(df: DataFrame, shifts: dict[str, float] | None = None) -> DataFrame:
    """Pearson correlation of every two number columns, rounded; NULL for a constant column.

    One scan sums the products of distances from a ``shift`` per column, such as a stored median (by
    default one of its values), which is as exact as running moments and much cheaper. Only if a column has
    gaps, or a shift proves to be far from all values, a second scan follows: with the means that the
    first one found, and over the rows where both values of a pair are present.
    """
    columns, df = NUMBER_COLUMNS, _folded(df)
    if shifts is None:
        row = df.select(*columns).first()
        shifts = {c: (row[c] if row is not None and row[c] is not None else 0.0) for c in columns}
    away = {c: F.col(c) - F.lit(float(shifts[c])) for c in columns}
    sums = measure(
        df,
        {
            "rows": F.count(F.lit(1)),
            **{f"n:{c}": F.count(c) for c in columns},
            **{f"sum:{c}": F.sum(away[c]) for c in columns},
            **{f"{a}|{b}": F.sum(away[a] * away[b]) for a, b in combinations_with_replacement(columns, 2)},
            **{f"varies:{c}": F.min(c) < F.max(c) for c in columns},
        },
    )
    n, whole = sums["rows"], all(sums[f"n:{c}"] == sums["rows"] for c in columns)
    spread = {c: sums[f"{c}|{c}"] - sums[f"sum:{c}"] ** 2 / n if whole and n else 0.0 for c in columns}
    near = whole and all(
        not sums[f"varies:{c}"] or (sums[f"sum:{c}"] / n) ** 2 * n <= _FAR**2 * spread[c] for c in columns
    )
    varies = {c: sums[f"varies:{c}"] for c in columns}
    if near:
        wanted = {
            (a, b): F.lit(
                (sums[f"{a}|{b}"] - sums[f"sum:{a}"] * sums[f"sum:{b}"] / n) / (math.sqrt(spread[a]) * math.sqrt(spread[b]))
                if varies[a] and varies[b] else None
            ).cast("double")
            for a, b in combinations(columns, 2)
        }
        df = df.sparkSession.range(1)
    else:
        means = {c: shifts[c] + (sums[f"sum:{c}"] or 0.0) / max(1, sums[f"n:{c}"]) for c in columns}
        away = {c: F.col(c) - F.lit(means[c]) for c in columns}
        wanted = {
            (a, b): _correlation_of_present(F.col(a), F.col(b), away[a], away[b])
            if varies[a] and varies[b] else F.lit(None).cast("double")
            for a, b in combinations(columns, 2)
        }
    for c in columns:
        wanted[c, c] = F.lit(1.0 if varies[c] else None).cast("double")
    shown = [round_half_even(v, 2).alias(f"{a}|{b}") for (a, b), v in wanted.items()]
    row = df.select(*shown) if near else df.agg(*shown)
    entries = []
    for a in columns:
        for b in columns:
            held = f"`{a}|{b}`" if (a, b) in wanted else f"`{b}|{a}`"
            entries.append(
                F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(held).alias("r"))
            )
    return row.select(F.inline(F.array(*entries)))


def _correlation_of_present(a: Column, b: Column, away_a: Column, away_b: Column) -> Column:
    both = a.isNotNull() & b.isNotNull()

    def total(value: Column) -> Column:
        return F.sum(F.when(both, value))

    n = F.nullif(F.count_if(both).cast("double"), F.lit(0.0))
    shared = total(away_a * away_b) - total(away_a) * total(away_b) / n
    square_a = total(away_a * away_a) - total(away_a) * total(away_a) / n
    square_b = total(away_b * away_b) - total(away_b) * total(away_b) / n
    varies = (F.min(F.when(both, a)) < F.max(F.when(both, a))) & (
        F.min(F.when(both, b)) < F.max(F.when(both, b))
    )
    return F.when(varies, shared / F.nullif(F.sqrt(square_a) * F.sqrt(square_b), F.lit(0.0)))


def incident_profile(df: DataFrame) -> dict[str, DataFrame]:
    """All parts of the profile of a clean table, after the input checks."""
    check_profile_input(df)
    return {
        "column_quality": column_quality(df),
        "numbers": describe_numbers(df),
        "top_categories": top_categories(df),
        "monthly_incidents": monthly_incidents(df),
        "severity_histogram": severity_histogram(df),
        "money_totals": money_totals(df),
        "flag_rates": flag_rates(df),
        "correlations": correlations(df),
    }
