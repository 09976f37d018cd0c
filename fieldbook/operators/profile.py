"""Descriptive tables: numeric profiles, category shares, grouped medians."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import percent_of, position_in

from .quantiles import DEFAULT_ACCURACY, exact_column_quantiles, quantiles

PROFILE_QUANTILES: Mapping[str, float] = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def _stacked_categories(
    frame: DataFrame, columns: Sequence[str], kept: Sequence[str] = ()
) -> DataFrame:
    texts = frame.select(*kept, *[F.col(name).cast("string").alias(name) for name in columns])
    return texts.unpivot(list(kept), list(columns), "variable", "category")


def _with_quantiles(
    summary: DataFrame,
    frame: DataFrame,
    value: str,
    by: Sequence[str],
    probs: Mapping[str, float],
    exact: bool,
    accuracy: int,
) -> DataFrame:
    found = quantiles(frame, value, probs, by, exact=exact, accuracy=accuracy)
    renamed = found.select(
        *[F.col(name).alias(f"__key_{i}") for i, name in enumerate(by)], *probs
    )
    matches = [F.col(name).eqNullSafe(F.col(f"__key_{i}")) for i, name in enumerate(by)]
    return summary.join(renamed, matches, "left").drop(*[f"__key_{i}" for i in range(len(by))])


def _summary(
    frame: DataFrame,
    value: str,
    by: Sequence[str],
    measures: Mapping[str, Column],
    probs: Mapping[str, float],
    exact: bool,
    accuracy: int,
) -> DataFrame:
    """Measures and quantiles per group; the sketch form needs a single aggregate."""
    plain = [column.alias(name) for name, column in measures.items()]
    if exact:
        summary = frame.groupBy(*by).agg(*plain)
        return _with_quantiles(summary, frame, value, by, probs, exact, accuracy)
    number = F.col(value).cast("double")
    sketch = F.percentile_approx(
        F.when(~F.isnan(number), number),
        F.array(*[F.lit(p) for p in probs.values()]),
        F.lit(accuracy),
    )
    summary = frame.groupBy(*by).agg(*plain, sketch.alias("__q"))
    return summary.select(
        *by, *measures, *[F.col("__q")[i].alias(name) for i, name in enumerate(probs)]
    )


def numeric_profile(
    frame: DataFrame,
    columns: Sequence[str],
    exact: bool = False,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """n, mean, median, sample deviation, extremes and P25/P75/P95 of each column.

    All the columns are profiled side by side in one aggregate, in the order given.
    """
    numbers = frame.select(*[F.col(name).cast("double").alias(f"__v{i}") for i, name in enumerate(columns)])
    measures = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if not exact:
        shares = F.array(*[F.lit(p) for p in PROFILE_QUANTILES.values()])
        measures["quantiles"] = lambda v: F.percentile_approx(
            F.when(~F.isnan(v), F.col(v)), shares, F.lit(accuracy)
        )
    totals = numbers.agg(
        F.count("*").alias("__rows"),
        *[build(f"__v{i}").alias(f"{name}__{i}") for i in range(len(columns)) for name, build in measures.items()],
    )
    lines = [
        F.struct(F.lit(column).alias("variable"), *[F.col(f"{name}__{i}").alias(name) for name in measures])
        for i, column in enumerate(columns)
    ]
    # A frame without rows has no profile.
    table = totals.filter("__rows > 0").select(F.inline(F.array(*lines)))
    if exact:
        ranks = exact_column_quantiles(frame, columns, PROFILE_QUANTILES, accuracy)
        table = table.join(ranks, "variable", "left")
    else:
        table = table.select(
            "*", *[F.col("quantiles")[i].alias(name) for i, name in enumerate(PROFILE_QUANTILES)]
        )
    shown = ["variable", "n", "mean", "median", "std", "min", "p25", "p75", "p95", "max"]
    return table.orderBy(position_in("variable", columns)).select(*shown)


def skew_reading(profile: DataFrame) -> DataFrame:
    """Which way each profiled variable leans: mean against median."""
    mean, median = F.col("mean"), F.col("median")
    reading = (
        F.when(mean > median, "positive").when(mean < median, "negative").when(
            mean == median, "symmetric"
        )
    )
    return profile.select("variable", "mean", "median", reading.alias("skew"))


def category_distribution(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(variable, category, n, pct)`` for several columns in one scan; null counts too.

    The totals are summed from the category counts.  They have one row per column asked
    for, which bounds what the join broadcasts.
    """
    counts = (
        _stacked_categories(frame, columns)
        .groupBy("variable", "category")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("variable").agg(F.sum("n").alias("__total"))
    return (
        counts.join(F.broadcast(totals), "variable")
        .select("variable", "category", "n", percent_of("n", "__total").alias("pct"))
        .orderBy(position_in("variable", columns), F.desc("n"), "category")
    )


def median_by_group(
    frame: DataFrame,
    groups: Sequence[str],
    value: str,
    exact: bool = False,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """``(variable, category, n, median, mean)`` of a value, highest median first."""
    stacked = _stacked_categories(frame, groups, kept=[value])
    table = _summary(
        stacked,
        value,
        ["variable", "category"],
        {"n": F.count("*"), "mean": F.avg(value)},
        {"median": 0.5},
        exact,
        accuracy,
    )
    return table.orderBy(
        position_in("variable", groups), F.desc("median"), "category"
    ).select("variable", "category", "n", "median", "mean")


def period_summary(
    frame: DataFrame,
    period: str,
    value: str,
    exact: bool = False,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """``(period, n, median, mean)`` of a value, in period order."""
    table = _summary(
        frame,
        value,
        [period],
        {"n": F.count("*"), "mean": F.avg(value)},
        {"median": 0.5},
        exact,
        accuracy,
    )
    return table.orderBy(period).select(period, "n", "median", "mean")
