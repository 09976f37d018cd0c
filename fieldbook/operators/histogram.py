"""Equal-width and log-spaced histograms over all the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import is_finite


def histogram(frame: DataFrame, value: str, bins: int = 45) -> DataFrame:
    """``(bin, lower, upper, n)``: equal-width bins from the least to the greatest value.

    Bins are closed on the left, the last one on both sides, and empty bins are listed.
    Null, NaN and infinite values are left out.
    """
    numbers = frame.select(F.col(value).cast("double").alias("__x"))
    return _binned(numbers, bins).orderBy("bin")


def log_histogram(frame: DataFrame, value: str, bins: int = 44) -> DataFrame:
    """The same with bins of equal width in ``log10``; needs positive values.

    Bounds are returned on the original scale.
    """
    numbers = frame.select(F.col(value).cast("double").alias("__raw"))
    logs = numbers.filter(F.col("__raw") > 0).select(F.log10("__raw").alias("__x"))
    table = _binned(logs, bins)
    return table.select(
        "bin",
        F.pow(F.lit(10.0), "lower").alias("lower"),
        F.pow(F.lit(10.0), "upper").alias("upper"),
        "n",
    ).orderBy("bin")


def _binned(numbers: DataFrame, bins: int) -> DataFrame:
    finite = numbers.filter(is_finite("__x"))
    bounds = finite.agg(F.min("__x").alias("low"), F.max("__x").alias("high")).first()
    low, high = bounds["low"], bounds["high"]
    if low is not None and low == high:
        low, high = low - 0.5, high + 0.5
    start = F.lit(low).cast("double")
    span = F.lit(None if low is None else high - low).cast("double")
    position = F.floor((F.col("__x") - start) / span * F.lit(bins)) + 1
    counts = finite.groupBy(
        F.least(position, F.lit(bins).cast("long")).cast("int").alias("__bin")
    ).agg(F.count("*").alias("__n"))
    edges = _bin_numbers(numbers, bins).select(
        "bin",
        (start + (F.col("bin") - 1) * span / F.lit(bins)).alias("lower"),
        (start + F.col("bin") * span / F.lit(bins)).alias("upper"),
    )
    return edges.join(counts, F.col("bin") == F.col("__bin"), "left").select(
        "bin", "lower", "upper", F.coalesce("__n", F.lit(0)).alias("n")
    )


def _bin_numbers(frame: DataFrame, bins: int) -> DataFrame:
    """The bin numbers 1..bins as a one-column frame."""
    return frame.sparkSession.range(1, bins + 1, numPartitions=1).select(
        F.col("id").cast("int").alias("bin")
    )
