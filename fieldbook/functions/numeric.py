"""Numeric column builders: finiteness, ratios, bands, residuals and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _column

# Wording of the bias direction.
UNDERESTIMATES = "subestima"
OVERESTIMATES = "sobreestima"
NO_BIAS = "no presenta sesgo medio"


def is_finite(value: Column | str) -> Column:
    """False for null, NaN and infinities, never null.

    NaN is the greatest double in Spark's order, so one comparison rules out both.
    """
    return F.coalesce(F.abs(_column(value)) < F.lit(float("inf")), F.lit(False))


def ordered_bits(value: Column | str) -> Column:
    """The bits of a double as a long that grows with it; null for null and NaN.

    Put together from exponent and mantissa, which powers of two scale without rounding.
    Zeros of either sign are 0, and a negative number has the negated bits of its size.
    """
    number = _column(value).cast("double")
    size = F.abs(number)
    near = F.floor(F.log2(size)).cast("int")
    exponent = near + F.when(F.pow(F.lit(2.0), near + 1) <= size, 1).when(
        F.pow(F.lit(2.0), near) > size, -1
    ).otherwise(0)
    unit = F.lit(1 << 52).cast("long")
    # Below the least normal double the bits are the multiple of the least subnormal one.
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    mantissa = (size / F.pow(F.lit(2.0), exponent) * F.lit(2.0**52)).cast("long")
    bits = (
        F.when(size == float("inf"), unit * 2047)
        .when(size < F.lit(2.0**-1022), tiny)
        .otherwise((exponent + 1022).cast("long") * unit + mantissa)
    )
    return F.when(~F.isnan(number), F.when(number < 0, -bits).otherwise(bits))


def duration_in_years(years: Column | str, months: Column | str) -> Column:
    """Years plus months as a fraction of twelve; null if either part is null."""
    return _column(years) + _column(months) / F.lit(12.0)


def percent_of(part: Column | str, whole: Column | str) -> Column:
    """``100 * part / whole``; null when the whole is zero."""
    return F.try_divide(F.lit(100.0) * _column(part), _column(whole))


def percent_below(value: Column | str, reference: Column | str) -> Column:
    """How far ``value`` lies below ``reference``, in percent of ``reference``."""
    return percent_of(_column(reference) - _column(value), reference)


def residual(actual: Column | str, predicted: Column | str) -> Column:
    """``actual - predicted``: positive means the model underestimates."""
    return _column(actual) - _column(predicted)


def bias_direction(mean_residual: Column | str) -> Column:
    """Three-way reading of a mean residual; null stays null."""
    value = _column(mean_residual)
    return (
        F.when(value > 0, UNDERESTIMATES).when(value < 0, OVERESTIMATES).when(value == 0, NO_BIAS)
    )


def underestimated_share(residuals: Column) -> Column:
    """Aggregate: fraction of rows with a positive residual."""
    return F.avg((residuals > 0).cast("double"))


def right_closed_band(
    value: Column | str, cuts: Sequence[float], labels: Sequence[str]
) -> Column:
    """Label of the first interval ``(previous, cut]`` holding the value.

    The last label is open above.  Null and NaN get a null band instead of falling
    into the top one.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("one more label than cuts is needed")
    number = _column(value).cast("double")
    band = F.when(number.isNull() | F.isnan(number), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        band = band.when(number <= F.lit(float(cut)), F.lit(label))
    return band.otherwise(F.lit(labels[-1]))


def position_in(value: Column | str, order: Sequence[str]) -> Column:
    """Sort rank in a custom category order; unlisted and null values come last."""
    ranks = [F.lit(part) for i, name in enumerate(order) for part in (name, i)]
    return F.coalesce(F.create_map(*ranks)[_column(value)], F.lit(len(order)))


def relation_text(value: Column, reference: Column, name: str, high: str, low: str) -> Column:
    """``"<name> <high>"`` when the value reaches the reference, else ``"<name> <low>"``."""
    return F.when(value >= reference, F.lit(f"{name} {high}")).when(
        value < reference, F.lit(f"{name} {low}")
    )
