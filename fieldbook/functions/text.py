"""Column builders that turn text-typed microdata into codes, numbers and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings of "no answer", compared after trimming and upper-casing.
MISSING_TOKENS = ("", "NA", "N/A", "NAN", "NULL")
# Fixed value: label given to codes that are null or not in the dictionary.
UNKNOWN_LABEL = "DESCONOCIDO"
# Fixed value: the decimals a whole code may carry.
ZERO_DECIMALS = r"\.0+$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    """Text form without surrounding blanks; null stays null, empty stays empty."""
    return F.trim(_column(value).cast("string"))


def is_missing(value: Column | str, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """True for null and for any missing token, whatever its case. Never null."""
    text = F.upper(trimmed(value))
    return text.isNull() | text.isin(*tokens)


def normalized_code(value: Column | str) -> Column:
    """Trim and drop a trailing ``.0``, ``.00``...: ``2.00`` becomes ``2``, ``1.50`` stays."""
    return F.regexp_replace(trimmed(value), ZERO_DECIMALS, "")


def parse_number(value: Column | str, tokens: Sequence[str] = MISSING_TOKENS) -> Column:
    """Tolerant double: ignores blanks and thousands commas; malformed text gives null.

    A token that is not a number fails the cast and needs no test of its own, and NaN
    is one function over the parsed value, so the text is prepared once per row.  The
    cast accepts ``Infinity`` and a trailing ``d`` as Java's parser does; see
    :func:`~fieldbook.functions.numeric.is_finite`.
    """
    text = F.replace(_column(value).cast("string"), F.lit(","), F.lit(""))
    number = text.try_cast("double")
    upper_tokens = {token.upper() for token in tokens}
    if "NAN" in upper_tokens:
        number = F.nanvl(number, F.lit(None).cast("double"))
    castable = sorted(t for t in upper_tokens if any(c.isdigit() for c in t) or "INF" in t)
    if castable:
        number = F.when(~F.upper(F.trim(text)).isin(*castable), number)
    return number


def label_for(
    code: Column | str, labels: Mapping[str, str], default: str = UNKNOWN_LABEL
) -> Column:
    """Dictionary lookup as a map literal, for dictionaries of a few dozen codes."""
    entries = [F.lit(part) for pair in labels.items() for part in pair]
    return F.coalesce(F.create_map(*entries)[_column(code)], F.lit(default))


def join_labels(
    frame: DataFrame,
    code: str,
    dictionary: DataFrame,
    target: str,
    default: str = UNKNOWN_LABEL,
) -> DataFrame:
    """The same lookup for a dictionary too large for a literal.

    ``dictionary`` has columns ``code`` and ``label`` with unique codes.  No broadcast
    hint: Spark broadcasts it only while its measured size is below the threshold.
    """
    lookup = dictionary.select(
        F.col("code").alias("__code"), F.col("label").alias("__label")
    )
    return (
        frame.join(lookup, F.col(code) == F.col("__code"), "left")
        .withColumn(target, F.coalesce("__label", F.lit(default)))
        .drop("__code", "__label")
    )
