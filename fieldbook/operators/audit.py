"""Data-quality audits: missingness, counts, duplicate keys, observed codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import (
    MISSING_TOKENS,
    is_missing,
    normalized_code,
    percent_of,
    row_digest,
)


def missingness(
    frame: DataFrame,
    columns: Sequence[str],
    tokens: Sequence[str] = MISSING_TOKENS,
) -> DataFrame:
    """``(variable, missing, missing_pct)``, worst first, from one aggregate.

    The percentage is null when the frame is empty.
    """
    counts = frame.agg(
        F.count("*").alias("__rows"),
        *[
            F.count_if(is_missing(name, tokens)).alias(f"__missing_{i}")
            for i, name in enumerate(columns)
        ],
    )
    lines = [
        F.struct(
            F.lit(name).alias("variable"),
            F.col(f"__missing_{i}").alias("missing"),
            percent_of(f"__missing_{i}", "__rows").alias("missing_pct"),
        )
        for i, name in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*lines))).orderBy(F.desc("missing_pct"), "variable")


def _with_retention(counts: DataFrame) -> DataFrame:
    return counts.withColumns(
        {
            "excluded": F.col("before") - F.col("after"),
            "retention_pct": percent_of("after", "before"),
        }
    )


def counts_by_period(frame: DataFrame, period: str, eligible: Column) -> DataFrame:
    """``(period, before, after, excluded, retention_pct)`` from one scan.

    ``eligible`` says which rows survive.  Periods without survivors keep 0 and a null
    period is a group of its own.
    """
    counts = frame.groupBy(period).agg(
        F.count("*").alias("before"), F.count_if(eligible).alias("after")
    )
    return _with_retention(counts).orderBy(period)


def compare_counts(before: DataFrame, after: DataFrame, period: str) -> DataFrame:
    """The same table when survivors come as a frame of their own.

    Both sides are counted first, so what is joined is one row per period.
    """
    earlier = before.groupBy(period).agg(F.count("*").alias("before"))
    later = after.groupBy(F.col(period).alias("__period")).agg(F.count("*").alias("after"))
    joined = earlier.join(later, F.col(period).eqNullSafe(F.col("__period")), "left")
    return _with_retention(joined.drop("__period").fillna(0, ["after"])).orderBy(period)


def retention_total(counts: DataFrame) -> DataFrame:
    """Totals over periods of a :func:`counts_by_period` table."""
    totals = counts.agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    return _with_retention(totals)


def duplicate_keys(
    frame: DataFrame, keys: Sequence[str], payload: Sequence[str] | None = None
) -> DataFrame:
    """One row: duplicate groups, rows in them, exact repeats, conflicting groups.

    Nothing is dropped.  A group conflicts when its rows differ in any payload column
    (by default every non-key column).  Instead of collecting the distinct versions of
    a key, each group keeps the least and greatest row digest: they are equal exactly
    when there is one version.  That needs one shuffle of pre-aggregated rows and a
    fixed-size buffer, so a key that holds a large share of the rows costs nothing extra.
    """
    columns = [name for name in frame.columns if name not in keys] if payload is None else payload
    first, second = row_digest(columns)
    digested = frame.select(*keys, first.alias("__d1"), second.alias("__d2"))
    groups = (
        digested.groupBy(*keys)
        .agg(
            F.count("*").alias("__n"),
            *[F.min(name).alias(f"{name}_min") for name in ("__d1", "__d2")],
            *[F.max(name).alias(f"{name}_max") for name in ("__d1", "__d2")],
        )
        .filter(F.col("__n") > 1)
    )
    same = (F.col("__d1_min") == F.col("__d1_max")) & (F.col("__d2_min") == F.col("__d2_max"))
    return groups.agg(
        F.count("*").alias("duplicate_groups"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_involved"),
        F.count_if(same).alias("exact_repeat_groups"),
        F.count_if(~same).alias("conflicting_groups"),
    )


def key_uniqueness(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``(rows, distinct_keys, is_unique)``; keys with nulls count as keys."""
    groups = frame.groupBy(*keys).agg(F.count("*").alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_keys")
    ).withColumn("is_unique", F.col("rows") == F.col("distinct_keys"))


def check_unique_keys(frame: DataFrame, keys: Sequence[str], name: str) -> int:
    """Number of rows; raises when a key is repeated."""
    found = key_uniqueness(frame, keys).first()
    if not found["is_unique"]:
        raise ValueError(
            f"{name}: {found['rows']} rows but {found['distinct_keys']} distinct keys"
        )
    return found["rows"]


def observed_codes(frame: DataFrame, period: str, code: str) -> DataFrame:
    """``(period, code, n)``: which normalised codes each period really carries."""
    codes = frame.select(F.col(period), normalized_code(code).alias(code))
    return codes.groupBy(period, code).agg(F.count("*").alias("n")).orderBy(period, code)


def row_conservation(
    test: DataFrame,
    predictions: DataFrame,
    keys: Sequence[str],
    models: Mapping[str, str],
) -> DataFrame:
    """``(dataset, rows)``: test rows, scored rows per model, shared rows, shared keys.

    ``models`` maps a model id to its prediction column.  All the counts over the
    predictions come from one aggregate over their key groups.
    """
    groups = predictions.groupBy(*keys).agg(
        F.count("*").alias("__n"),
        *[F.count(column).alias(f"__scored_{i}") for i, column in enumerate(models.values())],
    )
    counted = groups.agg(
        *[
            F.coalesce(F.sum(f"__scored_{i}"), F.lit(0)).alias(f"__scored_{i}")
            for i in range(len(models))
        ],
        F.coalesce(F.sum("__n"), F.lit(0)).alias("__shared"),
        F.count("*").alias("__keys"),
    )
    lines = [
        *[(f"predictions {model}", f"__scored_{i}") for i, model in enumerate(models)],
        ("shared rows", "__shared"),
        ("distinct shared keys", "__keys"),
    ]
    scored = counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(label).alias("dataset"), F.col(column).alias("rows"))
                    for label, column in lines
                ]
            )
        )
    )
    eligible = test.agg(F.count("*").alias("rows")).select(
        F.lit("eligible test").alias("dataset"), "rows"
    )
    return eligible.unionByName(scored)


def check_conservation(counts: DataFrame) -> int:
    """The shared row count; raises unless every line of the table agrees."""
    found = counts.agg(F.min("rows").alias("low"), F.max("rows").alias("high")).first()
    if found["low"] != found["high"]:
        raise ValueError(f"models were not scored on the same rows: {counts.collect()}")
    return found["low"]
