"""Pearson correlations as long tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pearson_matrix(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(var_a, var_b, r)`` for every ordered pair, over rows complete in all columns.

    Each unordered pair is one ``corr`` in a single global aggregate.
    """
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in columns])
    pairs = list(combinations(columns, 2))
    measured = frame.filter(complete).agg(
        *[F.corr(a, b).alias(f"__r_{i}") for i, (a, b) in enumerate(pairs)]
    )
    by_pair = {frozenset(pair): F.col(f"__r_{i}") for i, pair in enumerate(pairs)}
    lines = [
        F.struct(
            F.lit(a).alias("var_a"),
            F.lit(b).alias("var_b"),
            (F.lit(1.0) if a == b else by_pair[frozenset((a, b))]).alias("r"),
        )
        for a in columns
        for b in columns
    ]
    return measured.select(F.inline(F.array(*lines)))


def correlation_rank(matrix: DataFrame, target: str) -> DataFrame:
    """``(variable, r, abs_r)``: the other variables, strongest with the target first."""
    return (
        matrix.filter((F.col("var_a") == target) & (F.col("var_b") != target))
        .select(F.col("var_b").alias("variable"), "r", F.abs("r").alias("abs_r"))
        .orderBy(F.desc("abs_r"), "variable")
    )
