"""Temporal train / validation / test splits by period membership."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN, VALIDATION, TEST, OUTSIDE = "train", "validation", "test", "outside"


@dataclass(frozen=True)
class TemporalSplit:
    """Which periods belong to which split; the three sets must not overlap."""

    train: Sequence[str]
    validation: Sequence[str]
    test: Sequence[str]
    period: str = "period"

    def __post_init__(self) -> None:
        for (name, left), (other, right) in combinations(self.members().items(), 2):
            shared = sorted(set(left) & set(right))
            if shared:
                raise ValueError(f"periods in both {name} and {other}: {shared}")

    def members(self) -> dict[str, Sequence[str]]:
        return {TRAIN: self.train, VALIDATION: self.validation, TEST: self.test}

    def select(self, frame: DataFrame, *names: str) -> DataFrame:
        """Rows of the named splits: a membership filter, so period partitions prune."""
        periods = [period for name in names for period in self.members()[name]]
        return frame.filter(F.col(self.period).isin(*periods))

    def label(self) -> Column:
        """Name of a row's split, null outside all of them."""
        column = F.lit(None).cast("string")
        for name, periods in self.members().items():
            column = F.when(F.col(self.period).isin(*periods), name).otherwise(column)
        return column


def split_counts(frame: DataFrame, split: TemporalSplit) -> DataFrame:
    """``(split, rows)`` in one aggregate; a split without rows is listed with 0.

    Rows of no split, those without a period among them, are counted as ``outside``.
    """
    tagged = frame.select(split.label().alias("__split"))
    counts = tagged.agg(
        *[F.count_if(F.col("__split") == name).alias(name) for name in split.members()],
        F.count_if(F.col("__split").isNull()).alias(OUTSIDE),
    )
    lines = [
        F.struct(F.lit(name).alias("split"), F.col(name).alias("rows"))
        for name in (*split.members(), OUTSIDE)
    ]
    return counts.select(F.inline(F.array(*lines)))


def check_split_coverage(frame: DataFrame, split: TemporalSplit) -> dict[str, int]:
    """Row count per split; raises if any split is empty."""
    counts = {row["split"]: row["rows"] for row in split_counts(frame, split).collect()}
    empty = sorted(name for name, rows in counts.items() if rows == 0 and name != OUTSIDE)
    if empty:
        raise ValueError(f"splits without rows: {empty}")
    return counts
