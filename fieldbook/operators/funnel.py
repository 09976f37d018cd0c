"""Ordered exclusion criteria: survivors, and an audit of what each step removed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Criterion(NamedTuple):
    """A named predicate. A row for which it is null fails it."""

    label: str
    keep: Column


def passes(criteria: Sequence[Criterion]) -> Column:
    """True when every criterion holds, false otherwise; never null."""
    held = reduce(lambda left, right: left & right, [rule.keep for rule in criteria])
    return F.coalesce(held, F.lit(False))


def failed_step(criteria: Sequence[Criterion]) -> Column:
    """Number (from 1) of the first criterion a row fails, one past the last if none.

    The ``CASE`` stops at the first failure, so a row is charged to exactly one step
    and later predicates are not evaluated for it.
    """
    first = F.when(~F.coalesce(criteria[0].keep, F.lit(False)), 1)
    for step, rule in enumerate(criteria[1:], start=2):
        first = first.when(~F.coalesce(rule.keep, F.lit(False)), step)
    return first.otherwise(len(criteria) + 1)


def survivors(frame: DataFrame, criteria: Sequence[Criterion]) -> DataFrame:
    """Rows that meet all the criteria, as one filter that Spark may push to the scan.

    Right for typed, stored columns.  When the columns are parsed from text in the same
    query, pushing the filter repeats the parsing inside it: use
    :func:`observed_survivors` there.
    """
    return frame.filter(reduce(lambda left, right: left & right, [r.keep for r in criteria]))


def observed_survivors(frame: DataFrame, criteria: Sequence[Criterion]) -> DataFrame:
    """The same rows; what the criteria read is computed below the filter, and only there.

    An observation keeps the filter from being pushed into the parsing.  Its figure is not
    used: tasks that run again would be counted again.  Audit with :func:`exclusion_audit`.
    """
    tagged = frame.withColumn("__step", failed_step(criteria))
    return (
        tagged.observe(Observation(), F.count("*").alias("__seen"))
        .filter(F.col("__step") > len(criteria))
        .drop("__step")
    )


def exclusion_audit(
    frame: DataFrame, criteria: Sequence[Criterion], input_label: str = "input"
) -> DataFrame:
    """``(step, criterion, before, excluded, after)`` with step 0 for the input.

    One scan and one global aggregate whatever the number of steps; the rows of the
    audit are unfolded from that single result row.
    """
    reached = frame.select(failed_step(criteria).alias("__step"))
    return _audit_lines(reached.agg(*_step_counts(len(criteria))), criteria, input_label)


def _step_counts(steps: int) -> list[Column]:
    """How many rows pass the first ``k`` criteria, for each ``k`` from 0."""
    return [
        F.count("*").alias("__after_0"),
        *[
            F.count_if(F.col("__step") > step).alias(f"__after_{step}")
            for step in range(1, steps + 1)
        ],
    ]


def _audit_lines(
    counts: DataFrame, criteria: Sequence[Criterion], input_label: str
) -> DataFrame:
    lines = [
        _audit_line(step, label, f"__after_{max(step - 1, 0)}", f"__after_{step}")
        for step, label in enumerate([input_label, *[rule.label for rule in criteria]])
    ]
    return counts.select(F.inline(F.array(*lines))).orderBy("step")


def _audit_line(step: int, label: str, before: str, after: str) -> Column:
    return F.struct(
        F.lit(step).alias("step"),
        F.lit(label).alias("criterion"),
        F.col(before).alias("before"),
        (F.col(before) - F.col(after)).alias("excluded"),
        F.col(after).alias("after"),
    )
