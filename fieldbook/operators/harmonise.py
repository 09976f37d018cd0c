"""Typed analytical columns appended to text-typed raw records, driven by rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import (
    MISSING_TOKENS,
    UNKNOWN_LABEL,
    duration_in_years,
    label_for,
    normalized_code,
    parse_number,
)


@dataclass(frozen=True)
class CodeRule:
    """A coded source column: where its clean code goes, and optionally its label."""

    source: str
    code: str
    label: str | None = None
    labels: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class DurationRule:
    """A duration in years built from two parsed numeric columns."""

    target: str
    years: str
    months: str


@dataclass(frozen=True)
class HarmoniseRules:
    """``numbers`` maps each new numeric column to the raw column it is parsed from."""

    numbers: Mapping[str, str]
    codes: Sequence[CodeRule] = ()
    durations: Sequence[DurationRule] = ()
    missing_tokens: Sequence[str] = MISSING_TOKENS
    unknown_label: str = UNKNOWN_LABEL

    def targets(self) -> list[str]:
        names = [*self.numbers]
        names += [rule.code for rule in self.codes]
        names += [rule.label for rule in self.codes if rule.label]
        names += [rule.target for rule in self.durations]
        return names


def harmonise(raw: DataFrame, rules: HarmoniseRules) -> DataFrame:
    """Keep every raw column and append the typed ones.

    A target that differs from a raw column only by case would silently replace it
    under Spark's case-insensitive names, so that is an error.
    """
    taken = {name.lower() for name in raw.columns}
    clashes = sorted(name for name in rules.targets() if name.lower() in taken)
    if clashes:
        raise ValueError(f"harmonised columns would replace raw ones: {clashes}")

    parsed = {
        target: parse_number(source, rules.missing_tokens)
        for target, source in rules.numbers.items()
    }
    parsed.update({rule.code: normalized_code(rule.source) for rule in rules.codes})
    derived = {
        rule.label: label_for(rule.code, rule.labels, rules.unknown_label)
        for rule in rules.codes
        if rule.label
    }
    derived.update(
        {rule.target: duration_in_years(rule.years, rule.months) for rule in rules.durations}
    )
    typed = raw.select("*", *[column.alias(name) for name, column in parsed.items()])
    return typed.select("*", *[column.alias(name) for name, column in derived.items()])


def with_provenance(frame: DataFrame, **values: object) -> DataFrame:
    """Attach constant provenance columns (source name, period, year, quarter...)."""
    return frame.withColumns({name: F.lit(value) for name, value in values.items()})
