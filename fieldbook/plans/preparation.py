"""Raw text records to an audited, eligible, typed table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fieldbook.operators.audit import counts_by_period, duplicate_keys, missingness
from fieldbook.operators.funnel import (
    Criterion,
    exclusion_audit,
    observed_survivors,
    passes,
)
from fieldbook.operators.harmonise import HarmoniseRules, harmonise
from fieldbook.sources.tables import write_by_period


@dataclass(frozen=True)
class Preparation:
    """Lazy tables of one preparation; nothing runs until one of them is used."""

    harmonised: DataFrame
    criteria: Sequence[Criterion]
    period: str
    funnel: DataFrame
    by_period: DataFrame
    missing: DataFrame
    duplicates: DataFrame

    @property
    def eligible(self) -> DataFrame:
        return observed_survivors(self.harmonised, self.criteria)

    def write(self, path: str) -> DataFrame:
        """Store the eligible rows by period and return the audit, counted from the data.

        Counting along with the writing would count rows again when tasks are repeated
        after a lost executor, so the audit is a pass of its own.

        Work on the stored table from then on: its columns are typed, so filters reach
        the scan and text is not parsed again.
        """
        write_by_period(self.eligible, path, self.period)
        return exclusion_audit(self.harmonised, self.criteria)


def prepare(
    raw: DataFrame,
    rules: HarmoniseRules,
    criteria: Sequence[Criterion],
    keys: Sequence[str],
    period: str,
    audited: Sequence[str],
) -> Preparation:
    """Harmonise, filter and describe what the filters did."""
    harmonised = harmonise(raw, rules)
    return Preparation(
        harmonised=harmonised,
        criteria=criteria,
        period=period,
        funnel=exclusion_audit(harmonised, criteria),
        by_period=counts_by_period(harmonised, period, passes(criteria)),
        missing=missingness(raw, audited),
        duplicates=duplicate_keys(raw, keys),
    )
