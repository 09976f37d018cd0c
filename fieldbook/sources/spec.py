"""What a source file promises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class SourceSpec:
    """Contract of one period's source: where it is and what it must contain."""

    path: str
    period: str
    expected_rows: int
    expected_columns: int
    format: str = "csv"
    options: Mapping[str, str] = field(default_factory=dict)
    provenance: Mapping[str, object] = field(default_factory=dict)

    @property
    def file_name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]


def text_schema(columns: Sequence[str]) -> StructType:
    """Every column a nullable string, so that no period infers types of its own."""
    return StructType([StructField(name, StringType(), True) for name in columns])
