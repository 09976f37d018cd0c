"""Row fingerprints and seeded key hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _column


def canonical_text(columns: Sequence[Column | str]) -> Column:
    """One text per row that two rows share only if all the columns are equal.

    Each value is written as ``<length>:<text>`` and null as ``~``, so neither a
    separator nor a placeholder inside the data can make different rows look alike.
    """
    parts = []
    for column in columns:
        text = _column(column).cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))
        )
    return F.concat(*parts) if parts else F.lit("")


def row_fingerprint(columns: Sequence[Column | str]) -> Column:
    """SHA-256 of the whole row, as hex text."""
    return F.sha2(canonical_text(columns), 256)


def row_digest(columns: Sequence[Column | str]) -> tuple[Column, Column]:
    """A 128-bit row digest as two longs, cheap to keep in hash-aggregate buffers.

    Null flags are hashed too, since ``xxhash64`` skips nulls.
    """
    values = [_column(column) for column in columns]
    flags = [value.isNull() for value in values]
    return (
        F.xxhash64(F.lit(1), *values, *flags),
        F.xxhash64(F.lit(2), *flags, *values),
    )


def key_hash(keys: Sequence[Column | str], seed: int, algorithm: str = "xxhash64") -> Column:
    """Seeded hash of a record key: a long for ``xxhash64``, hex text for ``md5``.

    It depends on the key alone, so an order by it is the same under any partitioning.
    """
    if algorithm == "xxhash64":
        return F.xxhash64(*[_column(key) for key in keys], F.lit(seed))
    if algorithm == "md5":
        return F.md5(canonical_text([*keys, F.lit(seed)]))
    raise ValueError(f"unknown hash algorithm {algorithm!r}")
