"""Small tables: driver rows as local relations, and aggregates of measured size.

Driver rows go through Arrow, which gives Spark a local relation of known size; a frame
made from Python rows would be a scan through Python workers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A frame of a few result rows."""
    names = StructType.fromDDL(schema).names
    columns = {name: pa.array([row[i] for row in rows]) for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns), schema)


_HELD: list[list[DataFrame]] = []


def settled(frame: DataFrame) -> DataFrame:
    """Compute an aggregate now and keep it, so that its size is known.

    Before it runs, an aggregate over a large table looks large to the planner, which
    would shuffle that table by the group key to join them: for a handful of groups, a
    few huge partitions.  Kept, it has a measured size: below the planner's threshold it
    is broadcast, above it joined by shuffle, which adaptive execution splits where it is
    skewed.  No row passes the driver; a lost executor's part is computed again.

    Inside :func:`holding` it is kept until the block ends.
    """
    held = frame.persist()
    held.count()
    if _HELD:
        _HELD[-1].append(held)
    return held


@contextmanager
def holding() -> Iterator[None]:
    """Release what is settled inside the block when it ends."""
    _HELD.append([])
    try:
        yield
    finally:
        for frame in _HELD.pop():
            frame.unpersist()
