"""What fits share: rows kept while an algorithm iterates, and draws that follow a record's key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from fieldbook.functions import key_hash


def key_uniform(
    keys: Sequence[Column | str], seed: int, draw: int, algorithm: str = "xxhash64"
) -> Column:
    """A number in [0, 1) for a record and a numbered draw.

    It follows from the key alone: whatever is drawn so is the same under any storage
    layout, partitioning and number of cores.
    """
    hashed = key_hash([*keys, F.lit(draw)], seed, algorithm)
    if algorithm == "md5":
        bits = F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double")
    else:
        bits = F.shiftrightunsigned(hashed, 12).cast("double")
    return bits / F.lit(float(1 << 52))


def spread(frame: DataFrame) -> DataFrame:
    """The frame in at least as many partitions as there are cores; more stay as they are."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame


@contextmanager
def kept_for_iteration(frame: DataFrame) -> Iterator[DataFrame]:
    """Persist a frame, as it is partitioned, for a block of repeated passes."""
    kept = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
