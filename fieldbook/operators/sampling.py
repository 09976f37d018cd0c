"""Samples that depend on record keys, not on partitioning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import key_hash, residual

# Fixed value: rows of a sample unless asked otherwise.
DEFAULT_SIZE = 5_000


def hash_sample(
    frame: DataFrame,
    keys: Sequence[str],
    size: int = DEFAULT_SIZE,
    seed: int = 42,
    algorithm: str = "xxhash64",
) -> DataFrame:
    """The ``size`` rows with the least seeded key hash, the keys breaking ties.

    Top-k keeps ``size`` rows per partition, which adds up on a frame of many
    partitions.  One pass counts rows by the leading bits of their hash; the least
    buckets that hold ``size`` rows bound the second pass, which orders what is in them.
    """
    hashed = frame.withColumn("__hash", key_hash(keys, seed, algorithm))
    counts = hashed.groupBy(_bucket(algorithm).alias("bucket")).count().orderBy("bucket").collect()
    least, seen = None, 0
    for row in counts:
        least, seen = row["bucket"], seen + row["count"]
        if seen >= size:
            break
    near = hashed.filter(_bucket(algorithm) <= F.lit(least))
    return near.orderBy("__hash", *keys).limit(size).drop("__hash")


def _bucket(algorithm: str) -> Column:
    """The leading twelve bits of a row's hash, in the order of the hash."""
    if algorithm == "md5":
        return F.substring("__hash", 1, 3)
    return F.shiftright("__hash", 52)


def comparison_sample(
    predictions: DataFrame,
    keys: Sequence[str],
    label: str,
    models: Mapping[str, str],
    kept: Sequence[str] = (),
    size: int = DEFAULT_SIZE,
    seed: int = 42,
    algorithm: str = "xxhash64",
) -> DataFrame:
    """One shared sample of actual values, every model's prediction and its residual."""
    columns = [*keys, label, *kept, *models.values()]
    sample = hash_sample(predictions.select(*columns), keys, size, seed, algorithm)
    return sample.withColumns(
        {f"residual_{model}": residual(label, column) for model, column in models.items()}
    )
