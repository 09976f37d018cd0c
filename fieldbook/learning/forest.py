"""Random forests whose trees do not depend on how the rows lie.

A library forest draws its bootstrap with a generator per partition, and its split
candidates from a sample of the partitions.  Here a record's number of draws in a tree is a
Poisson number that follows from its key, each tree being a fit of its own with these numbers as
weights, and split candidates are cut from a sample chosen by key hash.  Training rows
may lie in any number of partitions, as many as their size asks for.

Features are numbers of bins and categories, so many rows share all of them.  The draws and
labels of these are added up first; trees iterate over the sums.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.sampling import hash_sample

from .layout import kept_for_iteration, key_uniform

#: Rows from which split candidates are taken, as many as the library's own trees take.
CUT_SAMPLE = 10_000
#: A bin holds at least this share of that sample, so that no fit can miss it.
LEAST_BIN = 1 / 256
#: Trees whose draws are added up in one pass, and fitted at the same time.
PARALLEL_TREES = 8
#: Combinations that a task of a tree's passes is worth starting for.
TASK_GROUPS = 50_000
WEIGHT = "__draws"


def poisson_draws(uniform: Column, mean: float) -> Column:
    """The Poisson number of a given mean that a uniform number stands for.

    Asked from the smallest number on, which most rows end at.
    """
    steps = poisson_steps(mean)
    draws = F.when(uniform < F.lit(steps[0]), 0)
    for number, step in enumerate(steps[1:], 1):
        draws = draws.when(uniform < F.lit(step), number)
    return draws.otherwise(len(steps))


def poisson_steps(mean: float, rest: float = 1e-12) -> list[float]:
    """Cumulated Poisson probabilities, until less than `rest` is left."""
    steps, term, total = [], math.exp(-mean), 0.0
    while 1.0 - total > rest and len(steps) < 200:
        total += term
        steps.append(total)
        term *= mean / len(steps)
    return steps


def bin_edges(
    frame: DataFrame, numeric: Sequence[str], keys: Sequence[str], bins: int, seed: int
) -> dict[str, list[float]]:
    """Inner edges of at most `bins` bins per column, between values of a key-hash sample.

    Columns of few values are cut between any two that are frequent enough; others into
    bins of about equal weight.  The sample is bounded by a parameter and reaches the driver.
    """
    sample = hash_sample(frame.select(*dict.fromkeys([*keys, *numeric])), keys, CUT_SAMPLE, seed)
    rows = sample.select(*numeric).collect()
    edges = {}
    for name in numeric:
        counts: dict[float, int] = {}
        for row in rows:
            if row[name] is None:
                raise ValueError(f"{name} has null values")
            counts[float(row[name])] = counts.get(float(row[name]), 0) + 1
        values = sorted(counts)
        least = len(rows) * (LEAST_BIN if len(values) <= bins else 1 / bins)
        edges[name], held, left = [], 0, len(rows)
        for value, following in zip(values, values[1:]):
            held, left = held + counts[value], left - counts[value]
            if held >= least and left >= len(rows) * LEAST_BIN and len(edges[name]) < bins - 1:
                edges[name].append(value + (following - value) / 2.0)
                held = 0
    return edges


@dataclass(frozen=True)
class Forest:
    """How one forest is grown; `algorithm` hashes the keys that bag its trees."""

    prediction: str
    trees: int
    settings: Mapping[str, object]
    seed: int
    algorithm: str = "xxhash64"


def _grouped(
    rows: DataFrame, slots: Sequence[str], keys: Sequence[str], label: str, numbers: Sequence[int],
    seed: int, algorithm: str, rate: float,
) -> DataFrame:
    """Per combination of slots and numbered tree, the draws and their labels added up."""
    drawn = rows.select(
        *slots,
        F.col(label).alias("__label"),
        *[
            poisson_draws(key_uniform(keys, seed, number, algorithm), rate).cast("double").alias(f"__n{number}")
            for number in numbers
        ],
    )
    return drawn.groupBy(*slots).agg(
        *[F.sum(f"__n{number}").alias(f"__n{number}") for number in numbers],
        *[F.sum(F.col(f"__n{number}") * F.col("__label")).alias(f"__s{number}") for number in numbers],
    )


def fit_forests(
    rows: DataFrame,
    slots: Sequence[str],
    encode: PipelineModel,
    keys: Sequence[str],
    label: str,
    forests: Sequence[Forest],
    rate: float,
) -> list[Transformer]:
    """For each forest, a pipeline that predicts the mean of separately fitted trees.

    `rows` holds the slots (bin and category numbers, which `encode` turns into a vector), label
    and keys, and should be kept.  Rows of equal slots can never be split apart, and a split's
    gain depends on their weight and mean alone, so each tree is fitted to a row per combination.
    The rows are passed over once for `PARALLEL_TREES` trees, of all forests that draw alike.
    With one tree there is nothing to bag: it takes every row once and every feature.
    """
    models: dict[tuple[int, int], Transformer] = {}

    def fitted(groups: DataFrame, size: int, place: int, number: int) -> None:
        forest = forests[place]
        bagged = forest.trees > 1
        weight, total = (f"__n{number}", f"__s{number}") if bagged else ("__n", "__s")
        vectors = groups.filter(F.col(weight) > 0).select(
            forest.settings["featuresCol"],
            F.col(weight).cast("double").alias(WEIGHT),
            (F.col(total) / F.col(weight)).alias(label),
        )
        # The library takes split candidates from a sample, unless it may hold all combinations.
        bins = max(int(forest.settings["maxBins"]), math.ceil(math.sqrt(size)))
        tree = RandomForestRegressor(
            labelCol=label,
            weightCol=WEIGHT,
            predictionCol=f"__{forest.prediction}_{number}",
            numTrees=1,
            bootstrap=False,
            subsamplingRate=1.0,
            featureSubsetStrategy="onethird" if bagged else "all",
            seed=forest.seed + number,
            **{**forest.settings, "maxBins": bins},
        )
        models[place, number] = tree.fit(vectors)

    def fit_together(groups: DataFrame, wanted: Sequence[tuple[int, int]]) -> None:
        with kept_for_iteration(encode.transform(groups)) as held, ThreadPool(PARALLEL_TREES) as pool:
            size = held.count()
            packed = held.coalesce(max(1, math.ceil(size / TASK_GROUPS)))
            pool.starmap(partial(fitted, packed, size), wanted, chunksize=1)

    single = [place for place, forest in enumerate(forests) if forest.trees == 1]
    if single:
        whole = rows.groupBy(*slots).agg(F.count("*").alias("__n"), F.sum(label).alias("__s"))
        fit_together(whole, [(place, 0) for place in single])
    alike = defaultdict(list)
    for place, forest in enumerate(forests):
        if forest.trees > 1:
            alike[forest.seed, forest.algorithm].append(place)
    for (seed, algorithm), places in alike.items():
        most = max(forests[place].trees for place in places)
        for first in range(0, most, PARALLEL_TREES):
            numbers = range(first, min(first + PARALLEL_TREES, most))
            wanted = [(place, n) for n in numbers for place in places if n < forests[place].trees]
            fit_together(_grouped(rows, slots, keys, label, numbers, seed, algorithm, rate), wanted)
    return [
        _mean([models[place, number] for number in range(forest.trees)], forest.prediction)
        for place, forest in enumerate(forests)
    ]


def _mean(trees: Sequence[Transformer], prediction: str) -> PipelineModel:
    columns = [f"`__{prediction}_{number}`" for number in range(len(trees))]
    mean = SQLTransformer(
        statement=f"SELECT * EXCEPT ({', '.join(columns)}), "
        f"({' + '.join(columns)}) / {float(len(trees))}D AS `{prediction}` FROM __THIS__"
    )
    return PipelineModel([*trees, mean])
