"""Standardised k-means: search over feature sets and k, and cluster profiles.

All candidates of a search advance together: in one pass, every task adds up the clusters of
each candidate that still moves, in Arrow batches, and sends a row per cluster.  (As one
aggregate of SQL expressions such a pass took 25 s for eight candidates on 600,000 rows, since
its code is too long to be compiled.)  Seeds are drawn by key hash, so the clusters
follow from the records and not from how they are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions import is_finite, percent_of, relation_text
from fieldbook.operators.quantiles import DEFAULT_ACCURACY
from fieldbook.operators.small import local_frame

from .layout import kept_for_iteration, key_uniform, spread

CLUSTER = "cluster"
SCALED = "scaled_features"
# Passes over the rows at most, and how far a centre moves when it is done.
ITERATIONS, TOLERANCE = 50, 1e-4
#: Figures kept of a mean or deviation, and decimals of a centre: the last ones follow from the
#: order in which rows are added up, and would tell which centre is nearest to a row halfway
#: between two.
FIGURES = 12


@dataclass(frozen=True)
class ClusterSearch:
    """Silhouettes, best first, and the winning model with its feature set and k."""

    silhouettes: DataFrame
    model: PipelineModel
    feature_set: str
    features: Sequence[str]
    k: int


def _scaling(features: Sequence[str]) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw_features"),
            StandardScaler(
                inputCol="raw_features", outputCol=SCALED, withMean=True, withStd=True
            ),
        ]
    )


def standardized(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replace the features by their z-scores (sample deviation); other columns stay."""
    values = vector_to_array(F.col(SCALED))
    scaled = _scaling(features).fit(frame.select(*features)).transform(frame)
    return scaled.withColumns({name: values[i] for i, name in enumerate(features)}).select(
        *frame.columns
    )


def _evaluator(cluster: str) -> ClusteringEvaluator:
    return ClusteringEvaluator(
        featuresCol=SCALED,
        predictionCol=cluster,
        metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    )


def silhouette(frame: DataFrame, features: Sequence[str], cluster: str) -> float:
    """Mean silhouette (squared Euclidean) of any numbered grouping, on z-scores.

    The distances follow from per-cluster sums, so no pairs of rows are formed.
    """
    scaling = _scaling(features).fit(frame.select(*features))
    grouped = scaling.transform(frame).select(SCALED, cluster)
    return _evaluator(cluster).evaluate(grouped)


@dataclass(frozen=True)
class _Points:
    """Rows with standardised columns, and each feature's column, mean and deviation."""

    rows: DataFrame
    columns: Mapping[str, str]
    moments: Mapping[str, tuple[float, float]]


Centre = tuple[float, ...]


def _points(frame: DataFrame, features: Sequence[str], keys: Sequence[str], seeds: int, seed: int) -> _Points:
    """z-scores (sample deviation) of all the features, and a uniform number per seed to draw.

    A feature that does not vary is 0 everywhere; one that is null or infinite is an error.
    """
    numbers = {name: F.col(name).cast("double") for name in features}
    row = frame.agg(
        F.count_if(~_all([is_finite(c) for c in numbers.values()])).alias("bad"),
        *[f(c).alias(f"{part}_{i}") for i, c in enumerate(numbers.values()) for part, f in (("m", F.avg), ("s", F.stddev_samp))],
    ).first()
    if row["bad"]:
        raise ValueError(f"{row['bad']} rows have a feature that is null or not finite")
    moments = {
        name: (_short(row[f"m_{i}"] or 0.0), _short(row[f"s_{i}"] or 0.0)) for i, name in enumerate(features)
    }
    columns = {name: f"__z{i}" for i, name in enumerate(features)}
    scaled = [
        ((c - F.lit(moments[name][0])) / F.lit(moments[name][1]) if moments[name][1] else F.lit(0.0)).alias(columns[name])
        for name, c in numbers.items()
    ]
    drawn = [key_uniform(keys or features, seed, i).alias(f"__u{i}") for i in range(seeds)]
    return _Points(frame.select(*scaled, *drawn), columns, moments)


def _short(value: float) -> float:
    return float(f"{value:.{FIGURES}g}")


def _all(tests: Sequence[Column]) -> Column:
    whole = F.lit(True)
    for test in tests:
        whole = whole & test
    return whole


def _distance(columns: Sequence[str], centre: Centre) -> Column:
    """Squared distance."""
    total = F.lit(0.0)
    for name, value in zip(columns, centre):
        total = total + (F.col(name) - F.lit(value)) * (F.col(name) - F.lit(value))
    return total


def _seeds(points: _Points, sets: Mapping[str, Sequence[str]], count: int) -> dict[str, list[Centre]]:
    """k-means++ seeds of every feature set, a pass per seed for all the sets together.

    The row of the least -ln(u) / d is drawn with a chance in proportion to d, its squared
    distance to the seeds so far.  Fewer come out where fewer points differ.
    """
    chosen: dict[str, list[Centre]] = {name: [] for name in sets}
    for draw in range(count):
        found = []
        for i, (name, columns) in enumerate(sets.items()):
            hurry = -F.log(F.lit(1.0) - F.col(f"__u{draw}"))
            if draw:
                far = [_distance(columns, c) for c in chosen[name]]
                far = F.least(*far) if len(far) > 1 else far[0]
                hurry = F.when(far > 0, hurry / far)
            point = F.struct(*columns)
            order = F.struct(hurry.alias("hurry"), point.alias("point"))
            found.append(F.min_by(point, F.when(hurry.isNotNull(), order)).alias(f"s{i}"))
        row = points.rows.agg(*found).first()
        for i, name in enumerate(sets):
            if row[f"s{i}"] is not None:
                chosen[name].append(tuple(row[f"s{i}"]))
        if not all(chosen.values()):
            raise ValueError("there are no rows to cluster")
    return chosen


def _apart(columns: Sequence[np.ndarray], centre: Sequence[float]) -> np.ndarray:
    """Squared distances, a whole column at a time."""
    total = np.zeros(len(columns[0]))
    for column, value in zip(columns, centre):
        off = column - value
        off *= off
        total += off
    return total


@dataclass
class _Candidate:
    """Centres of one feature set and k; `columns` are numbers of the kept columns."""

    columns: Sequence[int]
    centres: list[Centre]
    moving: bool = True

    def assigned(self, rows: Sequence[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        """The candidate's columns, and each row's nearest centre, the first among equals."""
        own = [rows[f] for f in self.columns]
        least, nearest = _apart(own, self.centres[0]), np.zeros(len(own[0]), np.int64)
        for j, centre in enumerate(self.centres[1:], 1):
            apart = _apart(own, centre)
            np.copyto(nearest, j, where=apart < least)
            np.minimum(least, apart, out=least)
        return own, nearest

    def move(self, totals: Mapping[int, _Total]) -> None:
        """To the means of the clusters; an empty one stays where it is."""
        before = self.centres
        self.centres = [
            tuple(round(float(x), FIGURES) for x in totals[j].sums / totals[j].n) if j in totals else centre
            for j, centre in enumerate(before)
        ]
        self.moving = any(math.dist(a, b) > TOLERANCE for a, b in zip(before, self.centres))


@dataclass(frozen=True)
class _Total:
    """What the rows of one cluster add up to."""

    n: int
    sums: np.ndarray
    squares: float


def _added(points: _Points, columns: str, step) -> list:
    """Rows that tasks send for (candidate, cluster), added up; a handful comes to the driver.

    The points are packed ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for packed in batch.column(0):
                part = step(np.frombuffer(packed.as_buffer()).reshape(width, -1))
                total = part if total is None else total + part
        if total is not None:
            sent = [*np.indices(total.shape[:-1]).reshape(total.ndim - 1, -1), *total.reshape(-1, total.shape[-1]).T]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in sent], names=names)

    names = ["candidate", "cluster", *columns.split()]
    width = len(points.columns)
    sent = points.rows.mapInArrow(run, ", ".join(f"{name} double" for name in names))
    return sent.groupBy("candidate", "cluster").agg(*[F.sum(name).alias(name) for name in names[2:]]).collect()


def _packed(points: _Points) -> DataFrame:
    """The standardised columns of a batch of rows as one binary value, a column after another.

    Passes hand it to Python as it is: nothing is converted for each row and pass.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.stack([column.to_numpy() for column in batch.columns]).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([values], pa.binary())], names=["points"])

    return points.rows.select(*points.columns.values()).mapInArrow(pack, "points binary")


def _totals(points: _Points, candidates: Sequence[_Candidate]) -> list[dict[int, _Total]]:
    """Rows, sums and sum of squares of every cluster that has rows, for all candidates."""
    width, most = len(points.columns), max(len(c.centres) for c in candidates)
    sent = list(candidates)

    def step(rows: Sequence[np.ndarray]) -> np.ndarray:
        found = np.zeros((len(sent), most, width + 2))
        for i, c in enumerate(sent):
            own, nearest = c.assigned(rows)
            found[i, :, 0] = np.bincount(nearest, minlength=most)
            found[i, :, 1] = np.bincount(nearest, _apart(own, [0.0] * len(own)), most)
            for f, column in enumerate(own):
                found[i, :, 2 + f] = np.bincount(nearest, column, most)
        return found

    totals: list[dict[int, _Total]] = [{} for _ in candidates]
    columns = ["n", "squares", *[f"x{f}" for f in range(width)]]
    for row in _added(points, " ".join(columns), step):
        if row["n"]:
            own = candidates[int(row["candidate"])]
            sums = np.array([row[f"x{f}"] for f in range(len(own.columns))])
            totals[int(row["candidate"])][int(row["cluster"])] = _Total(int(row["n"]), sums, row["squares"])
    return totals


def _settle(points: _Points, candidates: Sequence[_Candidate]) -> None:
    """Move all centres until none moves any more."""
    for _ in range(ITERATIONS):
        moving = [c for c in candidates if c.moving]
        if not moving:
            return
        for c, totals in zip(moving, _totals(points, moving)):
            c.move(totals)


def _silhouettes(points: _Points, candidates: Sequence[_Candidate]) -> list[float | None]:
    """Mean silhouette of every candidate: one pass of cluster sums, one of row silhouettes.

    The mean squared distance of a row to a cluster follows from the cluster's number of rows,
    sum and sum of squares.  A row alone in its cluster has 0; one cluster alone has no value.
    """
    sent = list(zip(candidates, _totals(points, candidates)))

    def step(rows: Sequence[np.ndarray]) -> np.ndarray:
        found = np.zeros((len(sent), 1, 2))
        for i, (c, totals) in enumerate(sent):
            if len(totals) < 2:
                continue
            own, nearest = c.assigned(rows)
            each = np.arange(len(nearest))
            apart = np.full((len(c.centres), len(each)), np.inf)
            for j, total in totals.items():
                # mean |z - x|^2 = |z - mean x|^2 + the cluster's mean square beyond its mean.
                mean = total.sums / total.n
                apart[j] = _apart(own, mean) + total.squares / total.n - (mean * mean).sum()
            sizes = np.array([totals[j].n if j in totals else 0 for j in range(len(c.centres))])[nearest]
            inside = apart[nearest, each] * sizes / np.maximum(sizes - 1, 1)
            apart[nearest, each] = np.inf
            outside = apart.min(axis=0)
            larger = np.maximum(inside, outside)
            value = np.where((sizes > 1) & (larger > 0), (outside - inside) / np.where(larger > 0, larger, 1.0), 0.0)
            found[i, 0] = len(each), value.sum()
        return found

    means: list[float | None] = [None] * len(candidates)
    for row in _added(points, "n total", step):
        if row["n"]:
            means[int(row["candidate"])] = row["total"] / row["n"]
    return means


def _model(points: _Points, features: Sequence[str], candidate: _Candidate) -> PipelineModel:
    """Assigns rows with the plain features to the nearest centre."""
    parts = []
    for centre in candidate.centres:
        terms = []
        for name, value in zip(features, centre):
            mean, deviation = points.moments[name]
            if deviation:
                terms.append(f"pow((CAST(`{name}` AS DOUBLE) - ({mean!r}D)) / {deviation!r}D - ({value!r}D), 2)")
        parts.append(" + ".join(terms) or "0D")
    cases = [
        f"WHEN {' AND '.join(f'{part} <= {other}' for other in parts[j + 1 :])} THEN {j}"
        for j, part in enumerate(parts[:-1])
    ]
    number = f"CASE {' '.join(cases)} ELSE {len(parts) - 1} END" if cases else "0"
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {number} AS {CLUSTER} FROM __THIS__")])


def fit_clusters(
    frame: DataFrame,
    features: Sequence[str],
    k: int,
    seed: int = 42,
    keys: Sequence[str] = (),
) -> PipelineModel:
    """Standardise and cluster; the model assigns rows with the same columns."""
    return kmeans_search(frame, {"all": features}, (k,), seed, keys, measured=False).model


def kmeans_search(
    frame: DataFrame,
    feature_sets: Mapping[str, Sequence[str]],
    ks: Sequence[int] = (2, 3, 4, 5),
    seed: int = 42,
    keys: Sequence[str] = (),
    measured: bool = True,
) -> ClusterSearch:
    """Try every k on every feature set and rank by silhouette (squared Euclidean).

    The seeds of a smaller k are the first ones of a larger one.  ``best_of_set`` marks the
    best k of each set, since silhouettes of different spaces are not strictly comparable.
    Without keys, rows of equal features draw alike.
    """
    every = list(dict.fromkeys(name for names in feature_sets.values() for name in names))
    points = _points(frame, every, keys, max(ks), seed)
    columns = {name: [points.columns[f] for f in names] for name, names in feature_sets.items()}
    numbers = {name: [every.index(f) for f in names] for name, names in feature_sets.items()}
    with ExitStack() as held:
        with kept_for_iteration(spread(points.rows)) as rows:
            points = replace(points, rows=rows)
            seeds = _seeds(points, columns, max(ks))
            points = replace(points, rows=held.enter_context(kept_for_iteration(_packed(points))))
            points.rows.count()
        candidates = {
            (name, k): _Candidate(numbers[name], seeds[name][:k]) for name in feature_sets for k in ks
        }
        _settle(points, list(candidates.values()))
        values = _silhouettes(points, list(candidates.values())) if measured else [0.0] * len(candidates)

    found = [(value, name, k) for value, (name, k) in zip(values, candidates)]
    found.sort(key=lambda entry: (entry[0] is None, -(entry[0] or 0.0), entry[1], entry[2]))
    leaders: dict[str, int] = {}
    for _, name, k in found:
        leaders.setdefault(name, k)
    lines = [(name, k, value, leaders[name] == k) for value, name, k in found]
    silhouettes = local_frame(
        frame.sparkSession,
        lines, "feature_set string, k int, silhouette double, best_of_set boolean"
    )
    _, name, k = found[0]
    model = _model(points, feature_sets[name], candidates[name, k])
    return ClusterSearch(silhouettes, model, name, list(feature_sets[name]), k)


def cluster_profiles(
    frame: DataFrame,
    model: PipelineModel,
    features: Sequence[str],
    high: str = "alto",
    low: str = "bajo",
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """Per cluster: n, share, mean and median of each feature, and a short reading.

    The reading compares each mean with the overall one.  Overall means are summed from
    the cluster sums, so the rows are assigned to clusters once; the window runs over
    one row per cluster.
    """
    assigned = model.transform(frame.select(*features)).select(CLUSTER, *features)
    grouped = assigned.groupBy(CLUSTER).agg(
        F.count("*").alias("n"),
        *[F.sum(name).alias(f"__sum_{name}") for name in features],
        *[F.avg(name).alias(f"{name}_mean") for name in features],
        *[
            F.percentile_approx(name, F.lit(0.5), F.lit(accuracy)).alias(f"{name}_median")
            for name in features
        ],
    )
    everyone = Window.partitionBy(F.lit(0))
    overall = grouped.withColumns(
        {
            "__n": F.sum("n").over(everyone),
            **{
                f"__mean_{name}": F.sum(f"__sum_{name}").over(everyone) / F.sum("n").over(everyone)
                for name in features
            },
        }
    )
    reading = F.concat_ws(
        ", ",
        *[
            relation_text(
                F.col(f"{name}_mean"), F.col(f"__mean_{name}"), name.replace("_", " "), high, low
            )
            for name in features
        ],
    )
    sentence = F.concat(F.upper(F.substring(reading, 1, 1)), F.substr(reading, F.lit(2)))
    return overall.select(
        CLUSTER,
        "n",
        *[f"{name}_{part}" for name in features for part in ("mean", "median")],
        percent_of("n", "__n").alias("pct"),
        sentence.alias("description"),
    ).orderBy(CLUSTER)
