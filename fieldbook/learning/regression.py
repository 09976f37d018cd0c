"""Regression candidates, their search on a validation period, and the final refit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.errors import regression_metrics
from fieldbook.operators.small import local_frame

from .features import FEATURES, FeatureSpec
from .forest import Forest, bin_edges, fit_forests
from .layout import kept_for_iteration

# Settings shared by all the candidates of a kind.
LINEAR_SETTINGS = {"maxIter": 150, "tol": 1e-6, "standardization": True}
FOREST_RATE, FOREST_BINS = 0.8, 32


@dataclass(frozen=True)
class LinearCandidate:
    """Least squares with optional elastic-net regularisation."""

    name: str
    reg_param: float = 0.0
    elastic_net: float = 0.0

    def describe(self) -> str:
        return f"regParam={self.reg_param}, elasticNetParam={self.elastic_net}"

    def estimator(self, label: str, prediction: str) -> LinearRegression:
        return LinearRegression(
            featuresCol=FEATURES,
            labelCol=label,
            predictionCol=prediction,
            regParam=self.reg_param,
            elasticNetParam=self.elastic_net,
            **LINEAR_SETTINGS,
        )


@dataclass(frozen=True)
class ForestCandidate:
    """Random forest of a given size and depth; `algorithm` hashes the keys that bag it."""

    name: str
    trees: int
    depth: int
    seed: int = 42
    algorithm: str = "xxhash64"

    def describe(self) -> str:
        return f"numTrees={self.trees}, maxDepth={self.depth}"

    def settings(self) -> dict[str, object]:
        return {"featuresCol": FEATURES, "maxDepth": self.depth, "maxBins": FOREST_BINS}


Candidate = LinearCandidate | ForestCandidate

# The candidates compared, by name and parameters.
LINEAR_CANDIDATES = (
    LinearCandidate("LR_sin_regularizacion", 0.0, 0.0),
    LinearCandidate("LR_ridge_0_1", 0.1, 0.0),
    LinearCandidate("LR_elastic_0_1", 0.1, 0.5),
)
FOREST_CANDIDATES = (
    ForestCandidate("RF_25_arboles_d5", 25, 5),
    ForestCandidate("RF_50_arboles_d7", 50, 7),
)


@dataclass(frozen=True)
class SearchResult:
    """Validation metrics by RMSE, the fitted pipelines, and the winning candidate."""

    metrics: DataFrame
    models: Mapping[str, PipelineModel]
    best: Candidate

    @property
    def best_model(self) -> PipelineModel:
        return self.models[self.best.name]


def fit_candidates(
    train: DataFrame,
    spec: FeatureSpec,
    candidates: Sequence[Candidate],
    keys: Sequence[str] = (),
) -> dict[str, PipelineModel]:
    """One pipeline per candidate, writing its prediction to a column of its own name.

    Features are fitted once for all linear candidates and once for all forests, and their
    vectors are kept while the estimators iterate.  Whatever is drawn follows from the keys
    (from all that a row holds, if none are given), so a fit is the same for any storage
    layout and number of partitions, up to the order in which doubles are added.
    """
    names = [candidate.name for candidate in candidates]
    if len(set(names)) != len(names):
        raise ValueError(f"candidate names repeat: {names}")
    by = list(keys) or [*spec.predictors, spec.label]
    label = F.col(spec.label).cast("double").alias(spec.label)
    others = [name for name in dict.fromkeys([*by, *spec.predictors]) if name != spec.label]
    rows = train.select(*others, label)
    models: dict[str, PipelineModel] = {}
    lines = [c for c in candidates if isinstance(c, LinearCandidate)]
    if lines:
        features = spec.fit(rows)
        with kept_for_iteration(features.transform(rows).select(FEATURES, spec.label)) as vectors:
            for c in lines:
                fitted = c.estimator(spec.label, c.name).fit(vectors)
                models[c.name] = PipelineModel([*features.stages, fitted])
    forests = [c for c in candidates if isinstance(c, ForestCandidate)]
    if forests:
        edges = bin_edges(rows, spec.numeric, by, FOREST_BINS, forests[0].seed)
        features = spec.fit(rows, edges)
        # Bins and indexes first; one-hot slots and vectors only for combinations of them.
        first = 2 * bool(spec.numeric) + bool(spec.categorical)
        slots, encode = PipelineModel(features.stages[:first]), PipelineModel(features.stages[first:])
        held = slots.transform(rows).select(*dict.fromkeys([*by, spec.label, *spec.slots()]))
        grown = [Forest(c.name, c.trees, c.settings(), c.seed, c.algorithm) for c in forests]
        with kept_for_iteration(held) as kept:
            fitted = fit_forests(kept, spec.slots(), encode, by, spec.label, grown, FOREST_RATE)
        for c, trees in zip(forests, fitted):
            models[c.name] = PipelineModel([*features.stages, trees])
    return {name: models[name] for name in names}


def score(frame: DataFrame, models: Mapping[str, PipelineModel]) -> DataFrame:
    """Add every model's prediction to the same rows in one pass.

    Rows are never scored apart, so there is nothing to join back by key.  All the
    pipelines must come from one :func:`fit_candidates` call or from equal specs; the
    feature stages run once for pipelines that share them.
    """
    scored, prepared_by = frame, None
    columns = [*frame.columns, *models]
    for model in models.values():
        uids = [stage.uid for stage in model.stages[:-1]]
        if uids != prepared_by:
            scored = scored.select(*[name for name in scored.columns if name in columns])
            for stage in model.stages[:-1]:
                scored = stage.transform(scored)
            prepared_by = uids
        scored = model.stages[-1].transform(scored)
    return scored.select(*columns)


def search(
    train: DataFrame,
    validation: DataFrame,
    spec: FeatureSpec,
    candidates: Sequence[Candidate],
    keys: Sequence[str] = (),
) -> SearchResult:
    """Fit every candidate on train and rank them by validation RMSE.

    All candidates are scored and measured in one pass over validation.  There is no
    test argument: the test period cannot influence the choice.
    """
    models = fit_candidates(train, spec, candidates, keys)
    scored = score(validation.select(*spec.predictors, spec.label), models)
    measured = regression_metrics(scored, spec.label, {name: name for name in models})
    rows = sorted(measured.collect(), key=lambda row: (row["rmse"], row["model"]))
    by_name = {candidate.name: candidate for candidate in candidates}
    described = [
        (row["model"], by_name[row["model"]].describe(), *row[1:]) for row in rows
    ]
    metrics = local_frame(
        train.sparkSession,
        described,
        "model string, configuration string, n long, mae double, rmse double, r2 double",
    )
    return SearchResult(metrics, models, by_name[rows[0]["model"]])


def compare(baseline: DataFrame, *results: SearchResult) -> DataFrame:
    """``(model, mae, rmse, r2)`` of the baseline and of each search's winner, by RMSE."""
    shown = ["model", "mae", "rmse", "r2"]
    table = baseline.select(*shown)
    for result in results:
        winner = result.metrics.filter(F.col("model") == result.best.name)
        table = table.unionByName(winner.select(*shown))
    return table.orderBy("rmse", "model")
