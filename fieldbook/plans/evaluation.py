"""Final evaluation: refit the chosen candidates and score the test period once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import residual
from fieldbook.learning.features import FeatureSpec
from fieldbook.learning.regression import Candidate, fit_candidates, score
from fieldbook.operators.audit import check_conservation, check_unique_keys, row_conservation
from fieldbook.operators.errors import regression_metrics, with_constant_prediction
from fieldbook.sources.runs import scratch_path
from fieldbook.sources.tables import materialise, save_model

BASELINE = "mean_baseline"


@dataclass(frozen=True)
class FinalEvaluation:
    """Stored predictions and everything measured on them."""

    predictions: DataFrame
    predictions_path: str
    metrics: DataFrame
    conservation: DataFrame
    models: Mapping[str, PipelineModel]
    prediction_columns: Mapping[str, str]
    train_rows: int
    test_rows: int


def evaluate_finally(
    train: DataFrame,
    test: DataFrame,
    spec: FeatureSpec,
    candidates: Sequence[Candidate],
    keys: Sequence[str],
    kept: Sequence[str] = (),
    predictions_path: str | None = None,
    model_root: str | None = None,
) -> FinalEvaluation:
    """Refit on all the training periods and score the same test rows with every model.

    The candidates arrive already chosen; the test rows are only scored.  Predictions,
    the mean baseline and residuals are stored once and every figure is read from there.
    """
    train_rows = check_unique_keys(train, keys, "training rows")
    test_rows = check_unique_keys(test, keys, "test rows")

    models = fit_candidates(train, spec, candidates, keys)
    if model_root:
        for name, model in models.items():
            save_model(model, f"{model_root}/{name}")

    context = list(dict.fromkeys([*keys, spec.label, *spec.predictors, *kept]))
    scored = score(test.select(*context), models)
    scored = with_constant_prediction(train, scored, spec.label, BASELINE)
    columns = {name: name for name in (BASELINE, *models)}
    with_residuals = scored.withColumns(
        {f"residual_{name}": residual(spec.label, name) for name in models}
    )
    path = predictions_path or scratch_path(train.sparkSession, "predictions")
    predictions = materialise(with_residuals, path)

    conservation = row_conservation(test, predictions, keys, {name: name for name in models})
    check_conservation(conservation)

    configurations = {BASELINE: "training mean"}
    configurations.update({c.name: c.describe() for c in candidates})
    described = F.create_map(
        *[F.lit(part) for pair in configurations.items() for part in pair]
    )
    metrics = regression_metrics(predictions, spec.label, columns).select(
        "model", described[F.col("model")].alias("configuration"), "n", "mae", "rmse", "r2"
    )
    return FinalEvaluation(
        predictions, path, metrics, conservation, models, columns, train_rows, test_rows
    )
