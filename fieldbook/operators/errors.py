"""Prediction-error analytics: metrics, errors by group and by band of the actual value.

``models`` maps a model id to its prediction column.  Tables are computed with one
aggregate per model column over the wide frame and unfolded afterwards, so rows are not
multiplied by the number of models before grouping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import (
    bias_direction,
    percent_of,
    position_in,
    residual,
    right_closed_band,
    underestimated_share,
)

from .quantiles import DEFAULT_ACCURACY, exact_column_quantiles, quantiles
from .small import local_frame

# Cut points of the actual value, and the names of the bands between them.
BAND_PROBS = (0.25, 0.50, 0.75, 0.90, 0.95)
BAND_LABELS = ("P00-P25", "P25-P50", "P50-P75", "P75-P90", "P90-P95", "P95-P100")


def _unfold(
    frame: DataFrame,
    kept: Sequence[str],
    models: Mapping[str, str],
    measures: Sequence[str],
) -> DataFrame:
    """Columns ``<measure>__<i>`` of each model to one row per model."""
    lines = [
        F.struct(
            F.lit(model).alias("model"),
            *[F.col(f"{name}__{i}").alias(name) for name in measures],
        )
        for i, model in enumerate(models)
    ]
    return frame.select(*kept, F.inline(F.array(*lines)))


def _per_model(models: Mapping[str, str], measures: Mapping[str, object]) -> list[Column]:
    return [
        build(F.col(column)).alias(f"{name}__{i}")
        for i, column in enumerate(models.values())
        for name, build in measures.items()
    ]


def long_errors(
    predictions: DataFrame, kept: Sequence[str], label: str, models: Mapping[str, str]
) -> DataFrame:
    """One row per record and model: ``model, prediction, residual, abs_error``."""
    narrow = predictions.select(
        *kept, label, *[F.col(column).alias(model) for model, column in models.items()]
    )
    stacked = narrow.unpivot([*kept, label], list(models), "model", "prediction")
    return stacked.withColumn("residual", residual(label, "prediction")).withColumn(
        "abs_error", F.abs("residual")
    )


def regression_metrics(
    predictions: DataFrame, label: str, models: Mapping[str, str]
) -> DataFrame:
    """``(model, n, mae, rmse, r2)`` of all the models from one aggregate.

    R² is ``1 - mean squared error / variance of the actual values``, both over the
    rows the model scored; it is null when the actual values do not vary.
    """
    actual = F.col(label)
    scored = {
        "n": lambda p: F.count(residual(actual, p)),
        "mae": lambda p: F.avg(F.abs(residual(actual, p))),
        "mse": lambda p: F.avg(residual(actual, p) * residual(actual, p)),
        "spread": lambda p: F.var_pop(F.when(p.isNotNull(), actual)),
    }
    totals = predictions.agg(*_per_model(models, scored))
    return _unfold(totals, [], models, list(scored)).select(
        "model",
        "n",
        "mae",
        F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide("mse", "spread")).alias("r2"),
    )


def with_constant_prediction(
    train: DataFrame, scored: DataFrame, label: str, target: str
) -> DataFrame:
    """Add the mean of the training label as a constant prediction."""
    mean = train.agg(F.avg(label)).first()[0]
    return scored.withColumn(target, F.lit(mean).cast("double"))


def mean_baseline(
    train: DataFrame, validation: DataFrame, label: str, name: str = "mean_baseline"
) -> DataFrame:
    """Metrics of predicting the training mean for every validation row."""
    scored = with_constant_prediction(train, validation.select(label), label, "__mean")
    return regression_metrics(scored, label, {name: "__mean"})


def join_predictions(
    left: DataFrame, right: DataFrame, keys: Sequence[str], prediction: str
) -> DataFrame:
    """Bring one prediction column of another scored frame to the rows with equal keys."""
    return left.join(right.select(*keys, prediction), list(keys), "inner")


def error_by_group(
    predictions: DataFrame,
    group: str,
    label: str,
    models: Mapping[str, str],
    order: Sequence[str] = (),
) -> DataFrame:
    """``(model, variable, grp, n, mae, mean_error, mean_actual, direction)``.

    All rows count.  ``order`` lists the groups in their natural order; others follow.
    """
    actual = F.col(label)
    measures = {
        "mae": lambda p: F.avg(F.abs(residual(actual, p))),
        "mean_error": lambda p: F.avg(residual(actual, p)),
    }
    grouped = predictions.groupBy(F.col(group).alias("grp")).agg(
        F.count("*").alias("n"),
        F.avg(actual).alias("mean_actual"),
        *_per_model(models, measures),
    )
    table = _unfold(grouped, ["grp", "n", "mean_actual"], models, list(measures))
    rank = [position_in("grp", order)] if order else []
    return table.select(
        "model",
        F.lit(group).alias("variable"),
        "grp",
        "n",
        "mae",
        "mean_error",
        "mean_actual",
        bias_direction("mean_error").alias("direction"),
    ).orderBy("model", *rank, "grp")


def errors_by_dimensions(
    predictions: DataFrame,
    dimensions: Mapping[str, str],
    label: str,
    models: Mapping[str, str],
) -> DataFrame:
    """``(dimension, model, grp, n, mae, mean_error, mean_actual, direction)`` in one scan.

    Rows are first added up by all the dimensions together; grouping sets then work on these
    sums, a row per combination of groups, and not on copies of the rows.
    """
    actual = F.col(label)
    sums = {
        "errors": lambda p: F.sum(F.abs(residual(actual, p))),
        "bias": lambda p: F.sum(residual(actual, p)),
        "scored": lambda p: F.count(residual(actual, p)),
    }
    groups = [f"__g{i}" for i in range(len(dimensions))]
    named = [
        F.col(column).cast("string").alias(g) for g, column in zip(groups, dimensions.values())
    ]
    cells = predictions.groupBy(*named).agg(
        F.count("*").alias("n"),
        F.sum(actual).alias("__actual"),
        F.count(actual).alias("__known"),
        *_per_model(models, sums),
    )
    added = ["n", "__actual", "__known", *[f"{s}__{i}" for i in range(len(models)) for s in sums]]
    sets = cells.groupingSets([[F.col(g)] for g in groups], *[F.col(g) for g in groups]).agg(
        F.grouping_id(*groups).alias("__set"), *[F.sum(name).alias(name) for name in added]
    )
    # One bit per dimension, the first one leading; the bit of the grouped one is 0.
    everything = (1 << len(groups)) - 1
    which, group = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (name, g) in enumerate(zip(dimensions, groups)):
        here = F.col("__set") == everything - (1 << (len(groups) - 1 - i))
        which = F.when(here, F.lit(name)).otherwise(which)
        group = F.when(here, F.col(g)).otherwise(group)
    placed = sets.select(which.alias("dimension"), group.alias("grp"), *added)
    table = _unfold(placed, ["dimension", "grp", *added[:3]], models, list(sums))
    mean_error = F.try_divide("bias", "scored")
    return table.select(
        "dimension",
        "model",
        "grp",
        "n",
        F.try_divide("errors", "scored").alias("mae"),
        mean_error.alias("mean_error"),
        F.try_divide("__actual", "__known").alias("mean_actual"),
        bias_direction(mean_error).alias("direction"),
    )


def band_cuts(
    frame: DataFrame,
    value: str,
    probs: Sequence[float] = BAND_PROBS,
    exact: bool = False,
    accuracy: int = DEFAULT_ACCURACY,
) -> list[float]:
    """The cut points as driver scalars, to be used as literals."""
    named = {f"q{i}": p for i, p in enumerate(probs)}
    row = quantiles(frame, value, named, exact=exact, accuracy=accuracy).first()
    if row is None or row[0] is None:
        raise ValueError(f"{value} has no values to cut")
    return [row[name] for name in named]


def band_thresholds(
    frame: DataFrame, cuts: Sequence[float], labels: Sequence[str] = BAND_LABELS
) -> DataFrame:
    """``(band, upper)``, one row per band; the last bound is open, so null."""
    rows = [(band, float(cut)) for band, cut in zip(labels, cuts)] + [(labels[-1], None)]
    return local_frame(frame.sparkSession, rows, "band string, upper double")


def value_bands(
    predictions: DataFrame,
    label: str,
    probs: Sequence[float] = BAND_PROBS,
    labels: Sequence[str] = BAND_LABELS,
    exact: bool = False,
    accuracy: int = DEFAULT_ACCURACY,
) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``band`` of the actual value, and the thresholds table.

    Heavily tied values make bands unequal and may leave some empty.
    """
    cuts = band_cuts(predictions, label, probs, exact, accuracy)
    banded = predictions.withColumn("band", right_closed_band(label, cuts, labels))
    return banded, band_thresholds(predictions, cuts, labels)


def error_by_band(
    banded: DataFrame,
    thresholds: DataFrame,
    label: str,
    models: Mapping[str, str],
    labels: Sequence[str] = BAND_LABELS,
) -> DataFrame:
    """Errors per model and band; every band is listed, empty ones with ``n = 0``.

    The band travels with the row, so nothing is joined back by key.  Rows without an
    actual value form a band of their own, null, listed last.
    """
    actual = F.col(label)
    measures = {
        "mean_predicted": lambda p: F.avg(p),
        "mae": lambda p: F.avg(F.abs(residual(actual, p))),
        "mean_error": lambda p: F.avg(residual(actual, p)),
        "underestimated_share": lambda p: underestimated_share(residual(actual, p)),
    }
    grouped = banded.groupBy(F.col("band").alias("__band")).agg(
        F.count("*").alias("n"),
        F.avg(actual).alias("mean_actual"),
        *_per_model(models, measures),
    )
    listed = grouped.join(thresholds, F.col("__band") == F.col("band"), "full_outer").select(
        F.coalesce("band", "__band").alias("band"),
        F.coalesce("n", F.lit(0)).alias("n"),
        "mean_actual",
        "upper",
        *[f"{name}__{i}" for i in range(len(models)) for name in measures],
    )
    table = _unfold(listed, ["band", "n", "mean_actual", "upper"], models, list(measures))
    return table.select(
        "model",
        "band",
        "n",
        "mean_actual",
        "mean_predicted",
        "mae",
        "mean_error",
        "underestimated_share",
        "upper",
        percent_of("mean_error", "mean_actual").alias("mean_error_pct"),
        bias_direction("mean_error").alias("direction"),
    ).orderBy("model", position_in("band", labels))


def residual_summary(
    predictions: DataFrame,
    label: str,
    models: Mapping[str, str],
    exact: bool = False,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """``(model, n, mean_error, mae, median_residual, underestimated_share)``."""
    actual = F.col(label)
    measures = {
        "mean_error": lambda p: F.avg(residual(actual, p)),
        "mae": lambda p: F.avg(F.abs(residual(actual, p))),
        "underestimated_share": lambda p: underestimated_share(residual(actual, p)),
    }
    if not exact:
        measures["median_residual"] = lambda p: F.percentile_approx(
            residual(actual, p), F.lit(0.5), F.lit(accuracy)
        )
    totals = predictions.agg(F.count("*").alias("n"), *_per_model(models, measures))
    table = _unfold(totals, ["n"], models, list(measures))
    if exact:
        residuals = predictions.select(
            *[residual(actual, column).alias(model) for model, column in models.items()]
        )
        medians = exact_column_quantiles(residuals, list(models), {"median_residual": 0.5})
        table = table.join(medians.withColumnRenamed("variable", "model"), "model", "left")
    return table.select(
        "model", "n", "mean_error", "mae", "median_residual", "underestimated_share"
    ).orderBy("model")


def metric_differences(
    left: DataFrame, right: DataFrame, metric: str, tolerance: float = 1e-6
) -> DataFrame:
    """``(model, stored, recomputed, agrees)`` for one metric of two metric tables."""
    stored = left.select("model", F.col(metric).alias("stored"))
    recomputed = right.select("model", F.col(metric).alias("recomputed"))
    agrees = F.abs(F.col("stored") - F.col("recomputed")) < tolerance
    return stored.join(recomputed, "model", "full_outer").withColumn(
        "agrees", F.coalesce(agrees, F.lit(False))
    )


def check_metrics_agree(
    left: DataFrame, right: DataFrame, metric: str, tolerance: float = 1e-6
) -> None:
    """Raise when a metric differs between two metric tables, or a model is in one only."""
    wrong = metric_differences(left, right, metric, tolerance).filter(~F.col("agrees")).collect()
    if wrong:
        raise ValueError(f"{metric} differs: {wrong}")
