"""Questions asked of metric and error tables.

The inputs are result tables: one row per model, or per model and group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions import percent_below

from .quantiles import interpolated_quantile

# Readings of an extreme group that does not exist.
NO_UNDERESTIMATE = "no_group_underestimated"
NO_OVERESTIMATE = "no_group_overestimated"


def _ranked(metrics: DataFrame, baseline: str) -> DataFrame:
    """One row with the candidate models as an array of structs, least RMSE first."""
    candidates = metrics.filter((F.col("model") != baseline) & F.col("rmse").isNotNull())
    entry = F.struct("rmse", "model", "mae", "r2")
    return candidates.agg(F.sort_array(F.collect_list(entry)).alias("__models"))


def best_models(metrics: DataFrame, baseline: str) -> DataFrame:
    """Winner and runner-up by RMSE, the baseline left out; fails with fewer than two."""
    ranked = _ranked(metrics, baseline)
    enough = F.when(
        F.size("__models") < 2, F.raise_error(F.lit("two candidate models are needed"))
    ).otherwise(F.col("__models"))
    models = ranked.select(enough.alias("__models"))
    first, second = F.col("__models")[0], F.col("__models")[1]
    return models.select(
        first["model"].alias("winner"),
        first["rmse"].alias("winner_rmse"),
        first["r2"].alias("winner_r2"),
        second["model"].alias("runner_up"),
        second["rmse"].alias("runner_up_rmse"),
    )


def baseline_gain(metrics: DataFrame, baseline: str) -> DataFrame:
    """RMSE improvement over the baseline, in percent, for every model."""
    return metrics.select(
        "model",
        "rmse",
        percent_below("rmse", _baseline_rmse(baseline)).alias("rmse_gain_pct"),
    ).orderBy("rmse", "model")


def _baseline_rmse(baseline: str) -> Column:
    """The baseline's RMSE beside every row of a metric table, which is one row per model."""
    models = Window.partitionBy(F.lit(0))
    return F.max(F.when(F.col("model") == baseline, F.col("rmse"))).over(models)


def validation_to_test(validation: DataFrame, test: DataFrame, baseline: str) -> DataFrame:
    """Test metrics beside validation metrics, with gain and RMSE change.

    Models missing from validation keep nulls.  ``test`` may carry further columns.
    """
    earlier = validation.select(
        "model", *[F.col(name).alias(f"{name}_validation") for name in ("mae", "rmse", "r2")]
    )
    return (
        test.join(earlier, "model", "left")
        .withColumns(
            {
                "rmse_gain_pct": percent_below("rmse", _baseline_rmse(baseline)),
                "rmse_change": F.col("rmse") - F.col("rmse_validation"),
            }
        )
        .orderBy("rmse", "model")
    )


def winner_agreement(validation: DataFrame, test: DataFrame, baseline: str) -> DataFrame:
    """Whether validation and test prefer the same model."""
    chosen = best_models(validation, baseline).select("winner").scalar()
    return best_models(test, baseline).select(
        chosen.alias("validation_winner"),
        F.col("winner").alias("test_winner"),
        (chosen == F.col("winner")).alias("agree"),
    )


def _largest(value: str, group: str = "grp") -> Column:
    """Aggregate: the row with the greatest value, ties to the first group by name.

    ``min_by`` over the negated value and the name gives the tie-break.
    """
    entry = F.struct(group, value, "n")
    return F.min_by(entry, F.when(F.col(value).isNotNull(), F.struct(-F.col(value), group)))


def _least(value: str, group: str = "grp") -> Column:
    entry = F.struct(group, value, "n")
    return F.min_by(entry, F.when(F.col(value).isNotNull(), F.struct(value, group)))


def extreme_groups(errors: DataFrame) -> DataFrame:
    """Per model: the group with the largest MAE, under- and overestimate.

    When no group is underestimated (or overestimated) the reading says so, and the
    group shown is the closest to it.
    """
    found = errors.groupBy("model").agg(
        _largest("mae").alias("__worst"),
        _largest("mean_error").alias("__under"),
        _least("mean_error").alias("__over"),
    )
    under, over = F.col("__under"), F.col("__over")
    return found.select(
        "model",
        F.col("__worst.grp").alias("worst_group"),
        F.col("__worst.mae").alias("worst_mae"),
        F.col("__worst.n").alias("worst_n"),
        under["grp"].alias("under_group"),
        under["mean_error"].alias("under_error"),
        F.when(under["mean_error"] > 0, "underestimated")
        .otherwise(NO_UNDERESTIMATE)
        .alias("under_reading"),
        over["grp"].alias("over_group"),
        over["mean_error"].alias("over_error"),
        F.when(over["mean_error"] < 0, "overestimated")
        .otherwise(NO_OVERESTIMATE)
        .alias("over_reading"),
    ).orderBy("model")


def scale_check(errors: DataFrame) -> DataFrame:
    """Is the group with the highest mean actual also the one with the highest MAE?

    Models are averaged first.
    """
    averaged = errors.groupBy("grp").agg(
        F.avg("mean_actual").alias("mean_actual"), F.avg("mae").alias("mae"), F.max("n").alias("n")
    )
    tops = averaged.agg(_largest("mean_actual").alias("__a"), _largest("mae").alias("__e"))
    return tops.select(
        F.col("__a.grp").alias("highest_actual_group"),
        F.col("__a.mean_actual").alias("highest_actual"),
        F.col("__e.grp").alias("highest_mae_group"),
        F.col("__e.mae").alias("highest_mae"),
        (F.col("__a.grp") == F.col("__e.grp")).alias("same_group"),
    )


def tail_contrast(bands: DataFrame, lowest: str, highest: str) -> DataFrame:
    """Per model: mean error in the lowest band against the highest one."""

    def at(band: str, measure: str) -> Column:
        return F.max(F.when(F.col("band") == band, F.col(measure)))

    return (
        bands.groupBy("model")
        .agg(
            at(lowest, "mean_error").alias("low_mean_error"),
            at(highest, "mean_error").alias("high_mean_error"),
            at(highest, "mae").alias("high_mae"),
            at(highest, "underestimated_share").alias("high_underestimated_share"),
        )
        .orderBy("model")
    )


def winner_in_tail(
    metrics: DataFrame, bands: DataFrame, baseline: str, highest: str
) -> DataFrame:
    """How the overall winner does in the highest band."""
    winner = best_models(metrics, baseline).select("winner").scalar()
    return bands.filter((F.col("band") == highest) & (F.col("model") == winner)).select(
        F.col("model").alias("winner"), "band", "n", "mean_error", "mae"
    )


def overall_extremes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The largest MAE of each error table, with its model and group.

    ``tables`` maps a dimension name to a table with ``model, grp, n, mae``.
    """
    parts = [
        table.select(F.lit(dimension).alias("dimension"), "model", "grp", "n", "mae")
        for dimension, table in tables.items()
    ]
    return extremes_by_dimension(reduce(DataFrame.unionByName, parts))


def extremes_by_dimension(errors: DataFrame) -> DataFrame:
    """The largest MAE of each dimension of one table, with its model and group."""
    entry = F.struct("model", "grp", "n", "mae")
    order = F.when(
        F.col("mae").isNotNull(), F.struct(-F.col("mae"), F.col("model"), F.col("grp"))
    )
    worst = errors.groupBy("dimension").agg(F.min_by(entry, order).alias("__w"))
    return worst.select("dimension", "__w.*").orderBy("dimension")


def sample_tail_residual(
    sample: DataFrame, label: str, models: Mapping[str, str], prob: float = 0.9
) -> DataFrame:
    """Per model: mean residual overall and from an interpolated quantile upwards.

    Meant for a bounded sample: ``percentile`` keeps the distinct values of the label.
    """
    cut = sample.agg(F.percentile(label, F.lit(prob)).alias("cut")).first()["cut"]
    return _tail_residual(sample, label, models, cut)


def tail_residual(
    predictions: DataFrame, label: str, models: Mapping[str, str], prob: float = 0.9
) -> DataFrame:
    """The same over all rows: the quantile lies between two exact order statistics."""
    return _tail_residual(predictions, label, models, interpolated_quantile(predictions, label, prob))


def _tail_residual(
    frame: DataFrame, label: str, models: Mapping[str, str], cut: float | None
) -> DataFrame:
    """One aggregate of all models; a null cut (no values) leaves the tail empty."""
    actual, start = F.col(label), F.lit(cut).cast("double")
    totals = frame.agg(
        *[
            column.alias(f"{name}__{i}")
            for i, prediction in enumerate(models.values())
            for name, column in (
                ("mean_residual", F.avg(actual - F.col(prediction))),
                ("tail_mean_residual", F.avg(F.when(actual >= start, actual - F.col(prediction)))),
            )
        ]
    )
    lines = [
        F.struct(
            F.lit(model).alias("model"),
            start.alias("tail_from"),
            F.col(f"mean_residual__{i}").alias("mean_residual"),
            F.col(f"tail_mean_residual__{i}").alias("tail_mean_residual"),
        )
        for i, model in enumerate(models)
    ]
    return totals.select(F.inline(F.array(*lines))).orderBy("model")


def wide_group_errors(errors: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per group: n, then MAE and mean error of each model as columns."""
    pivoted = (
        errors.groupBy("grp", "n")
        .pivot("model", list(models))
        .agg(F.max("mae").alias("mae"), F.max("mean_error").alias("mean_error"))
    )
    return pivoted.orderBy("grp")


def best_row(table: DataFrame, by: str, largest: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the least (or greatest) value, ties broken by further columns."""
    order = F.desc_nulls_last(by) if largest else F.asc_nulls_last(by)
    return table.orderBy(order, *ties).limit(1)
