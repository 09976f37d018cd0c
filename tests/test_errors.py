from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from fieldbook.operators import errors, findings, sampling

MODELS = {"one": "p1", "two": "p2"}


@pytest.fixture(scope="module")
def scored(spark):
    return spark.range(1, 201).select(
        F.col("id").alias("k"),
        F.concat(F.lit("g"), (F.col("id") % 3).cast("string")).alias("g"),
        F.col("id").cast("double").alias("y"),
        (F.col("id") * 0.9 + 5).alias("p1"),
        F.lit(100.5).alias("p2"),
    )


def test_metrics_equal_the_evaluator(spark, scored):
    rows = {r["model"]: r for r in errors.regression_metrics(scored, "y", MODELS).collect()}
    for model, column in MODELS.items():
        for metric in ("mae", "rmse", "r2"):
            expected = RegressionEvaluator(
                labelCol="y", predictionCol=column, metricName=metric
            ).evaluate(scored)
            assert rows[model][metric] == pytest.approx(expected, abs=1e-9)
        assert rows[model]["n"] == 200


def test_metrics_of_constant_and_empty_labels(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p1 double")
    row = errors.regression_metrics(frame, "y", {"m": "p1"}).first()
    assert (row["mae"], row["r2"]) == (1.0, None)
    empty = errors.regression_metrics(frame.limit(0), "y", {"m": "p1"}).first()
    assert (empty["n"], empty["mae"], empty["r2"]) == (0, None, None)


def test_baseline_uses_the_training_mean(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "y double")
    validation = spark.createDataFrame([(2.0,), (6.0,)], "y double")
    row = errors.mean_baseline(train, validation, "y").first()
    assert (row["model"], row["mae"]) == ("mean_baseline", 2.0)


def test_long_errors_have_a_row_per_model(spark, scored):
    table = errors.long_errors(scored, ["k"], "y", MODELS)
    assert table.count() == 400
    row = table.filter("k = 200 and model = 'two'").first()
    assert (row["prediction"], row["residual"], row["abs_error"]) == (100.5, 99.5, 99.5)


def test_group_errors_equal_grouped_long_errors(spark, scored):
    table = errors.error_by_group(scored, "g", "y", MODELS, ["g2", "g0"])
    expected = (
        errors.long_errors(scored, ["g"], "y", MODELS)
        .groupBy("model", "g")
        .agg(F.count("*").alias("n"), F.avg("abs_error").alias("mae"), F.avg("residual").alias("me"))
    )
    wanted = {(r["model"], r["g"]): r for r in expected.collect()}
    rows = table.collect()
    assert [r["grp"] for r in rows if r["model"] == "one"] == ["g2", "g0", "g1"]
    for row in rows:
        other = wanted[row["model"], row["grp"]]
        assert row["n"] == other["n"]
        assert row["mae"] == pytest.approx(other["mae"])
        assert row["mean_error"] == pytest.approx(other["me"])


def test_bands_partition_the_rows_with_a_value(spark, scored):
    banded, thresholds = errors.value_bands(scored, "y", exact=True)
    counts = {r["band"]: r["count"] for r in banded.groupBy("band").count().collect()}
    assert counts == dict(zip(errors.BAND_LABELS, [50, 50, 50, 30, 10, 10]))
    assert [r["upper"] for r in thresholds.collect()] == [50.0, 100.0, 150.0, 180.0, 190.0, None]


def test_tied_values_leave_bands_empty_but_listed(spark):
    rows = [(5.0, 4.0)] * 60 + [(float(v), 5.0) for v in range(10, 50)]
    frame = spark.createDataFrame(rows, "y double, p1 double")
    banded, thresholds = errors.value_bands(frame, "y", exact=True)
    table = errors.error_by_band(banded, thresholds, "y", {"m": "p1"}).collect()
    assert [r["band"] for r in table] == list(errors.BAND_LABELS)
    assert [r["n"] for r in table] == [60, 0, 15, 15, 5, 5]
    assert table[1]["mae"] is None and table[1]["direction"] is None
    assert table[0]["direction"] == "subestima" and table[0]["underestimated_share"] == 1.0


def test_missing_labels_get_a_band_of_their_own(spark):
    rows = [(float(v), 1.0) for v in range(1, 21)] + [(None, 1.0), (math.nan, 1.0)]
    frame = spark.createDataFrame(rows, "y double, p1 double")
    banded, thresholds = errors.value_bands(frame, "y", exact=True)
    table = errors.error_by_band(banded, thresholds, "y", {"m": "p1"}).collect()
    assert [r["band"] for r in table] == [*errors.BAND_LABELS, None]
    assert sum(r["n"] for r in table) == 22 and table[-1]["n"] == 2


def test_band_cuts_of_nothing_are_an_error(spark):
    with pytest.raises(ValueError):
        errors.band_cuts(spark.createDataFrame([], "y double"), "y")


def test_residual_summary_modes_agree(spark, scored):
    exact = errors.residual_summary(scored, "y", MODELS, exact=True).collect()
    approximate = errors.residual_summary(scored, "y", MODELS).collect()
    assert exact == approximate
    assert [r["model"] for r in exact] == ["one", "two"]
    assert exact[1]["underestimated_share"] == 0.5


def test_metric_consistency(spark, scored):
    metrics = errors.regression_metrics(scored, "y", MODELS)
    errors.check_metrics_agree(metrics, errors.residual_summary(scored, "y", MODELS), "mae")
    shifted = metrics.withColumn("mae", F.col("mae") + 1e-3)
    with pytest.raises(ValueError, match="mae differs"):
        errors.check_metrics_agree(metrics, shifted, "mae")
    with pytest.raises(ValueError):
        errors.check_metrics_agree(metrics, metrics.filter("model = 'one'"), "mae")


def test_join_predictions_keeps_shared_keys(spark, scored):
    right = scored.filter("k <= 150").select("k", "p2")
    assert errors.join_predictions(scored.drop("p2"), right, ["k"], "p2").count() == 150


# --- Findings over literal result tables ------------------------------------------------

METRICS = [("mean_baseline", 9.0, 10.0, 0.0), ("a", 4.0, 6.0, 0.5), ("b", 5.0, 5.0, 0.6)]
GROUPS = [
    ("a", "x", 10, 3.0, 1.0, 50.0),
    ("a", "y", 20, 4.0, 2.0, 40.0),
    ("b", "x", 10, 8.0, -1.0, 50.0),
    ("b", "y", 20, 1.0, -2.0, 40.0),
]


@pytest.fixture(scope="module")
def metrics(spark):
    return spark.createDataFrame(METRICS, "model string, mae double, rmse double, r2 double")


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(
        GROUPS, "model string, grp string, n long, mae double, mean_error double, mean_actual double"
    )


def test_winner_leaves_the_baseline_out(spark, metrics):
    row = findings.best_models(metrics, "mean_baseline").first()
    assert (row["winner"], row["runner_up"], row["winner_rmse"]) == ("b", "a", 5.0)
    with pytest.raises(Exception, match="two candidate models"):
        findings.best_models(metrics.filter("model != 'a'"), "mean_baseline").collect()


def test_gain_over_the_baseline(spark, metrics):
    found = {r["model"]: r["rmse_gain_pct"] for r in findings.baseline_gain(metrics, "mean_baseline").collect()}
    assert found == {"mean_baseline": 0.0, "a": 40.0, "b": 50.0}


def test_validation_to_test_keeps_models_missing_from_validation(spark, metrics):
    earlier = metrics.filter("model != 'a'").withColumn("rmse", F.col("rmse") - 1)
    rows = findings.validation_to_test(earlier, metrics, "mean_baseline").collect()
    assert [r["model"] for r in rows] == ["b", "a", "mean_baseline"]
    assert [r["rmse_change"] for r in rows] == [1.0, None, 1.0]
    agreed = findings.winner_agreement(metrics, metrics, "mean_baseline").first()
    assert agreed["agree"] is True


def test_extreme_groups_say_when_there_is_no_under_or_overestimate(spark, groups):
    a, b = findings.extreme_groups(groups).collect()
    assert (a["worst_group"], a["under_group"], a["under_reading"]) == ("y", "y", "underestimated")
    assert (a["over_group"], a["over_reading"]) == ("x", "no_group_overestimated")
    assert (b["worst_group"], b["under_group"], b["under_reading"]) == ("x", "x", "no_group_underestimated")
    assert (b["over_group"], b["over_reading"]) == ("y", "overestimated")


def test_scale_check_averages_models(spark, groups):
    row = findings.scale_check(groups).first()
    assert (row["highest_actual_group"], row["highest_mae_group"], row["same_group"]) == ("x", "x", True)


def test_overall_extremes_and_wide_table(spark, groups):
    row = findings.overall_extremes({"g": groups}).first()
    assert tuple(row) == ("g", "b", "x", 10, 8.0)
    wide = findings.wide_group_errors(groups, ["a", "b"]).collect()
    assert [(r["grp"], r["a_mae"], r["b_mean_error"]) for r in wide] == [("x", 3.0, -1.0), ("y", 4.0, -2.0)]


def test_band_findings(spark, metrics):
    bands = spark.createDataFrame(
        [("a", "lo", 1, -3.0, 3.0, 0.1), ("a", "hi", 1, 9.0, 9.0, 0.9), ("b", "lo", 1, -2.0, 2.0, 0.2), ("b", "hi", 1, 7.0, 8.0, 0.8)],
        "model string, band string, n long, mean_error double, mae double, underestimated_share double",
    )
    contrast = findings.tail_contrast(bands, "lo", "hi").collect()
    assert [(r["low_mean_error"], r["high_mae"]) for r in contrast] == [(-3.0, 9.0), (-2.0, 8.0)]
    tail = findings.winner_in_tail(metrics, bands, "mean_baseline", "hi").collect()
    assert [(r["winner"], r["mean_error"]) for r in tail] == [("b", 7.0)]


def test_tail_residual_of_a_sample(spark, scored):
    sample = sampling.comparison_sample(scored, ["k"], "y", MODELS, size=200)
    assert sample.filter("abs(residual_two - (y - p2)) > 1e-12").isEmpty()
    rows = {r["model"]: r for r in findings.sample_tail_residual(sample, "y", MODELS).collect()}
    assert rows["two"]["tail_from"] == pytest.approx(180.1)
    assert rows["two"]["mean_residual"] == pytest.approx(0.0)
    assert rows["two"]["tail_mean_residual"] == pytest.approx(190.5 - 100.5)


def test_best_row_breaks_ties(spark):
    frame = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5), ("d", None)], "name string, v double")
    assert findings.best_row(frame, "v", largest=True, ties=["name"]).first()["name"] == "a"
    assert findings.best_row(frame, "v").first()["name"] == "c"
