from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from fieldbook.learning import clustering
from fieldbook.learning.clustering import (
    CLUSTER,
    cluster_profiles,
    fit_clusters,
    kmeans_search,
    standardized,
)
from fieldbook.learning.features import FEATURES, FeatureSpec
from fieldbook.learning.forest import bin_edges, poisson_draws
from fieldbook.learning.layout import kept_for_iteration, key_uniform
from fieldbook.learning.regression import (
    FOREST_CANDIDATES,
    FOREST_RATE,
    LINEAR_CANDIDATES,
    ForestCandidate,
    LinearCandidate,
    compare,
    fit_candidates,
    score,
    search,
)
from fieldbook.operators.audit import check_conservation
from fieldbook.operators.errors import mean_baseline, regression_metrics
from fieldbook.plans import survey
from fieldbook.plans.evaluation import BASELINE, evaluate_finally
from fieldbook.sources.tables import load_model, save_model

SPEC = FeatureSpec(numeric=["x"], categorical=["c"], label="y")
SMALL_FOREST = ForestCandidate("forest", 5, 4)


@pytest.fixture(scope="module")
def planted(spark):
    frame = spark.range(600).select(
        F.col("id").alias("k"),
        (F.col("id") % 37).cast("double").alias("x"),
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("id") % 3 + 1).cast("int")).alias("c"),
        F.when(F.col("id") < 300, "p1").when(F.col("id") < 450, "p2").otherwise("p3").alias("period"),
    )
    labelled = frame.withColumn("y", 3 * F.col("x") + F.when(F.col("c") == "A", 10.0).otherwise(0.0) + 5)
    return labelled.persist()


def parts(frame):
    return [frame.filter(F.col("period") == p) for p in ("p1", "p2", "p3")]


def test_feature_stages(spark):
    indexer, encoder, assembler = survey.FEATURES.stages()
    assert isinstance(indexer, StringIndexer) and isinstance(encoder, OneHotEncoder)
    assert isinstance(assembler, VectorAssembler)
    assert indexer.getHandleInvalid() == "keep" and assembler.getHandleInvalid() == "error"
    assert assembler.getInputCols() == [
        "age", "tenure", "weekly_hours", "education_ohe", "occupation_ohe", "area_ohe",
    ]


def test_the_label_cannot_be_a_predictor(spark):
    with pytest.raises(ValueError):
        FeatureSpec(numeric=["y"], categorical=[], label="y")


def test_only_the_predictors_reach_the_vector(spark, planted):
    prepared = SPEC.fit(planted.withColumn("leak", F.col("y"))).transform(planted)
    assert prepared.first()[FEATURES].size == 1 + 4


def test_planted_line_is_recovered(spark, planted):
    train, validation, _ = parts(planted)
    result = search(train, validation, SPEC, LINEAR_CANDIDATES)
    rows = result.metrics.collect()
    assert result.best.name == "LR_sin_regularizacion" == rows[0]["model"]
    assert rows[0]["r2"] == pytest.approx(1.0, abs=1e-6)
    assert [r["rmse"] for r in rows] == sorted(r["rmse"] for r in rows)
    assert rows[0]["configuration"] == "regParam=0.0, elasticNetParam=0.0"


def test_unseen_categories_are_scored(spark, planted):
    train = planted.filter("c != 'C'")
    models = fit_candidates(train, SPEC, [LinearCandidate("line")])
    scored = score(planted.filter("c = 'C'"), models)
    assert scored.filter(F.col("line").isNull()).isEmpty()
    assert regression_metrics(scored, "y", {"line": "line"}).first()["r2"] > 0.5


def test_pipelines_fitted_apart_are_scored_together(spark, planted):
    first = fit_candidates(planted, SPEC, [LinearCandidate("line")])
    second = fit_candidates(planted, SPEC, [SMALL_FOREST])
    scored = score(planted, {**first, **second})
    assert scored.columns == [*planted.columns, "line", "forest"]
    assert scored.count() == planted.count()


def test_candidate_names_must_differ(spark, planted):
    with pytest.raises(ValueError):
        fit_candidates(planted, SPEC, [LinearCandidate("a"), LinearCandidate("a", 0.1)])


def test_fits_do_not_depend_on_how_rows_are_partitioned(spark, planted):
    """Fewer and more partitions than cores, and another order of the rows."""
    train, validation, _ = parts(planted)
    noisy = train.withColumn("y", F.col("y") + F.pmod(F.xxhash64("k"), F.lit(1000)) / 100)
    fits, clusters = [], []
    for stored in (noisy.coalesce(1), noisy.repartition(7), noisy.orderBy(F.desc("y")).repartition(64, "c")):
        models = fit_candidates(stored, SPEC, [SMALL_FOREST, ForestCandidate("other", 3, 2, seed=7)], ["k"])
        scored = score(validation, models).orderBy("k").select("forest", "other").collect()
        fits.append([value for row in scored for value in row])
        model = fit_clusters(stored, SPEC.numeric, 3, keys=["k"])
        profile = cluster_profiles(stored, model, SPEC.numeric).collect()
        clusters.append([(r["n"], round(r["x_mean"], 9)) for r in profile])
    assert fits[0] == pytest.approx(fits[1], rel=1e-12) and fits[0] == pytest.approx(fits[2], rel=1e-12)
    assert fits[0][0::2] != fits[0][1::2]
    assert clusters[0] == clusters[1] == clusters[2]


def test_large_fits_do_not_depend_on_partitions_either(spark):
    """Above the rows that the library's trees look at to find their splits."""
    frame = spark.range(30_000).select(
        F.col("id").alias("k"), (F.xxhash64("id") % 5_000 / 7.0).alias("x"), (F.col("id") % 40).alias("w")
    ).withColumn("y", F.when(F.col("x") > 100, 5.0).otherwise(F.col("x") / 50) + F.pmod(F.xxhash64("k", F.lit(1)), F.lit(7)) + F.col("w"))
    spec, thresholds = FeatureSpec(numeric=["x", "w"], categorical=[], label="y"), []
    for partitions in (1, 64):
        model = fit_candidates(frame.repartition(partitions), spec, [ForestCandidate("f", 3, 4)], ["k"])["f"]
        trees = model.stages[-1].stages[:-1]
        lines = "\n".join(tree.toDebugString for tree in trees).splitlines()
        thresholds.append([line.strip() for line in lines if "feature" in line])
        assert all("<=" in line or ">" in line for line in thresholds[-1])
    assert thresholds[0] == thresholds[1] and len(thresholds[0]) > 20


def test_draws_are_poisson_numbers_of_the_key(spark):
    frame = spark.range(200_000).select("id", poisson_draws(key_uniform(["id"], 42, 3), 0.8).alias("n"))
    counts = {r["n"]: r["count"] for r in frame.groupBy("n").count().collect()}
    for n in range(5):
        expected = 200_000 * math.exp(-0.8) * 0.8**n / math.factorial(n)
        assert abs(counts[n] - expected) < 5 * math.sqrt(expected)
    other = spark.range(200_000).select("id", poisson_draws(key_uniform(["id"], 42, 4), 0.8).alias("m"))
    both = frame.join(other, "id").agg(F.corr("n", "m")).first()[0]
    assert abs(both) < 0.02


def test_bins_are_cut_between_values_that_are_frequent(spark):
    rows = [(k, float(k % 3), float(k), 5.0) for k in range(3_000)] + [(9_999, 1.5, 1e9, 5.0)]
    frame = spark.createDataFrame(rows, "k long, few double, many double, one double")
    edges = bin_edges(frame, ["few", "many", "one"], ["k"], 32, 42)
    assert edges["few"] == [0.5, 1.25] or edges["few"] == [0.5, 1.75] or edges["few"] == [0.5, 1.25, 1.75]
    assert 20 <= len(edges["many"]) <= 31 and edges["one"] == []
    with pytest.raises(ValueError, match="null"):
        bin_edges(frame.withColumn("few", F.lit(None).cast("double")), ["few"], ["k"], 32, 42)


def test_a_forest_is_the_mean_of_its_trees_after_reloading(spark, planted, tmp_path):
    model = fit_candidates(planted, SPEC, [SMALL_FOREST], ["k"])["forest"]
    save_model(model, str(tmp_path / "forest"))
    loaded = load_model(str(tmp_path / "forest"))
    prepared = planted
    for stage in loaded.stages[:-1]:
        prepared = stage.transform(prepared)
    for tree in loaded.stages[-1].stages[:-1]:
        prepared = tree.transform(prepared)
    names = [c for c in prepared.columns if c.startswith("__forest_")]
    assert len(names) == 5
    mean = sum((F.col(c) for c in names), F.lit(0.0)) / 5
    by_hand = {r["k"]: r["m"] for r in prepared.select("k", mean.alias("m")).collect()}
    scored = score(planted, {"forest": loaded})
    assert scored.columns == [*planted.columns, "forest"]
    for row in scored.collect():
        assert row["forest"] == pytest.approx(by_hand[row["k"]], rel=1e-12)


def test_rows_are_kept_as_they_are_partitioned(spark):
    for partitions in (1, 13):
        with kept_for_iteration(spark.range(10_000, numPartitions=partitions)) as kept:
            assert kept.rdd.getNumPartitions() == partitions
            assert kept.count() == 10_000
        assert not kept.is_cached


def test_long_descriptions_are_whole(spark):
    names = [f"feature_with_a_rather_long_name_{k:02d}" for k in range(40)]
    frame = spark.range(40).select(*[((F.col("id") % 2) * (k + 1.0)).alias(n) for k, n in enumerate(names)])
    profiles = cluster_profiles(frame, fit_clusters(frame, names, 2), names).collect()
    assert all(r["description"].count(",") == 39 for r in profiles)


def test_final_evaluation_scores_the_same_rows_once(spark, planted, tmp_path):
    train, validation, test = parts(planted)
    linear = search(train, validation, SPEC, LINEAR_CANDIDATES)
    forest = search(train, validation, SPEC, [SMALL_FOREST])
    table = compare(mean_baseline(train, validation, "y"), linear, forest).collect()
    assert [r["model"] for r in table][-1] == "mean_baseline" and len(table) == 3

    final = evaluate_finally(
        train.union(validation),
        test,
        SPEC,
        [linear.best, forest.best],
        ["k"],
        kept=["period"],
        predictions_path=str(tmp_path / "predictions"),
        model_root=str(tmp_path / "models"),
    )
    assert (final.train_rows, final.test_rows) == (450, 150)
    assert check_conservation(final.conservation) == 150
    assert final.predictions.count() == 150
    rows = {r["model"]: r for r in final.metrics.collect()}
    assert set(rows) == {BASELINE, linear.best.name, "forest"}
    assert rows[linear.best.name]["r2"] == pytest.approx(1.0, abs=1e-6)
    assert rows[BASELINE]["configuration"] == "training mean"
    mean = train.union(validation).agg(F.avg("y")).first()[0]
    assert final.predictions.select(BASELINE).distinct().first()[0] == pytest.approx(mean)
    stored = load_model(str(tmp_path / "models" / "forest")).transform(test)
    assert stored.select("k", "forest").exceptAll(final.predictions.select("k", "forest")).isEmpty()


def test_final_evaluation_refuses_repeated_keys(spark, planted):
    train, _, test = parts(planted)
    with pytest.raises(ValueError, match="test rows"):
        evaluate_finally(train, test.union(test), SPEC, [LinearCandidate("line")], ["k"])


def test_candidates_compared_are_the_fixed_ones(spark):
    assert [(c.reg_param, c.elastic_net) for c in LINEAR_CANDIDATES] == [(0.0, 0.0), (0.1, 0.0), (0.1, 0.5)]
    assert [(c.trees, c.depth) for c in FOREST_CANDIDATES] == [(25, 5), (50, 7)]
    assert FOREST_CANDIDATES[0].settings() == {"featuresCol": FEATURES, "maxDepth": 5, "maxBins": 32}
    assert FOREST_RATE == 0.8 and FOREST_CANDIDATES[0].seed == 42


def test_two_blobs_are_found_and_described(spark):
    frame = spark.range(400).select(
        (F.when(F.col("id") % 4 == 0, 100.0).otherwise(0.0) + (F.col("id") % 7)).alias("weekly_hours"),
        (F.when(F.col("id") % 4 == 0, -50.0).otherwise(0.0) + (F.col("id") % 5)).alias("age"),
    )
    sets = {"both": ["weekly_hours", "age"], "one": ["weekly_hours"]}
    found = kmeans_search(frame, sets, ks=(2, 3))
    rows = found.silhouettes.collect()
    assert found.k == 2 and len(rows) == 4
    assert [r["silhouette"] for r in rows] == sorted((r["silhouette"] for r in rows), reverse=True)
    assert {r["feature_set"] for r in rows if r["best_of_set"]} == {"both", "one"}
    profiles = cluster_profiles(frame, found.model, found.features).collect()
    assert sorted(r["n"] for r in profiles) == [100, 300]
    assert sum(r["pct"] for r in profiles) == pytest.approx(100.0)
    small = next(r for r in profiles if r["n"] == 100)
    readings = {"weekly_hours": "weekly hours alto", "age": "age bajo"}
    expected = ", ".join(readings[f] for f in found.features)
    assert small["description"] == expected[0].upper() + expected[1:]


def test_silhouettes_equal_the_evaluator(spark):
    rng = np.random.default_rng(9)
    rows = [(k, *map(float, rng.normal(size=2) + (k % 3) * 4)) for k in range(500)]
    frame = spark.createDataFrame(rows, "k long, a double, b double").repartition(5)
    found = kmeans_search(frame, {"both": ["a", "b"], "one": ["a"]}, ks=(2, 3, 4), keys=["k"])
    assert found.k == 3 and found.feature_set in ("both", "one")
    best = found.silhouettes.filter(f"feature_set = '{found.feature_set}' AND k = 3").first()["silhouette"]
    z = standardized(frame, found.features)
    clustered = found.model.transform(frame).select("k", CLUSTER).join(z, "k")
    vectors = VectorAssembler(inputCols=list(found.features), outputCol="v").transform(clustered)
    evaluator = ClusteringEvaluator(featuresCol="v", predictionCol=CLUSTER)
    assert best == pytest.approx(evaluator.evaluate(vectors), rel=1e-9)


def test_seeds_follow_the_keys_and_prefer_far_rows(spark):
    rows = [(k, 0.0 if k else 1_000.0) for k in range(400)]
    frame = spark.createDataFrame(rows, "k long, x double")
    for seed in range(3):
        profile = cluster_profiles(frame, fit_clusters(frame, ["x"], 2, seed, ["k"]), ["x"]).collect()
        assert sorted(r["n"] for r in profile) == [1, 399]


def test_fewer_values_than_clusters(spark):
    frame = spark.range(50).select((F.col("id") % 2).cast("double").alias("x"), F.lit(3.0).alias("same"))
    found = kmeans_search(frame, {"x": ["x", "same"]}, ks=(2, 5))
    assert [r["silhouette"] for r in found.silhouettes.collect()] == pytest.approx([1.0, 1.0])
    constant = kmeans_search(frame, {"same": ["same"]}, ks=(2,))
    assert constant.silhouettes.first()["silhouette"] is None
    with pytest.raises(ValueError, match="null"):
        kmeans_search(frame.withColumn("x", F.lit(None).cast("double")), {"x": ["x"]})
    with pytest.raises(ValueError, match="no rows"):
        kmeans_search(frame.limit(0), {"x": ["x"]})


def test_trees_are_fitted_to_combinations_and_equal_trees_of_all_rows(spark, monkeypatch):
    """20,000 rows of 40 combinations: no tree passes over the rows."""
    frame = spark.range(20_000).select(
        F.col("id").alias("k"), (F.col("id") % 10).cast("double").alias("x"),
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C"), F.lit("D")), (F.xxhash64("id") % 4 + 4).cast("int") % 4 + 1).alias("c"),
    ).withColumn("y", F.col("x") * F.when(F.col("c") == "A", 3.0).otherwise(-1.0) + F.pmod(F.xxhash64("k", F.lit(1)), F.lit(11)))
    seen, fit = [], RandomForestRegressor.fit

    def watched(self, rows):
        seen.append(rows.count())
        return fit(self, rows)

    monkeypatch.setattr(RandomForestRegressor, "fit", watched)
    model = fit_candidates(frame, SPEC, [SMALL_FOREST], ["k"])["forest"]
    assert len(seen) == 5 and max(seen) <= 40

    rows = frame
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    scored = rows
    for number, tree in enumerate(model.stages[-1].stages[:-1]):
        drawn = rows.withColumn("w", poisson_draws(key_uniform(["k"], 42, number), FOREST_RATE).cast("double"))
        plain = RandomForestRegressor(
            labelCol="y", weightCol="w", numTrees=1, bootstrap=False, featureSubsetStrategy="onethird",
            seed=42 + number, predictionCol=f"plain_{number}", **SMALL_FOREST.settings(),
        )
        scored = tree.transform(fit(plain, drawn.filter("w > 0")).transform(scored))
    apart = [F.max(F.abs(F.col(f"plain_{n}") - F.col(f"__forest_{n}"))) for n in range(5)]
    assert max(scored.agg(*apart).first()) < 1e-9


def test_clustered_points_are_packed_by_the_batch(spark):
    """Passes read a binary value per batch, which holds each row's columns, and none is lost."""
    frame = spark.range(0, 25_000, numPartitions=2).selectExpr("id", "id % 7 AS a", "id AS b")
    points = clustering._points(frame, ["a", "b"], ["id"], 1, 42)
    values = [r["points"] for r in clustering._packed(points).collect()]
    assert 1 < len(values) < 100
    found = np.concatenate([np.frombuffer(v).reshape(2, -1) for v in values], axis=1)
    wanted = np.array(points.rows.select(*points.columns.values()).collect()).T
    assert found.shape == (2, 25_000)
    assert np.array_equal(np.sort(found, axis=1), np.sort(wanted, axis=1))
