"""Every operator of the library as a query over the given tables.

Doubles are rounded to four decimals, because engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.functions import is_missing, key_hash, row_fingerprint
from fieldbook.learning.clustering import (
    cluster_profiles,
    kmeans_search,
    silhouette,
    standardized,
)
from fieldbook.learning.features import FeatureSpec
from fieldbook.learning.regression import (
    FOREST_CANDIDATES,
    LINEAR_CANDIDATES,
    ForestCandidate,
    LinearCandidate,
    compare,
    fit_candidates,
    score,
    search,
)
from fieldbook.operators import association, audit, errors, findings, profile, sampling, sketches
from fieldbook.operators.funnel import exclusion_audit, observed_survivors, passes
from fieldbook.operators.histogram import histogram, log_histogram
from fieldbook.operators.quantiles import approx_quantiles
from fieldbook.operators.small import local_frame
from fieldbook.operators.splits import split_counts
from fieldbook.plans.evaluation import FinalEvaluation, evaluate_finally
from fieldbook.sources.runs import scratch_path
from fieldbook.sources.tables import (
    load_model,
    load_periods,
    materialise,
    read_predictions,
    read_result_table,
    save_model,
    union_by_name,
    write_by_period,
    write_result_table,
)

from . import bindings as b

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(frame: DataFrame, digits: int = 4) -> DataFrame:
    return frame.select(
        *[
            F.round(name, digits).alias(name) if kind == "double" else F.col(name)
            for name, kind in frame.dtypes
        ]
    )


# --- Expressions and harmonisation ------------------------------------------------------


@query
def normalize_codes(spark, sf_dir):
    return b.harmonised(spark, sf_dir).select(*b.RAW_KEYS, "job", "level", "domain")


@query
def parse_numeric(spark, sf_dir):
    frame = b.harmonised(spark, sf_dir)
    return frame.select(*b.RAW_KEYS, *b.RULES.numbers)


@query
def label_codes(spark, sf_dir):
    frame = b.harmonised(spark, sf_dir)
    return frame.select(*b.RAW_KEYS, "job_label", "level_label", "domain_label")


@query
def composite_duration(spark, sf_dir):
    frame = b.harmonised(spark, sf_dir)
    return frame.select(*b.RAW_KEYS, "tenure_years", "tenure_months", "tenure")


@query
def harmonize(spark, sf_dir):
    return b.harmonised(spark, sf_dir)


@query
def row_fingerprints(spark, sf_dir):
    frame = b.raw(spark, sf_dir)
    return frame.select(*b.RAW_KEYS, row_fingerprint(b.RAW_TEXTS).alias("fingerprint"))


@query
def seeded_key_hash(spark, sf_dir):
    frame = b.lines(spark, sf_dir)
    return frame.select(*b.KEYS, key_hash(b.KEYS, 42, "md5").alias("key_hash"))


# --- Filters, splits and periods --------------------------------------------------------


@query
def exclusion_funnel(spark, sf_dir):
    return exclusion_audit(b.harmonised(spark, sf_dir), b.criteria())


@query
def eligible_rows(spark, sf_dir):
    kept = observed_survivors(b.harmonised(spark, sf_dir), b.criteria())
    return kept.select(*b.RAW_KEYS, "age", "pay", "tenure", "hours", "job", "level")


@query
def split_rows(spark, sf_dir):
    return split_counts(b.lines(spark, sf_dir), b.SPLIT)


@query
def union_periods(spark, sf_dir):
    columns = ["period", "l_quantity", b.LABEL]
    parts = [
        b.split_lines(spark, sf_dir, name).select(*(columns if i % 2 else reversed(columns)))
        for i, name in enumerate(b.SPLIT.members())
    ]
    totals = union_by_name(parts).groupBy("period").agg(
        F.count("*").alias("n"),
        F.sum("l_quantity").alias("quantity"),
        F.sum(b.LABEL).alias("price"),
    )
    return rounded(totals, 2)


@query
def contract_ingest(spark, sf_dir):
    """Text sources ingested under their contracts, and met again as published."""
    _, audits = b.ingested(spark, sf_dir)
    return union_by_name([a.select(F.lit(run).alias("run"), "*") for run, a in enumerate(audits, 1)])


@query
def ingested_periods(spark, sf_dir):
    """What the published periods hold: text as delivered, trimmed, with its provenance."""
    store, audits = b.ingested(spark, sf_dir)
    periods = [row["period"] for row in audits[1].collect()]
    return (
        load_periods(spark, store, periods)
        .groupBy("period", "source_file", "file_year", "calendar_quarter")
        .agg(
            F.count("*").alias("n"),
            F.count_distinct("household").alias("households"),
            F.count_if(F.col("active_txt").isNull()).alias("null_active"),
            F.count_if(F.col("active_txt") == "").alias("empty_active"),
            F.sum(F.length("pay_txt")).alias("pay_length"),
            F.count_if(is_missing("age_txt") | F.col("age_txt").startswith(" ")).alias("bad_age"),
            F.count_if(F.col("domain_code") == "2").alias("domain_two"),
        )
    )


# --- Quality audits ---------------------------------------------------------------------


@query
def missingness(spark, sf_dir):
    return rounded(audit.missingness(b.raw(spark, sf_dir), [*b.RAW_KEYS, *b.RAW_TEXTS]))


@query
def counts_by_period(spark, sf_dir):
    frame = b.harmonised(spark, sf_dir)
    return rounded(audit.counts_by_period(frame, "period", passes(b.criteria())))


@query
def compare_period_counts(spark, sf_dir):
    frame = b.harmonised(spark, sf_dir)
    after = observed_survivors(frame, b.criteria())
    return rounded(audit.compare_counts(frame, after, "period"))


@query
def retention_total(spark, sf_dir):
    frame = b.harmonised(spark, sf_dir)
    counts = audit.counts_by_period(frame, "period", passes(b.criteria()))
    return rounded(audit.retention_total(counts))


@query
def duplicate_keys(spark, sf_dir):
    return audit.duplicate_keys(b.lines(spark, sf_dir), ["l_orderkey", "l_linenumber"])


@query
def duplicate_raw_keys(spark, sf_dir):
    return audit.duplicate_keys(b.raw(spark, sf_dir), b.RAW_KEYS)


@query
def key_uniqueness(spark, sf_dir):
    frame = b.lines(spark, sf_dir)
    checked = {
        "order_line": ["l_orderkey", "l_linenumber"],
        "full_key": b.KEYS,
    }
    return union_by_name(
        [
            audit.key_uniqueness(frame, keys).select(F.lit(name).alias("key_name"), "*")
            for name, keys in checked.items()
        ]
    )


@query
def observed_codes(spark, sf_dir):
    return audit.observed_codes(b.raw(spark, sf_dir), "period", "src_quarter")


# --- Description ------------------------------------------------------------------------

PROFILED = [b.LABEL, *b.NUMBERS]


@query
def numeric_profile(spark, sf_dir):
    return rounded(profile.numeric_profile(b.lines(spark, sf_dir), PROFILED, exact=True))


@query
def approx_profile(spark, sf_dir):
    return rounded(profile.numeric_profile(b.lines(spark, sf_dir), PROFILED))


@query
def approx_period_quantiles(spark, sf_dir):
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    return approx_quantiles(b.lines(spark, sf_dir), b.LABEL, probs, ["period"])


SHARES = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
# Rank errors that a sketch may have: the sample of a sketch, and the bound that is checked.
SKETCH_ERROR = 0.005


def _stored_sketches(spark, sf_dir):
    """Sketches of every profiled column by period, stored, as a pipeline would keep them."""
    made = sketches.quantile_sketches(b.lines(spark, sf_dir), PROFILED, ["period"])
    path = scratch_path(spark, "sketches")
    write_by_period(made, path)
    return spark.read.parquet(path).withColumn("period", F.col("period").cast("string"))


def _rank_checks(spark, frame, kind, table):
    """Whether each quantile of (variable, *shares) rows stands where its probability says."""
    proposed = {(row["variable"], p): row[p] for row in table.collect() for p in SHARES}
    ranks = sketches.true_ranks(frame, proposed)
    rows = [
        (kind, variable, p, total, sketches.rank_error(SHARES[p], below, upto, total) <= SKETCH_ERROR)
        for (variable, p), (below, upto, total) in ranks.items()
    ]
    return local_frame(spark, rows, "method string, variable string, share string, n long, within boolean")


@query
def sketched_profile_ranks(spark, sf_dir):
    """Quantiles of all periods from stored sketches, and of one pass, held to true ranks."""
    frame = b.lines(spark, sf_dir)
    merged = sketches.merged_sketches(_stored_sketches(spark, sf_dir))
    stored = sketches.sketched_quantiles(merged, SHARES)
    wide = [
        approx_quantiles(frame, name, SHARES).select(F.lit(name).alias("variable"), *SHARES)
        for name in PROFILED
    ]
    return union_by_name(
        [
            _rank_checks(spark, frame, "stored sketches", stored),
            _rank_checks(spark, frame, "one pass", union_by_name(wide)),
        ]
    )


@query
def sketched_period_ranks(spark, sf_dir):
    """Quantiles of each year, merged from its quarters' sketches, held to true ranks."""
    yearly = sketches.merged_sketches(
        _stored_sketches(spark, sf_dir).withColumn("year", F.substring("period", 1, 4)), ["year"]
    )
    found = sketches.sketched_quantiles(yearly, SHARES, ["year"])
    named = [F.struct(F.lit(p).alias("share"), F.lit(v).alias("prob"), F.col(p).alias("value")) for p, v in SHARES.items()]
    asked = found.filter(F.col("variable") == b.LABEL).select("year", F.inline(F.array(*named)))
    rows = b.lines(spark, sf_dir).select(F.year("l_shipdate").cast("string").alias("year"), b.LABEL)
    counted = rows.join(asked, "year").groupBy("year", "share").agg(
        F.count("*").alias("n"),
        F.count_if(F.col(b.LABEL) < F.col("value")).alias("below"),
        F.count_if(F.col(b.LABEL) <= F.col("value")).alias("upto"),
        F.max("prob").alias("prob"),
    )
    error = F.greatest(F.lit(0.0), F.col("below") / F.col("n") - F.col("prob"), F.col("prob") - F.col("upto") / F.col("n"))
    return counted.select("year", "share", "n", (error <= SKETCH_ERROR).alias("within"))


@query
def skew_reading(spark, sf_dir):
    table = profile.numeric_profile(b.lines(spark, sf_dir), PROFILED, exact=True)
    return rounded(profile.skew_reading(table))


@query
def category_distribution(spark, sf_dir):
    return rounded(profile.category_distribution(b.model_lines(spark, sf_dir), b.CATEGORIES))


@query
def median_by_group(spark, sf_dir):
    # Passed over several times: joined once, and only what is asked for stored.
    frame = materialise(b.model_lines(spark, sf_dir).select(*b.CATEGORIES, b.LABEL), name="median-lines")
    return rounded(profile.median_by_group(frame, b.CATEGORIES, b.LABEL, exact=True))


@query
def period_summary(spark, sf_dir):
    return rounded(profile.period_summary(b.lines(spark, sf_dir), "period", b.LABEL, exact=True))


@query
def pearson_matrix(spark, sf_dir):
    return rounded(association.pearson_matrix(b.lines(spark, sf_dir), PROFILED))


@query
def correlation_rank(spark, sf_dir):
    matrix = association.pearson_matrix(b.lines(spark, sf_dir), PROFILED)
    return rounded(association.correlation_rank(matrix, b.LABEL))


@query
def price_histogram(spark, sf_dir):
    return rounded(histogram(b.lines(spark, sf_dir), b.LABEL))


@query
def price_log_histogram(spark, sf_dir):
    return rounded(log_histogram(b.lines(spark, sf_dir), b.LABEL), 2)


@query
def hash_sample(spark, sf_dir):
    frame = b.lines(spark, sf_dir).select(*b.KEYS, "period", b.LABEL)
    return sampling.hash_sample(frame, b.KEYS, algorithm="md5")


@query
def comparison_sample(spark, sf_dir):
    frame = b.predictions(spark, sf_dir)
    return rounded(
        sampling.comparison_sample(
            frame, b.KEYS, b.LABEL, b.TWO_MODELS, algorithm="md5"
        )
    )


# --- Metrics and error analytics --------------------------------------------------------


@query
def regression_metrics(spark, sf_dir):
    return rounded(errors.regression_metrics(b.predictions(spark, sf_dir), b.LABEL, b.MODELS))


@query
def mean_baseline(spark, sf_dir):
    train = b.split_lines(spark, sf_dir, "train")
    validation = b.split_lines(spark, sf_dir, "validation")
    return rounded(errors.mean_baseline(train, validation, b.LABEL))


@query
def model_comparison(spark, sf_dir):
    frame = b.predictions(spark, sf_dir, "validation")
    metrics = errors.regression_metrics(frame, b.LABEL, b.MODELS)
    return rounded(metrics.select("model", "mae", "rmse", "r2").orderBy("rmse", "model"))


@query
def long_errors(spark, sf_dir):
    frame = b.predictions(spark, sf_dir)
    return rounded(errors.long_errors(frame, b.KEYS, b.LABEL, b.TWO_MODELS))


def _by_priority(spark, sf_dir):
    frame = b.predictions(spark, sf_dir, with_priority=True)
    return errors.error_by_group(frame, "o_orderpriority", b.LABEL, b.TWO_MODELS, b.PRIORITIES)


def _bands_of(frame):
    banded, thresholds = errors.value_bands(frame, b.LABEL, exact=True)
    return errors.error_by_band(banded, thresholds, b.LABEL, b.TWO_MODELS)


def _by_band(spark, sf_dir):
    return _bands_of(b.predictions(spark, sf_dir))


def _metrics_of(frame):
    return errors.regression_metrics(frame, b.LABEL, b.MODELS)


def _metrics(spark, sf_dir, split="test"):
    return _metrics_of(b.predictions(spark, sf_dir, split))


@query
def error_by_group(spark, sf_dir):
    return rounded(_by_priority(spark, sf_dir))


@query
def value_bands(spark, sf_dir):
    frame = b.predictions(spark, sf_dir).select(*b.KEYS, b.LABEL)
    banded, thresholds = errors.value_bands(frame, b.LABEL, exact=True)
    return banded.join(thresholds, "band", "left")


@query
def error_by_band(spark, sf_dir):
    return rounded(_by_band(spark, sf_dir))


@query
def stored_error_table(spark, sf_dir):
    """The same table written as CSV and read with the types it had."""
    table, path = _by_band(spark, sf_dir), scratch_path(spark, "error-by-band")
    write_result_table(table, path)
    return rounded(read_result_table(spark, path, table.schema))


@query
def residual_summary(spark, sf_dir):
    frame = b.predictions(spark, sf_dir)
    return rounded(errors.residual_summary(frame, b.LABEL, b.TWO_MODELS, exact=True))


@query
def score_join(spark, sf_dir):
    frame = b.predictions(spark, sf_dir)
    left = frame.select(*b.KEYS, b.LABEL, "pred_segment")
    right = frame.select(*b.KEYS, "pred_line")
    return rounded(errors.join_predictions(left, right, b.KEYS, "pred_line"))


@query
def row_conservation(spark, sf_dir):
    test = b.split_lines(spark, sf_dir, "test")
    return audit.row_conservation(test, b.predictions(spark, sf_dir), b.KEYS, b.TWO_MODELS)


@query
def metric_consistency(spark, sf_dir):
    """Errors measured on rows as they are scored, against those of the rows as stored."""
    scored = b.predictions(spark, sf_dir)
    metrics = errors.regression_metrics(scored, b.LABEL, b.TWO_MODELS)
    stored = materialise(scored.select(*b.KEYS, b.LABEL, *b.TWO_MODELS.values()), name="scored")
    summary = errors.residual_summary(stored, b.LABEL, b.TWO_MODELS)
    return rounded(errors.metric_differences(metrics, summary, "mae"))


# --- Findings ---------------------------------------------------------------------------


@query
def winner_runner_up(spark, sf_dir):
    return rounded(findings.best_models(_metrics(spark, sf_dir), b.BASELINE))


@query
def baseline_gain(spark, sf_dir):
    return rounded(findings.baseline_gain(_metrics(spark, sf_dir), b.BASELINE))


@query
def validation_to_test(spark, sf_dir):
    read = b.stored_predictions(spark, sf_dir)
    return rounded(
        findings.validation_to_test(_metrics_of(read("validation")), _metrics_of(read()), b.BASELINE)
    )


@query
def winner_agreement(spark, sf_dir):
    read = b.stored_predictions(spark, sf_dir)
    return findings.winner_agreement(_metrics_of(read("validation")), _metrics_of(read()), b.BASELINE)


@query
def extreme_groups(spark, sf_dir):
    return rounded(findings.extreme_groups(_by_priority(spark, sf_dir)))


@query
def scale_check(spark, sf_dir):
    return rounded(findings.scale_check(_by_priority(spark, sf_dir)))


@query
def tail_contrast(spark, sf_dir):
    low, high = errors.BAND_LABELS[0], errors.BAND_LABELS[-1]
    return rounded(findings.tail_contrast(_by_band(spark, sf_dir), low, high))


@query
def winner_in_tail(spark, sf_dir):
    frame = b.stored_predictions(spark, sf_dir)()
    return rounded(
        findings.winner_in_tail(_metrics_of(frame), _bands_of(frame), b.BASELINE, errors.BAND_LABELS[-1])
    )


def _dimension_errors(spark, sf_dir):
    banded, _ = errors.value_bands(b.stored_predictions(spark, sf_dir)(), b.LABEL, exact=True)
    dimensions = {"priority": "o_orderpriority", "return_flag": "l_returnflag", "band": "band"}
    return errors.errors_by_dimensions(banded, dimensions, b.LABEL, b.TWO_MODELS)


@query
def error_by_dimension(spark, sf_dir):
    """Errors by several groupings from one aggregate."""
    return rounded(_dimension_errors(spark, sf_dir))


@query
def overall_extremes(spark, sf_dir):
    return rounded(findings.extremes_by_dimension(_dimension_errors(spark, sf_dir)))


@query
def tail_residual(spark, sf_dir):
    """Mean residual overall and in the highest tenth, over all test rows."""
    frame = b.stored_predictions(spark, sf_dir)()
    return rounded(findings.tail_residual(frame, b.LABEL, b.TWO_MODELS))


@query
def sample_tail_residual(spark, sf_dir):
    sample = sampling.comparison_sample(
        b.predictions(spark, sf_dir), b.KEYS, b.LABEL, b.TWO_MODELS, algorithm="md5"
    )
    return rounded(findings.sample_tail_residual(sample, b.LABEL, b.TWO_MODELS))


@query
def wide_group_errors(spark, sf_dir):
    return rounded(findings.wide_group_errors(_by_priority(spark, sf_dir), list(b.TWO_MODELS)))


# --- Machine learning -------------------------------------------------------------------


@query
def linear_univariate(spark, sf_dir):
    frame = b.lines(spark, sf_dir).select("l_quantity", b.LABEL)
    vectors = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(frame)
    model = LinearCandidate("line").estimator(b.LABEL, "line").fit(vectors)
    return rounded(
        local_frame(
            spark,
            [(float(model.coefficients[0]), float(model.intercept))],
            "slope double, intercept double",
        )
    )


@query
def category_indices(spark, sf_dir):
    """Categories numbered by training frequency; the test rows are only looked up."""
    fitted = b.FEATURES.fit(b.model_lines(spark, sf_dir, "train"))
    indexed = fitted.transform(b.model_lines(spark, sf_dir, "test"))
    return indexed.select(
        *b.KEYS, *[F.col(f"{c}_idx").cast("int").alias(f"{c}_idx") for c in b.CATEGORIES]
    )


@query
def standardized_features(spark, sf_dir):
    frame = b.lines(spark, sf_dir).select(*b.KEYS, *PROFILED[1:])
    return rounded(standardized(frame, PROFILED[1:]))


@query
def segment_silhouette(spark, sf_dir):
    flags = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1)
    frame = b.lines(spark, sf_dir).withColumn("segment", flags.otherwise(2))
    value = silhouette(frame, PROFILED, "segment")
    return rounded(local_frame(spark, [(value,)], "silhouette double"))


LINE = FeatureSpec(numeric=["l_quantity"], categorical=[], label=b.LABEL)


@query
def linear_search_line(spark, sf_dir):
    """One predictor and no regularisation, for which least squares has a closed form."""
    read = b.stored_model_lines(spark, sf_dir)
    found = search(read("train"), read("validation"), LINE, [LinearCandidate("line")], b.KEYS)
    baseline = errors.mean_baseline(read("train"), read("validation"), b.LABEL)
    configured = compare(baseline, found).join(
        found.metrics.select("model", "configuration", "n"), "model", "left"
    )
    return rounded(configured)


@query
def final_line(spark, sf_dir):
    """Refit on train and validation, stored predictions, metrics of the test rows."""
    read = b.stored_model_lines(spark, sf_dir)
    train, test = read("train", "validation"), read("test")
    final = evaluate_finally(train, test, LINE, [LinearCandidate("line")], b.KEYS, kept=["period"])
    stored = read_predictions(spark, final.predictions_path, [*b.KEYS, b.LABEL, "line", "residual_line"])
    return rounded(stored.select(*b.KEYS, "period", b.LABEL, b.BASELINE, "line", "residual_line"))


DISCOUNT = FeatureSpec(numeric=["l_discount"], categorical=[], label=b.LABEL)


@query
def reloaded_line(spark, sf_dir):
    """The final pipeline saved, loaded, and asked for the test rows."""
    read = b.stored_model_lines(spark, sf_dir)
    fitted = fit_candidates(read("train", "validation"), LINE, [LinearCandidate("line")], b.KEYS)
    path = scratch_path(spark, "line-model")
    save_model(fitted["line"], path)
    scored = score(read("test"), {"line": load_model(path)})
    return rounded(scored.select(*b.KEYS, "period", b.LABEL, "line"))


@query
def forest_stump(spark, sf_dir):
    """One tree of one split over all rows: the cut of least squared error."""
    frame = b.lines(spark, sf_dir).select(*b.KEYS, "l_discount", b.LABEL)
    models = fit_candidates(frame, DISCOUNT, [ForestCandidate("stump", 1, 1)], b.KEYS)
    scored = score(frame, models).groupBy("l_discount").agg(F.max("stump").alias("stump"))
    return rounded(scored)


@query
def forest_search_stumps(spark, sf_dir):
    """A search of forests whose bagged trees split once, so that SQL can follow each."""
    read = b.stored_model_lines(spark, sf_dir)
    candidates = [ForestCandidate(f"stumps_{n}", n, 1, algorithm="md5") for n in (1, 2, 5)]
    return rounded(search(read("train"), read("validation"), DISCOUNT, candidates, b.KEYS).metrics)


@query
def segment_clusters(spark, sf_dir):
    """Two groups far apart are the two clusters; profiles and readings by their mean."""
    far = F.when(F.col("l_returnflag") == "A", 10_000.0).otherwise(0.0)
    frame = b.lines(spark, sf_dir).select(*b.KEYS, (far + F.col("l_quantity")).alias("spread"))
    found = kmeans_search(frame, {"spread": ["spread"]}, ks=(2,), keys=b.KEYS)
    profiles = cluster_profiles(frame, found.model, found.features)
    return rounded(profiles.select("n", "spread_mean", "pct", "description"))


@query
def cluster_choice(spark, sf_dir):
    """Three groups far apart: three clusters have the best silhouette."""
    far = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 10_000.0).otherwise(30_000.0)
    frame = b.lines(spark, sf_dir).select(
        *b.KEYS, (far + F.col("l_quantity")).alias("spread"), (far + 100 * F.col("l_tax")).alias("drift")
    )
    found = kmeans_search(frame, {"both": ["spread", "drift"]}, ks=(2, 3, 4), keys=b.KEYS)
    best = findings.best_row(found.silhouettes, "silhouette", largest=True, ties=["k"])
    return rounded(best.withColumn("same_as_model", F.lit(found.k) == F.col("k")))


@query
def feature_slots(spark, sf_dir):
    """What the vectors hold: numbers, and a slot per category, the unseen one included."""
    train = b.model_lines(spark, sf_dir, "train").filter("o_orderpriority <> '5-LOW'")
    spec = FeatureSpec(["l_quantity"], ["l_returnflag", "o_orderpriority"], b.LABEL)
    vectors = spec.fit(train).transform(b.model_lines(spark, sf_dir, "test"))
    slots = vector_to_array(F.col("features"))
    return vectors.select(
        *b.KEYS,
        F.size(slots).alias("width"),
        slots[0].alias("quantity"),
        *[slots[i + 1].cast("int").alias(f"flag_{i}") for i in range(4)],
        *[slots[i + 5].cast("int").alias(f"priority_{i}") for i in range(5)],
    )


@query
def linear_search(spark, sf_dir):
    read = b.stored_model_lines(spark, sf_dir)
    return search(read("train"), read("validation"), b.FEATURES, LINEAR_CANDIDATES, b.KEYS).metrics


@query
def forest_search(spark, sf_dir):
    read = b.stored_model_lines(spark, sf_dir)
    return search(read("train"), read("validation"), b.FEATURES, FOREST_CANDIDATES, b.KEYS).metrics


def _searches(read):
    """The linear and the forest search, on the same train and validation rows."""
    train, validation = read("train"), read("validation")
    return [
        search(train, validation, b.FEATURES, candidates, b.KEYS)
        for candidates in (LINEAR_CANDIDATES, FOREST_CANDIDATES)
    ]


def _final(read, candidates) -> FinalEvaluation:
    train, test = read("train", "validation"), read("test")
    return evaluate_finally(train, test, b.FEATURES, candidates, b.KEYS, kept=["period"])


@query
def final_scoring(spark, sf_dir):
    read = b.stored_model_lines(spark, sf_dir)
    linear, forest = _searches(read)
    return _final(read, [linear.best, forest.best]).predictions


@query
def final_comparison(spark, sf_dir):
    read = b.stored_model_lines(spark, sf_dir)
    linear, forest = _searches(read)
    baseline = errors.mean_baseline(read("train"), read("validation"), b.LABEL)
    chosen = compare(baseline, linear, forest)
    final = _final(read, [linear.best, forest.best])
    return findings.validation_to_test(chosen, final.metrics, b.BASELINE)


CLUSTERED = {
    "without_price": b.NUMBERS,
    "with_price": [*b.NUMBERS, b.LABEL],
}


@query
def kmeans_silhouettes(spark, sf_dir):
    return kmeans_search(b.lines(spark, sf_dir), CLUSTERED, keys=b.KEYS).silhouettes


@query
def kmeans_profiles(spark, sf_dir):
    frame = b.lines(spark, sf_dir)
    found = kmeans_search(frame, CLUSTERED, keys=b.KEYS)
    return cluster_profiles(frame, found.model, found.features)
