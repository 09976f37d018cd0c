from __future__ import annotations

import math
import random
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldbook.functions import ordered_bits
from fieldbook.operators import association, profile, sampling, sketches
from fieldbook.operators.histogram import histogram, log_histogram
from fieldbook.operators.quantiles import (
    approx_quantiles,
    exact_column_quantiles,
    exact_quantiles,
    interpolated_quantile,
)
from fieldbook.operators.small import holding, settled

PROBS = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p100": 1.0}


def brute(numbers, prob):
    ordered = sorted(numbers)
    return ordered[max(1, math.ceil(round(prob * len(ordered), 9))) - 1]


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    data=st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-5, 5))),
        min_size=1,
        max_size=60,
    )
)
def test_exact_quantiles_equal_sorting_with_ties_and_nulls(spark, data):
    frame = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in data], "g string, v double")
    found = {row["g"]: row for row in exact_quantiles(frame, "v", PROBS, ["g"]).collect()}
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(float(v))
    assert set(found) == set(groups)
    for g, numbers in groups.items():
        for name, prob in PROBS.items():
            assert found[g][name] == brute(numbers, prob)


@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_exact_quantiles_do_not_rest_on_the_sketch(spark, accuracy):
    rng = random.Random(7)
    groups = {"big": 30_000, "small": 300, "one": 1}
    rows = [(g, rng.lognormvariate(0, 3)) for g, n in groups.items() for _ in range(n)]
    rows += [("big", 1.0)] * 20_000 + [("big", math.nan)] * 5
    frame = spark.createDataFrame(rows, "g string, v double").repartition(7)
    by_group = exact_quantiles(frame, "v", PROBS, ["g"], accuracy).collect()
    assert len(by_group) == 3
    for row in by_group:
        numbers = [v for g, v in rows if g == row["g"] and not math.isnan(v)]
        for name, prob in PROBS.items():
            assert row[name] == brute(numbers, prob), (row["g"], name)
    whole = exact_quantiles(frame, "v", PROBS, accuracy=accuracy).first()
    everything = [v for _, v in rows if not math.isnan(v)]
    assert [whole[n] for n in PROBS] == [brute(everything, p) for p in PROBS.values()]


def test_exact_column_quantiles_side_by_side(spark):
    frame = spark.range(1, 1001).select(
        F.col("id").cast("double").alias("x"),
        (F.col("id") % 3).alias("y"),
        F.lit(None).cast("double").alias("nothing"),
    )
    found = {r["variable"]: r for r in exact_column_quantiles(frame, ["x", "y", "nothing"], PROBS).collect()}
    assert (found["x"]["p25"], found["x"]["p50"], found["x"]["p95"]) == (250.0, 500.0, 950.0)
    assert found["y"]["p50"] == 1.0
    assert found["nothing"]["p50"] is None
    assert exact_quantiles(frame, "nothing", PROBS).count() == 0


def test_approximate_quantiles_keep_their_rank_error(spark):
    frame = spark.range(100_000).select(F.col("id").cast("double").alias("v")).repartition(9)
    row = approx_quantiles(frame, "v", PROBS, accuracy=1_000).first()
    for name, prob in PROBS.items():
        assert abs(row[name] - prob * 100_000) <= 100 + 1


def test_profile_modes_agree_and_keep_column_order(spark):
    frame = spark.range(1, 101).select(
        F.col("id").cast("double").alias("b"), (F.col("id") * 2).alias("a")
    )
    exact = profile.numeric_profile(frame, ["b", "a"], exact=True).collect()
    approximate = profile.numeric_profile(frame, ["b", "a"]).collect()
    assert exact == approximate
    first = exact[0]
    assert [r["variable"] for r in exact] == ["b", "a"]
    assert (first["n"], first["mean"], first["median"], first["p95"]) == (100, 50.5, 50.0, 95.0)
    assert first["std"] == pytest.approx(np.std(np.arange(1, 101), ddof=1))


def test_profile_of_an_empty_frame(spark):
    frame = spark.createDataFrame([], "a double")
    assert profile.numeric_profile(frame, ["a"], exact=True).count() == 0
    assert profile.numeric_profile(frame, ["a"]).count() == 0


def test_skew_reading(spark):
    frame = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (9.0, 3.0)], "long_tail double, even double")
    table = profile.skew_reading(profile.numeric_profile(frame, ["long_tail", "even"]))
    assert {r["variable"]: r["skew"] for r in table.collect()} == {"long_tail": "positive", "even": "symmetric"}


def test_null_is_a_category_and_shares_sum_to_one_hundred(spark):
    frame = spark.createDataFrame(
        [("x", 1), ("x", 2), (None, 2), ("y", None)], "c string, d int"
    )
    rows = profile.category_distribution(frame, ["c", "d"]).collect()
    assert [(r["variable"], r["category"], r["n"]) for r in rows] == [
        ("c", "x", 2), ("c", None, 1), ("c", "y", 1),
        ("d", "2", 2), ("d", None, 1), ("d", "1", 1),
    ]
    assert sum(r["pct"] for r in rows) == pytest.approx(200.0)


def test_grouped_medians_break_ties_by_category(spark):
    frame = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 9.0), (None, 1.0)], "g string, v double")
    for exact in (True, False):
        rows = profile.median_by_group(frame, ["g"], "v", exact=exact).collect()
        assert [r["category"] for r in rows] == ["c", "a", "b", None]
    periods = profile.period_summary(frame, "g", "v", exact=True).collect()
    assert [(r["g"], r["n"], r["median"]) for r in periods] == [(None, 1, 1.0), ("a", 1, 2.0), ("b", 1, 2.0), ("c", 1, 9.0)]


def test_pearson_uses_complete_rows(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(200, 3))
    data[:, 2] += data[:, 0]
    rows = [tuple(map(float, r)) for r in data]
    frame = spark.createDataFrame(rows + [(None, 1.0, 2.0)], "x double, y double, z double")
    matrix = association.pearson_matrix(frame, ["x", "y", "z"])
    found = {(r["var_a"], r["var_b"]): r["r"] for r in matrix.collect()}
    expected = np.corrcoef(data.T)
    for i, a in enumerate("xyz"):
        for j, b in enumerate("xyz"):
            assert found[a, b] == pytest.approx(expected[i, j])
    ranked = association.correlation_rank(matrix, "x").collect()
    assert [r["variable"] for r in ranked][0] == "z"


def test_histograms_match_numpy_and_list_empty_bins(spark):
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.lognormal(3, 1, 500), [5_000.0]])
    frame = spark.createDataFrame([(float(v),) for v in data] + [(None,), (math.nan,), (math.inf,)], "v double")
    rows = histogram(frame, "v", 20).collect()
    assert [r["n"] for r in rows] == list(np.histogram(data, 20)[0])
    assert rows[0]["lower"] == data.min() and rows[-1]["upper"] == pytest.approx(data.max())
    logs = log_histogram(frame.filter("v < 1e9"), "v", 10).collect()
    edges = np.logspace(np.log10(data.min()), np.log10(data.max()), 11)
    assert sum(r["n"] for r in logs) == len(data)
    assert [r["lower"] for r in logs] == pytest.approx(list(edges[:-1]))


def test_histogram_of_a_constant(spark):
    frame = spark.createDataFrame([(4.0,)] * 6, "v double")
    rows = histogram(frame, "v", 2).collect()
    assert [(r["lower"], r["upper"], r["n"]) for r in rows] == [(3.5, 4.0, 0), (4.0, 4.5, 6)]


@pytest.mark.parametrize("algorithm", ["xxhash64", "md5"])
def test_sample_does_not_depend_on_partitioning_or_the_prefilter(spark, algorithm):
    frame = spark.range(60_000).withColumnRenamed("id", "k")
    kept = [
        [r["k"] for r in sampling.hash_sample(f, ["k"], 200, 42, algorithm).collect()]
        for f in (frame.repartition(2), frame.repartition(7))
    ]
    assert kept[0] == kept[1] and len(set(kept[0])) == 200
    from fieldbook.functions import key_hash

    whole = frame.orderBy(key_hash(["k"], 42, algorithm), "k").limit(200)
    assert kept[0] == [r["k"] for r in whole.collect()]
    other = sampling.hash_sample(frame, ["k"], 200, 43, algorithm)
    assert {r["k"] for r in other.collect()} != set(kept[0])


def test_sample_of_a_frame_with_one_repeated_key(spark):
    frame = spark.range(30_000).select(F.lit(1).alias("k"))
    assert sampling.hash_sample(frame, ["k"], 100).count() == 100


def test_samples_have_no_ceiling(spark):
    assert sampling.hash_sample(spark.range(10), ["id"], 20_000).count() == 10
    assert sampling.hash_sample(spark.range(9_000), ["id"], 7_000).count() == 7_000
    assert sampling.hash_sample(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("prob", [1 / 3, 2 / 3, 0.1])
def test_grouped_quantiles_take_any_probability(spark, prob):
    """Products of a count and a long numerator are beyond 64 bits."""
    frame = spark.range(20_000).select((F.col("id") % 2).alias("g"), ((F.col("id") * 7919) % 10_007).cast("double").alias("v"))
    values: dict = {}
    for row in frame.collect():
        values.setdefault(row["g"], []).append(row["v"])
    found = {r["g"]: r["q"] for r in exact_quantiles(frame, "v", {"q": prob}, ["g"]).collect()}
    from fractions import Fraction

    for g, own in values.items():
        share = Fraction(str(prob))
        rank = max(1, math.ceil(share * len(own)))
        assert found[g] == sorted(own)[rank - 1]


def test_ordered_bits_are_those_of_the_double(spark):
    rng = random.Random(2)
    values = [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(3_000)]
    values += [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 2.0**-1022, 1.7976931348623157e308]
    values += [2.0**k for k in range(-1074, 1024, 7)] + [2.0**k * (1 - 2**-53) for k in range(-1021, 1024, 7)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for row in frame.select("v", ordered_bits("v").alias("bits")).collect():
        if row["v"] is None or math.isnan(row["v"]):
            assert row["bits"] is None
        else:
            size = struct.unpack("q", struct.pack("d", abs(row["v"])))[0]
            assert row["bits"] == (-size if row["v"] < 0 else size)


def test_selection_takes_any_doubles_and_orders_no_rows(spark):
    rng = random.Random(4)
    values = [rng.choice((-1, 1)) * 10.0 ** rng.uniform(-300, 300) for _ in range(4_000)] + [math.inf, -math.inf, 0.0, -0.0]
    frame = spark.createDataFrame([(k % 3, v) for k, v in enumerate(values)], "g int, v double").repartition(5)
    found = exact_quantiles(frame, "v", PROBS, ["g"], accuracy=10)
    for row in found.collect():
        own = [v for k, v in enumerate(values) if k % 3 == row["g"]]
        for name, prob in PROBS.items():
            assert row[name] == brute(own, prob)
    plan = found._jdf.queryExecution().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "windowspec" in line.lower()]
    assert all("__bucket" in line for line in windows)


@pytest.mark.parametrize("prob", [0.0, 0.1, 1 / 3, 0.9, 1.0])
def test_interpolated_quantiles_equal_numpy(spark, prob):
    rng = np.random.default_rng(8)
    for data in (rng.lognormal(2, 3, 1_001), rng.integers(0, 5, 400).astype(float), np.array([7.5])):
        frame = spark.createDataFrame([(float(v),) for v in data] + [(None,), (math.nan,)], "v double")
        assert interpolated_quantile(frame, "v", prob) == pytest.approx(np.quantile(data, prob), rel=1e-12)
    assert interpolated_quantile(frame.limit(0), "v", prob) is None


def test_settled_frames_are_released_with_their_block(spark):
    with holding():
        inner = settled(spark.range(3))
        assert inner.is_cached
    assert not inner.is_cached


def test_sketches_merge_over_periods_within_their_rank_error(spark):
    rng = random.Random(3)
    rows = [(f"p{k % 4}", rng.gauss(0, 1) * 10 ** (k % 4), float(k % 7)) for k in range(40_000)]
    rows += [("p9", None, math.nan), ("p9", math.nan, None), ("p0", None, 1.0)]
    frame = spark.createDataFrame(rows, "period string, a double, b double").repartition(13)
    parts = sketches.quantile_sketches(frame, ["a", "b"], ["period"], salts=3)
    assert {(r["period"], r["variable"]): r["n"] for r in parts.collect()} == {
        **{(f"p{k}", "a"): 10_000 for k in range(4)}, **{(f"p{k}", "b"): 10_000 + (k == 0) for k in range(4)}
    }
    chosen = parts.filter("period IN ('p1', 'p3')")
    for by, groups in ((["period"], ["p1", "p3"]), ([], [None])):
        found = sketches.sketched_quantiles(sketches.merged_sketches(chosen, by), PROBS, by).collect()
        assert len(found) == 2 * len(groups)
        for row in found:
            period = row["period"] if by else None
            own = sorted(
                r[1 if row["variable"] == "a" else 2] for r in rows
                if r[0] in ("p1", "p3") and period in (None, r[0])
            )
            assert row["n"] == len(own)
            for name, prob in PROBS.items():
                below, upto = np.searchsorted(own, row[name]), np.searchsorted(own, row[name], "right")
                assert sketches.rank_error(prob, below, upto, len(own)) <= 0.005
    shares = sketches.sketched_ranks(sketches.merged_sketches(parts), [3.0]).collect()
    by_variable = {r["variable"]: r["share"] for r in shares}
    assert by_variable["b"] == pytest.approx(4 / 7, abs=0.005)
    checked = sketches.true_ranks(frame, {("b", "x"): 3.0})
    assert checked["b", "x"] == (sum(r[2] < 3 for r in rows if r[2] is not None), sum(r[2] <= 3 for r in rows if r[2] is not None), 40_001)


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "period string, a double")
    assert sketches.quantile_sketches(empty, ["a"], ["period"]).count() == 0
    assert sketches.quantile_sketches(empty, ["a"]).count() == 0
