"""Registered queries against their oracles, and what their plans must not contain."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_point
from oracle_check import connect, difference
from workload.oracles import ORACLES
from workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
ITERATIVE = {
    "linear_search",
    "forest_search",
    "final_scoring",
    "final_comparison",
    "kmeans_silhouettes",
    "kmeans_profiles",
}
# Fits with a closed form: checked like any query, but their plans hold an algorithm's rows.
CLOSED_FORM = {
    "linear_search_line",
    "final_line",
    "reloaded_line",
    "forest_stump",
    "forest_search_stumps",
    "segment_clusters",
    "cluster_choice",
}
# Approximate answers, which no exact SQL equals.
SKETCHED = {"approx_profile", "approx_period_quantiles"}


@pytest.fixture(scope="module")
def oracle():
    with connect(SMALL) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, oracle, name):
    assert difference(spark, oracle, name, SMALL) is None


def test_every_query_has_an_oracle_unless_none_can_exist():
    assert set(QUERIES) - set(ORACLES) == ITERATIVE | SKETCHED
    assert set(ORACLES) <= set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(ITERATIVE))
def test_iterative_queries_run(spark, name):
    rows = QUERIES[name](spark, SMALL).collect()
    assert rows
    if name == "final_scoring":
        test_rows = QUERIES["split_rows"](spark, SMALL).filter("split = 'test'").first()["rows"]
        assert len(rows) == test_rows


def test_entry_runs_the_funnel(spark):
    rows = entry_point.entry(spark).collect()
    assert [row["after"] for row in rows] == [6000, 4795, 2571, 2477, 2239, 2016, 2016, 1875]


def plan_of(spark, name):
    frame = QUERIES[name](spark, SMALL)
    return frame._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ITERATIVE - CLOSED_FORM))
def test_plans_stay_in_the_jvm_without_cartesian_products(spark, name):
    plan = plan_of(spark, name)
    for operator in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "ExistingRDD"):
        assert operator not in plan
    # The histogram joins a list of bins; nothing joins without an equality.
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    ("name", "scans"),
    [
        ("exclusion_funnel", 2),
        ("eligible_rows", 2),
        ("counts_by_period", 2),
        ("missingness", 2),
        ("observed_codes", 2),
        ("duplicate_keys", 1),
        ("split_rows", 1),
        ("pearson_matrix", 1),
        ("approx_profile", 1),
        ("approx_period_quantiles", 1),
        ("mean_baseline", 1),
        ("baseline_gain", 1),
        ("overall_extremes", 1),
        ("error_by_dimension", 1),
        ("tail_residual", 1),
    ],
)
def test_each_table_is_scanned_once(spark, name, scans):
    # Below a kept aggregate the plan shows what it was computed from.
    assert plan_of(spark, name).split("InMemoryRelation")[0].count("FileScan") == scans


def test_only_needed_columns_reach_the_scan(spark):
    plan = plan_of(spark, "pearson_matrix")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {
        "l_extendedprice",
        "l_quantity",
        "l_discount",
        "l_tax",
    }


def test_split_years_reach_the_scan(spark):
    plan = plan_of(spark, "mean_baseline")
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_parsing_stays_inside_compiled_methods(spark):
    """HotSpot does not compile methods above 8000 bytes of code."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("harmonize", "eligible_rows", "exclusion_funnel", "counts_by_period"):
            frame = QUERIES[name](spark, SMALL)
            text = frame._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
            )
            sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8_000, (name, sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_exact_medians_join_their_lines_once(spark):
    """The passes over the rows read what was stored: no orders in the plan of the result."""
    plan = QUERIES["median_by_group"](spark, SMALL)._jdf.queryExecution().toString()
    assert "o_orderkey" not in plan and "l_extendedprice" in plan
