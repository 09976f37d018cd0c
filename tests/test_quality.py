from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldbook.functions import percent_of
from fieldbook.operators import audit
from fieldbook.operators.funnel import (
    Criterion,
    exclusion_audit,
    observed_survivors,
    passes,
    survivors,
)
from fieldbook.operators.harmonise import (
    CodeRule,
    DurationRule,
    HarmoniseRules,
    harmonise,
    with_provenance,
)
from fieldbook.plans.preparation import prepare
from fieldbook.operators.splits import TemporalSplit, check_split_coverage, split_counts

maybe = st.one_of(st.none(), st.integers(-3, 3))
quick = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rules():
    return [
        Criterion("a positive", F.col("a") > 0),
        Criterion("b not two", F.col("b") != 2),
        Criterion("a below b", F.col("a") < F.col("b")),
    ]


def sequential(frame, criteria):
    counts = [frame.count()]
    for rule in criteria:
        frame = frame.filter(rule.keep)
        counts.append(frame.count())
    return counts


@quick
@given(rows=st.lists(st.tuples(maybe, maybe), max_size=25))
def test_one_pass_audit_equals_sequential_filters(spark, rows):
    frame = spark.createDataFrame(rows, "a int, b int")
    table = exclusion_audit(frame, rules()).collect()
    assert [row["after"] for row in table] == sequential(frame, rules())
    assert all(row["before"] == row["excluded"] + row["after"] for row in table)
    assert [row["step"] for row in table] == [0, 1, 2, 3]
    assert survivors(frame, rules()).count() == table[-1]["after"]
    assert frame.filter(passes(rules())).count() == table[-1]["after"]


def test_observed_survivors_are_the_survivors(spark):
    rows = [(a, b) for a in (None, -1, 0, 1, 2) for b in (None, 1, 2, 3)]
    frame = spark.createDataFrame(rows, "a int, b int")
    kept = observed_survivors(frame, rules())
    assert sorted(kept.collect()) == sorted(survivors(frame, rules()).collect())


def test_audit_counts_rows_once_however_often_they_are_evaluated(spark, tmp_path):
    """Rows that run again, as after a lost executor, must not be counted again."""
    rows = [(str(a), str(b), "p") for a in (-1, 0, 1, 2) for b in (1, 2, 3)]
    raw = spark.createDataFrame(rows, "x string, y string, period string")
    done = prepare(raw, HarmoniseRules(numbers={"a": "x", "b": "y"}), rules(), ["x"], "period", ["x"])
    table = done.write(str(tmp_path / "stored"))
    done.eligible.count()
    for _ in range(2):
        last = table.collect()[-1]
        assert last["after"] == spark.read.parquet(str(tmp_path / "stored")).count()
        assert table.collect()[0]["before"] == len(rows)


def test_harmonise_keeps_raw_columns_and_refuses_to_replace_them(spark):
    raw = spark.createDataFrame([("01", " 2.0 ", "1", "6")], "DOMAIN string, c string, y string, m string")
    ruled = HarmoniseRules(
        numbers={"years": "y", "months": "m"},
        codes=[CodeRule("c", "code", "label", {"2": "two"})],
        durations=[DurationRule("span", "years", "months")],
    )
    row = harmonise(raw, ruled).first()
    assert (row["c"], row["code"], row["label"], row["span"]) == (" 2.0 ", "2", "two", 1.5)
    with pytest.raises(ValueError, match="domain"):
        harmonise(raw, HarmoniseRules(numbers={"domain": "DOMAIN"}))


def test_provenance_columns_are_constants(spark):
    row = with_provenance(spark.range(1), source_file="f.csv", year=2025).first()
    assert (row["source_file"], row["year"]) == ("f.csv", 2025)


def test_splits_must_not_overlap(spark):
    with pytest.raises(ValueError, match="both train and test"):
        TemporalSplit(train=["a", "b"], validation=["c"], test=["b"])


def test_split_counts_list_empty_splits(spark):
    split = TemporalSplit(train=["a", "b"], validation=["c"], test=["d"])
    frame = spark.createDataFrame([("a",), ("b",), ("c",), ("x",), (None,)], "period string")
    counts = {row["split"]: row["rows"] for row in split_counts(frame, split).collect()}
    assert counts == {"train": 2, "validation": 1, "test": 0, "outside": 2}
    with pytest.raises(ValueError, match="test"):
        check_split_coverage(frame, split)
    assert split.select(frame, "train", "validation").count() == 3


def test_missingness_orders_and_survives_empty_input(spark):
    schema = "b string, a string, c string"
    frame = spark.createDataFrame([("x", "na", None), ("", "1", "N/A"), ("y", "2", "z")], schema)
    rows = [tuple(r) for r in audit.missingness(frame, ["a", "b", "c"]).collect()]
    assert [(r[0], r[1]) for r in rows] == [("c", 2), ("a", 1), ("b", 1)]
    empty = audit.missingness(frame.limit(0), ["a"]).first()
    assert (empty["missing"], empty["missing_pct"]) == (0, None)


def test_period_counts_keep_null_and_exhausted_periods(spark):
    rows = [("p1", 1), ("p1", 0), ("p2", 0), (None, 1)]
    frame = spark.createDataFrame(rows, "period string, ok int")
    one = audit.counts_by_period(frame, "period", F.col("ok") == 1).collect()
    two = audit.compare_counts(frame, frame.filter("ok = 1"), "period").collect()
    assert one == two
    found = {r["period"]: (r["before"], r["after"], r["excluded"], r["retention_pct"]) for r in one}
    assert found == {"p1": (2, 1, 1, 50.0), "p2": (1, 0, 1, 0.0), None: (1, 1, 0, 100.0)}
    total = audit.retention_total(audit.counts_by_period(frame, "period", F.col("ok") == 1)).first()
    assert (total["before"], total["after"], total["retention_pct"]) == (4, 2, 50.0)


REPEATS = [
    (1, "a", None), (1, "a", None),
    (2, "a", "x"), (2, "a", "y"),
    (3, "a", None), (3, "a", "<NULL>"),
    (4, "z", "z"),
]


def test_duplicate_audit_separates_repeats_from_conflicts(spark):
    frame = spark.createDataFrame(REPEATS, "k int, u string, v string")
    assert tuple(audit.duplicate_keys(frame, ["k"]).first()) == (3, 6, 1, 2)
    assert tuple(audit.duplicate_keys(frame.limit(0), ["k"]).first()) == (0, 0, 0, 0)


def test_duplicate_audit_with_one_key_holding_most_rows(spark):
    rows = spark.range(50_000).select(
        F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")).alias("k"), F.lit("same").alias("v")
    )
    assert tuple(audit.duplicate_keys(rows, ["k"]).first()) == (1, 33_333, 1, 0)
    mixed = rows.withColumn("v", F.when(F.rand(1) < 0.001, "other").otherwise("same"))
    assert tuple(audit.duplicate_keys(mixed, ["k"]).first()) == (1, 33_333, 0, 1)


def test_unique_keys_are_asserted(spark):
    frame = spark.createDataFrame([(1, None), (1, "a"), (2, "a")], "k int, j string")
    assert audit.check_unique_keys(frame, ["k", "j"], "rows") == 3
    with pytest.raises(ValueError, match="rows: 3 rows but 2 distinct keys"):
        audit.check_unique_keys(frame, ["k"], "rows")


def test_observed_codes_are_normalised(spark):
    frame = spark.createDataFrame([("p", "2.0"), ("p", "2"), ("p", None)], "period string, q string")
    assert [tuple(r) for r in audit.observed_codes(frame, "period", "q").collect()] == [
        ("p", None, 1),
        ("p", "2", 2),
    ]


def test_conservation_needs_every_model_on_every_row(spark):
    test = spark.createDataFrame([(1,), (2,)], "k int")
    full = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 2.0)], "k int, p double, q double")
    models = {"m": "p", "n": "q"}
    table = audit.row_conservation(test, full, ["k"], models)
    assert [r["rows"] for r in table.collect()] == [2, 2, 2, 2, 2]
    assert audit.check_conservation(table) == 2
    repeated = audit.row_conservation(test, full.union(full), ["k"], models)
    with pytest.raises(ValueError):
        audit.check_conservation(repeated)


@quick
@given(parts=st.lists(st.integers(1, 50), min_size=1, max_size=6))
def test_percentages_sum_to_one_hundred(spark, parts):
    frame = spark.createDataFrame([(p,) for p in parts], "n long")
    total = sum(parts)
    found = frame.select(F.sum(percent_of("n", F.lit(total)))).first()[0]
    assert found == pytest.approx(100.0)
