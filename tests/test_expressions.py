from __future__ import annotations

import math

from pyspark.sql import functions as F

from fieldbook import functions as fb

CODES = ["1", "2.00", "1.50", "10", "99", " 3 ", None]
NUMBERS = ["5", " 5 ", "1,200", "NA", "n/a", "", "abc", "NaN", "nan", "inf", "12d", "-7.5", None]


def values(spark, data, column, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [row["x"] for row in frame.select("i", column.alias("x")).orderBy("i").collect()]


def test_codes_lose_blanks_and_trailing_zeros(spark):
    assert values(spark, CODES, fb.normalized_code("v")) == ["1", "2", "1.50", "10", "99", "3", None]


def test_labels_default_for_unknown_and_null(spark):
    labels = {"1": "one", "2": "two", "3": "three"}
    column = fb.label_for(fb.normalized_code("v"), labels)
    unknown = fb.UNKNOWN_LABEL
    assert values(spark, CODES, column) == ["one", "two", unknown, unknown, unknown, "three", unknown]


def test_joined_labels_equal_mapped_labels(spark):
    labels = {"1": "one", "2": "two", "3": "three"}
    frame = spark.createDataFrame([(v,) for v in CODES], "v string").select(
        fb.normalized_code("v").alias("code_value")
    )
    dictionary = spark.createDataFrame(list(labels.items()), "code string, label string")
    joined = fb.join_labels(frame, "code_value", dictionary, "label")
    mapped = frame.withColumn("label", fb.label_for("code_value", labels))
    assert joined.exceptAll(mapped).isEmpty() and mapped.exceptAll(joined).isEmpty()


def test_numbers_are_parsed_tolerantly(spark):
    found = values(spark, NUMBERS, fb.parse_number("v"))
    assert found == [5.0, 5.0, 1200.0, None, None, None, None, None, None, math.inf, 12.0, -7.5, None]


def test_number_tokens_that_would_parse_are_still_missing(spark):
    found = values(spark, ["999", " 999 ", "1", "NaN"], fb.parse_number("v", ["999"]))
    assert found[:3] == [None, None, 1.0] and math.isnan(found[3])


def test_missing_tokens_ignore_case_and_blanks(spark):
    data = ["", " ", "na", " N/A ", "nAn", "null", None, "0", "none"]
    assert values(spark, data, fb.is_missing("v")) == [True] * 7 + [False] * 2


def test_only_finite_numbers_are_finite(spark):
    data = [0.0, -1.5, math.nan, math.inf, -math.inf, None]
    assert values(spark, data, fb.is_finite("v"), "double") == [True, True] + [False] * 4


def test_duration_is_null_when_a_part_is(spark):
    frame = spark.createDataFrame([(1.0, 6.0), (1.0, None), (None, 6.0)], "y double, m double")
    found = [row[0] for row in frame.select(fb.duration_in_years("y", "m")).collect()]
    assert found == [1.5, None, None]


def test_fingerprints_tell_apart_what_a_separator_would_mix(spark):
    rows = [("a", "b||c"), ("a||b", "c"), ("a", None), ("a", "<NULL>"), (None, "a"), ("a", "~")]
    frame = spark.createDataFrame(rows, "x string, y string")
    assert frame.select(fb.row_fingerprint(["x", "y"])).distinct().count() == len(rows)
    first, second = fb.row_digest(["x", "y"])
    assert frame.select(first).distinct().count() == len(rows)
    assert frame.select(second).distinct().count() == len(rows)


def test_bias_has_three_directions(spark):
    found = values(spark, [1.0, -1.0, 0.0, None], fb.bias_direction("v"), "double")
    assert found == ["subestima", "sobreestima", "no presenta sesgo medio", None]


def test_bands_close_on_the_right_and_leave_null_and_nan_out(spark):
    column = fb.right_closed_band("v", [10.0, 20.0], ["low", "mid", "high"])
    data = [10.0, 10.1, 20.0, 20.1, None, math.nan]
    assert values(spark, data, column, "double") == ["low", "mid", "mid", "high", None, None]


def test_custom_order_puts_unknown_last(spark):
    column = fb.position_in("v", ["b", "a"])
    assert values(spark, ["a", "b", "z", None], column) == [1, 0, 2, 2]


def test_percentages_do_not_divide_by_zero(spark):
    frame = spark.createDataFrame([(1, 0), (1, 4)], "a long, b long")
    assert [r[0] for r in frame.select(fb.percent_of("a", "b")).collect()] == [None, 25.0]


def test_key_hash_depends_on_key_and_seed_only(spark):
    frame = spark.range(1000).withColumn("k", F.col("id") % 250)
    for algorithm in ("xxhash64", "md5"):
        hashed = frame.select(
            "k",
            fb.key_hash(["k"], 1, algorithm).alias("one"),
            fb.key_hash(["k"], 2, algorithm).alias("two"),
        ).distinct()
        assert hashed.count() == 250
        assert hashed.filter("one = two").isEmpty()
