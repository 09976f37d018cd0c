"""Inputs of the registered queries, derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.learning.features import FeatureSpec
from fieldbook.operators.harmonise import CodeRule, DurationRule, HarmoniseRules, harmonise
from fieldbook.operators.small import settled
from fieldbook.operators.splits import TemporalSplit
from fieldbook.plans.survey import AREA, EDUCATION, OCCUPATION, eligibility
from fieldbook.sources.ingest import ingest
from fieldbook.sources.runs import scratch_path
from fieldbook.sources.spec import SourceSpec
from fieldbook.sources.tables import load_periods, materialise, write_by_period


def _quarters(first_year: int, last_year: int) -> tuple[str, ...]:
    return tuple(f"{y}T{q}" for y in range(first_year, last_year + 1) for q in range(1, 5))


SPLIT = TemporalSplit(
    train=_quarters(1995, 1999), validation=_quarters(2000, 2000), test=_quarters(2001, 2001)
)
# First and last ship year of each split, for a range filter the scan can use.
SPLIT_YEARS = {"train": (1995, 1999), "validation": (2000, 2000), "test": (2001, 2001)}

RAW_KEYS = ["period", "household", "person"]
RAW_TEXTS = [
    "age_txt",
    "active_txt",
    "job_code",
    "pay_txt",
    "years_txt",
    "months_txt",
    "hours_txt",
    "level_code",
    "domain_code",
]
RULES = HarmoniseRules(
    numbers={
        "age": "age_txt",
        "active": "active_txt",
        "pay": "pay_txt",
        "tenure_years": "years_txt",
        "tenure_months": "months_txt",
        "hours": "hours_txt",
    },
    codes=(
        CodeRule("job_code", "job", "job_label", OCCUPATION),
        CodeRule("level_code", "level", "level_label", EDUCATION),
        CodeRule("domain_code", "domain", "domain_label", AREA),
    ),
    durations=(DurationRule("tenure", "tenure_years", "tenure_months"),),
)

LABEL = "l_extendedprice"
NUMBERS = ["l_quantity", "l_discount", "l_tax"]
CATEGORIES = ["l_returnflag", "l_linestatus", "o_orderpriority"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
FEATURES = FeatureSpec(numeric=NUMBERS, categorical=CATEGORIES, label=LABEL)

BASELINE = "mean_baseline"
MODELS = {
    BASELINE: "pred_mean",
    "segment_mean": "pred_segment",
    "quantity_line": "pred_line",
}
TWO_MODELS = {name: column for name, column in MODELS.items() if name != BASELINE}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _period(ship_date: str):
    return F.concat(
        F.year(ship_date).cast("string"), F.lit("T"), F.quarter(ship_date).cast("string")
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its shipping period."""
    return table(spark, sf_dir, "lineitem").withColumn("period", _period("l_shipdate"))


def split_lines(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Lines of the named splits; the year range reaches the scan."""
    years = [year for name in names for year in SPLIT_YEARS[name]]
    start, end = f"{min(years)}-01-01", f"{max(years) + 1}-01-01"
    frame = lines(spark, sf_dir)
    # Bounds of the column's own type, whatever it is, so that they reach the scan.
    kind = frame.schema["l_shipdate"].dataType
    shipped = F.col("l_shipdate")
    within = frame.filter((shipped >= F.lit(start).cast(kind)) & (shipped < F.lit(end).cast(kind)))
    return SPLIT.select(within, *names)


def with_orders(frame: DataFrame, spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Attach order columns to lines; Spark chooses the join from measured sizes."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *columns)
    return frame.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def model_lines(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Keys, period, predictors and label of the named splits (all lines if none)."""
    frame = split_lines(spark, sf_dir, *names) if names else lines(spark, sf_dir)
    narrow = frame.select("period", *KEYS, LABEL, *NUMBERS, "l_returnflag", "l_linestatus")
    return with_orders(narrow, spark, sf_dir, "o_orderpriority")


def stored_model_lines(spark: SparkSession, sf_dir: str) -> Callable[..., DataFrame]:
    """Model lines joined once, stored by period, and read back by split.

    For workflows that pass over the rows many times: the join is not repeated, a split
    is a set of folders, and lost executors lose no work.
    """
    path = scratch_path(spark, "model-lines")
    write_by_period(model_lines(spark, sf_dir, *SPLIT.members()), path)
    def read(*names: str) -> DataFrame:
        # A period that is not stored is an error, not a gap.
        periods = [p for name in names for p in SPLIT.members()[name]]
        return load_periods(spark, path, periods)

    return read


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text records as a survey would deliver them: blanks, commas, gaps and bad codes."""
    return _as_text(_ordered_lines(spark, sf_dir))


def _ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderdate", "o_orderstatus", "o_orderpriority"]
    return with_orders(lines(spark, sf_dir), spark, sf_dir, *columns)


def _as_text(joined: DataFrame) -> DataFrame:
    def every(column: str, step: int):
        return F.col(column) % step == 0

    def whole(column):
        return column.cast("int").cast("string")

    price = F.col("l_extendedprice")
    return joined.select(
        "period",
        F.col("l_orderkey").cast("string").alias("household"),
        F.col("l_linenumber").cast("string").alias("person"),
        F.quarter("o_orderdate").cast("string").alias("src_quarter"),
        F.when(every("l_orderkey", 101), "NaN")
        .when(every("l_orderkey", 103), "abc")
        .otherwise(
            F.concat(
                F.lit(" "), (F.col("l_quantity").cast("int") + 5).cast("string"), F.lit(".0 ")
            )
        )
        .alias("age_txt"),
        F.when(every("l_orderkey", 11), "NA")
        .when(every("l_orderkey", 13), "")
        .when(every("l_orderkey", 17), F.lit(None).cast("string"))
        .when(F.col("o_orderstatus") == "P", "2")
        .otherwise("1")
        .alias("active_txt"),
        F.when(every("l_partkey", 31), "9")
        .when(F.col("l_returnflag") == "A", "1")
        .when(F.col("l_returnflag") == "N", "2.0")
        .otherwise("3.00")
        .alias("job_code"),
        F.when(every("l_suppkey", 29), "-5")
        .when(every("l_suppkey", 23), "n/a")
        .when(
            every("l_suppkey", 10),
            F.concat(
                whole(F.floor(price / 1000)),
                F.lit(","),
                F.lpad(whole(F.floor(price).cast("int") % 1000), 3, "0"),
            ),
        )
        .otherwise(price.cast("string"))
        .alias("pay_txt"),
        whole(F.col("l_suppkey") % 40).alias("years_txt"),
        F.when(every("l_partkey", 37), "5.5")
        .otherwise(whole(F.col("l_partkey") % 13))
        .alias("months_txt"),
        whole(F.col("l_partkey") % 180).alias("hours_txt"),
        F.when(every("l_partkey", 41), F.lit(None).cast("string"))
        .otherwise(F.substring("o_orderpriority", 1, 1))
        .alias("level_code"),
        F.when(F.col("l_linestatus") == "F", "1.0").otherwise(" 2 ").alias("domain_code"),
    )


def harmonised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonise(raw(spark, sf_dir), RULES)


def criteria() -> list:
    return eligibility(active="active", job_code="job", pay="pay", hours="hours")


def predictions(
    spark: SparkSession, sf_dir: str, split: str = "test", with_priority: bool = False
) -> DataFrame:
    """Rows of a split with three predictions learnt on the training lines.

    ``pred_mean`` is the mean, ``pred_segment`` the mean of the return flag and line
    status, ``pred_line`` the least-squares line on quantity.  Orders are joined only
    for the queries that group by their priority.
    """
    return _scorer(spark, sf_dir)(split, with_priority)


def stored_predictions(spark: SparkSession, sf_dir: str) -> Callable[..., DataFrame]:
    """The same with one fit for all splits, and the scored rows of a split stored once."""
    score, stored = _scorer(spark, sf_dir), {}

    def read(split: str = "test") -> DataFrame:
        if split not in stored:
            stored[split] = materialise(score(split, True), name=f"scored-{split}")
        return stored[split]

    return read


def _scorer(spark: SparkSession, sf_dir: str) -> Callable[[str, bool], DataFrame]:
    """Fits once; what it returns scores the rows of a split."""
    train = split_lines(spark, sf_dir, "train")
    fit = train.agg(
        F.avg(LABEL).alias("mean"),
        F.regr_slope(LABEL, "l_quantity").alias("slope"),
        F.regr_intercept(LABEL, "l_quantity").alias("intercept"),
    ).first()
    segments = settled(
        train.groupBy("l_returnflag", "l_linestatus").agg(F.avg(LABEL).alias("pred_segment"))
    )

    def scored(split: str, with_priority: bool) -> DataFrame:
        rows = split_lines(spark, sf_dir, split).select(
            "period", *KEYS, LABEL, "l_quantity", "l_returnflag", "l_linestatus"
        )
        if with_priority:
            rows = with_orders(rows, spark, sf_dir, "o_orderpriority")
        beside = rows.join(segments, ["l_returnflag", "l_linestatus"], "left")
        return beside.withColumns(
            {
                "pred_mean": F.lit(fit["mean"]),
                "pred_segment": F.coalesce("pred_segment", F.lit(fit["mean"])),
                "pred_line": F.lit(fit["intercept"]) + F.lit(fit["slope"]) * F.col("l_quantity"),
            }
        )

    return scored


def delivered(spark: SparkSession, sf_dir: str) -> list[SourceSpec]:
    """The text records as CSV sources, a folder per period, and what each has to hold."""
    root = scratch_path(spark, "delivered")
    # Gathered by period before they are text, which is wider than what it is made from.
    records = _as_text(_ordered_lines(spark, sf_dir).hint("rebalance", F.col("period")))
    records.write.partitionBy("period").option("header", "true").csv(root)
    counts = lines(spark, sf_dir).groupBy("period").agg(
        F.count("*").alias("n"), F.min(F.year("l_shipdate")).alias("year"), F.min(F.quarter("l_shipdate")).alias("quarter")
    )
    return [
        SourceSpec(
            path=f"{root}/period={row['period']}",
            period=row["period"],
            expected_rows=row["n"],
            expected_columns=len(records.columns) - 1,
            provenance={"file_year": row["year"], "calendar_quarter": row["quarter"]},
        )
        for row in counts.collect()
    ]


def ingested(spark: SparkSession, sf_dir: str) -> tuple[str, list[DataFrame]]:
    """Where the delivered sources were ingested, and the audits of a first and a second run."""
    specs, store = delivered(spark, sf_dir), scratch_path(spark, "ingested")
    columns = [name for name in [*RAW_KEYS, "src_quarter", *RAW_TEXTS] if name != "period"]
    return store, [ingest(spark, specs, columns, store) for _ in range(2)]
