"""Period-partitioned tables, prediction tables, models and result tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .runs import scratch_path

PERIOD = "period"


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; an empty list is an error."""
    if not frames:
        raise ValueError("at least one frame is needed")
    return reduce(lambda left, right: left.unionByName(right), frames)


def load_periods(
    spark: SparkSession,
    root: str,
    periods: Iterable[str],
    period: str = PERIOD,
    schema: StructType | None = None,
) -> DataFrame:
    """Chosen periods of a table partitioned by period, as one read.

    Only the folders asked for are listed, so a missing period is an error.  The period
    stays text whatever it looks like.  ``schema`` describes the other columns; without
    it a file footer of the first period is opened.
    """
    folders = [f"{root}/{period}={name}" for name in periods]
    if not folders:
        raise ValueError("at least one period is needed")
    stored = schema or spark.read.parquet(folders[0]).schema
    fields = [*stored.fields, StructField(period, StringType(), True)]
    reader = spark.read.option("basePath", root).schema(StructType(fields))
    return reader.parquet(*folders)


def write_by_period(frame: DataFrame, path: str, period: str = PERIOD) -> None:
    """Overwrite a Parquet table partitioned by period.

    Rows are first gathered by period, or every task would write a file for every
    period it meets.  The gathering is a rebalance: adaptive execution splits a period
    that is large and packs together those that are small, so no period is one task.
    """
    gathered = frame.hint("rebalance", F.col(period))
    gathered.write.mode("overwrite").partitionBy(period).parquet(path)


def check_columns(frame: DataFrame, required: Iterable[str], name: str) -> DataFrame:
    """The frame itself; raises if a required column is missing."""
    missing = sorted(set(required) - set(frame.columns))
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return frame


def read_predictions(spark: SparkSession, path: str, required: Iterable[str]) -> DataFrame:
    """A stored prediction table, checked for the columns the error tables need."""
    return check_columns(spark.read.parquet(path), required, path)


def materialise(frame: DataFrame, path: str | None = None, name: str = "step") -> DataFrame:
    """Write a frame and read it back, so later passes do not recompute it.

    Without a path it is a step of the run's folder and goes with it.
    """
    path = path or scratch_path(frame.sparkSession, name)
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_result_table(table: DataFrame, path: str) -> None:
    """A small result table as CSV with a header; empty text is quoted, null is not."""
    table.write.mode("overwrite").option("header", "true").csv(path)


def read_result_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A stored result table with the types it was written from; a bad cell is an error.

    The columns of the header have to be those of the schema, in order.
    """
    reader = spark.read.option("header", "true").option("mode", "FAILFAST").option("enforceSchema", "false")
    # An empty cell is null and a quoted one is empty text, told apart only by a null
    # marker that is not the empty text itself.
    return reader.option("nullValue", "\x1f").schema(schema).csv(path)
