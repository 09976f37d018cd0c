"""Contract-checked ingest of per-period sources into one partitioned Parquet table."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession

from fieldbook.functions import trimmed
from fieldbook.operators.harmonise import with_provenance
from fieldbook.operators.small import local_frame

from .runs import _file_system
from .spec import SourceSpec, text_schema
from .tables import PERIOD, check_columns

CONVERTED, REUSED = "converted", "reused"
#: Sources opened, converted or counted at the same time.
PARALLEL_SOURCES = 4
AUDIT_SCHEMA = "period string, source string, rows long, expected long, state string"


def ingest(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    columns: Sequence[str],
    root: str,
    force: bool = False,
) -> DataFrame:
    """Bring every source into ``root/period=<period>`` and return an audit table.

    A period already published is reused unless ``force``; its row count is checked
    against the contract all the same.  The columns of new ones are checked before any is
    converted; they are written to staging folders, counted, and published by renaming only
    when every contract holds, so a failed ingest leaves the previous data in place.  Each of
    these steps works on several periods at a time.
    """
    if not specs:
        return local_frame(spark, [], AUDIT_SCHEMA)
    published = {spec.period: f"{root}/{PERIOD}={spec.period}" for spec in specs}
    if len(published) != len(specs):
        raise ValueError(f"periods repeat: {sorted(spec.period for spec in specs)}")
    reused = {
        spec.period
        for spec in specs
        if not force and _exists(spark, f"{published[spec.period]}/_SUCCESS")
    }
    staged = {
        spec.period: f"{root}/_staging/{spec.period}" for spec in specs if spec.period not in reused
    }

    def opened(spec: SourceSpec) -> DataFrame:
        return _read_source(spark, spec, columns)

    def convert(spec: SourceSpec, source: DataFrame) -> None:
        source.write.mode("overwrite").parquet(staged[spec.period])

    new = [spec for spec in specs if spec.period in staged]
    if new:
        with ThreadPool(min(PARALLEL_SOURCES, len(new))) as pool:
            # All headers first: one looked at between conversions waits behind their tasks.
            sources = pool.map(opened, new, chunksize=1)
            pool.starmap(convert, zip(new, sources), chunksize=1)
    rows = _count_rows(spark, published | staged)
    broken = [
        f"{spec.file_name}: {rows[spec.period]} rows, expected {spec.expected_rows}"
        for spec in specs
        if rows[spec.period] != spec.expected_rows
    ]
    if broken:
        raise ValueError("; ".join(broken))
    for period, staging in staged.items():
        _publish(spark, staging, published[period])
    lines = [
        (
            spec.period, spec.file_name, rows[spec.period], spec.expected_rows,
            REUSED if spec.period in reused else CONVERTED,
        )
        for spec in specs
    ]
    return local_frame(spark, lines, AUDIT_SCHEMA).orderBy("period")


def _count_rows(spark: SparkSession, folders: dict[str, str]) -> dict[str, int]:
    """Rows of every period's folder; a count reads no column and groups no row."""

    def count(folder: str) -> int:
        return spark.read.schema("`-` string").parquet(folder).count()

    with ThreadPool(min(PARALLEL_SOURCES, len(folders))) as pool:
        return dict(zip(folders, pool.map(count, folders.values(), chunksize=1)))


def _read_source(spark: SparkSession, spec: SourceSpec, columns: Sequence[str]) -> DataFrame:
    """Selected columns as trimmed text with provenance; checks the column contract."""
    if not _exists(spark, spec.path):
        raise FileNotFoundError(f"source not found: {spec.path}")
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.format == "csv":
        reader = reader.option("header", "true")
    found = reader.load(spec.path)
    check_columns(found, columns, spec.file_name)
    if len(found.columns) != spec.expected_columns:
        raise ValueError(
            f"{spec.file_name}: {len(found.columns)} columns, expected {spec.expected_columns}"
        )
    if spec.format == "csv":
        # An unquoted empty cell is null and a quoted one is empty text; the reader tells
        # them apart only when the null marker is not the empty string itself.
        reader = reader.option("nullValue", "\x1f")
        found = reader.schema(text_schema(found.columns)).load(spec.path)
    texts = found.select(*[trimmed(name).alias(name) for name in columns])
    return with_provenance(texts, source_file=spec.file_name, **spec.provenance)


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def _publish(spark: SparkSession, staging: str, destination: str) -> None:
    """Rename `staging` into place; the folder it replaces is deleted last.

    Whatever fails, one of the two is published: a rename that fails puts the old back.
    """
    files, source = _file_system(spark, staging)
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    target, aside = new_path(destination), new_path(f"{staging}-replaced")
    files.mkdirs(target.getParent())
    files.delete(aside, True)
    replaces = files.exists(target)
    if replaces and not files.rename(target, aside):
        raise OSError(f"could not put {destination} aside")
    published = False
    try:
        published = files.rename(source, target)
    finally:
        if replaces and not published:
            files.rename(aside, target)
    if not published:
        raise OSError(f"could not publish {destination}")
    if replaces:
        files.delete(aside, True)
