"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import io
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.sources.runs import scratch_path

#: Bytes of rows handed to a Python worker at once; Spark's own 64 MB are held several times
#: over on both sides.  A session that has set another size keeps it.
BATCH_BYTES = 8 << 20
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20)

_SHIPPED: set[str] = set()


def kept(frame: DataFrame, name: str) -> DataFrame:
    """`frame` written as Parquet under the shared folder and read again.

    Cuts the lineage: a lost executor costs later steps a read, not a recomputation.  The step
    is listed in the run's manifest and goes when the run ends.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    # What was shuffled on the way is garbage now; a collection lets Spark drop its files.
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(frame.schema).parquet(path)


def without_names(frame: DataFrame, *names: str) -> DataFrame:
    """`frame` without columns of these names, in any case: an operator's own columns win."""
    own = {name.lower() for name in names}
    return frame.select(*[F.col(f"`{c}`") for c in frame.columns if c.lower() not in own])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(spark: SparkSession) -> SparkSession:
    """`spark`, whose executors can import this package: it is zipped into the shared folder.

    Rows reach Python in batches of bounded size.
    """
    context = spark.sparkContext
    if spark.conf.get(_BATCH_KEY).startswith(_BATCH_DEFAULT):
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        zipped = io.BytesIO()
        with zipfile.ZipFile(zipped, "w", zipfile.ZIP_DEFLATED) as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        jvm = spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(
            f"{scratch_path(spark, 'code')}/{package.name}.zip"
        )
        system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        out = system.create(path)
        out.write(zipped.getvalue())
        out.close()
        context.addPyFile(system.makeQualified(path).toString())
        _SHIPPED.add(context.applicationId)
    return spark
