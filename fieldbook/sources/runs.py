"""Run folders: where a run keeps its intermediate tables, and how they are removed.

Every table that a run stores on the way lies in one folder of its own in the folder that
driver and executors share.  A manifest beside the tables names them, so that a run
whose driver was lost can be told from one that still works, and be removed.
"""

from __future__ import annotations

import atexit
import json
import sys
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
MANIFEST = "_manifest"

_OWN: dict[str, str] = {}
_ENDING: set[str] = set()


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Only where all of Spark is one machine (a local master, as in tests) may it be unset: a
    folder is made for this process then.  On a cluster an unset folder is an error, since
    other machines would not see what is written to this one's.
    """
    named = spark.conf.get(SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{SETTING} has to name a folder that driver and executors share")
    if "folder" not in _OWN:
        _OWN["folder"] = "file://" + tempfile.mkdtemp(prefix="fieldbook-run-")
    return _OWN["folder"]


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's run; it goes when the run ends or Python does."""
    folder = f"{shared_root(spark)}/run-{spark.sparkContext.applicationId}"
    if folder not in _ENDING:
        _ENDING.add(folder)
        # The session may be stopped by then; its file systems need only this.
        atexit.register(_leave, spark._jvm, _hadoop(spark), folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the run's folder, listed in its manifest."""
    folder, step = run_folder(spark), f"{name}-{uuid.uuid4().hex}"
    entry = {"name": name, "path": f"{folder}/{step}", "started": time.time()}
    _write_text(spark, f"{folder}/{MANIFEST}/{step}.json", json.dumps(entry))
    return entry["path"]


def steps(spark: SparkSession, folder: str | None = None) -> list[dict]:
    """What a run has listed, the oldest first: name, path, and when it was begun."""
    files, where = _file_system(spark, f"{folder or run_folder(spark)}/{MANIFEST}")
    if not files.exists(where):
        return []
    found = []
    for status in files.listStatus(where):
        stream = files.open(status.getPath())
        try:
            found.append(json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()
    return sorted(found, key=lambda entry: entry["started"])


def end_run(spark: SparkSession, folder: str | None = None) -> None:
    """Remove a run's folder (this application's, unless another is named)."""
    files, where = _file_system(spark, folder or run_folder(spark))
    files.delete(where, True)


def abandoned_runs(spark: SparkSession, seconds: float) -> list[str]:
    """Folders of other runs that have begun no step for so long, the oldest first."""
    files, where = _file_system(spark, shared_root(spark))
    if not files.exists(where):
        return []
    found = []
    for status in files.listStatus(where):
        folder = status.getPath().toString()
        if not status.getPath().getName().startswith("run-") or folder.endswith(run_folder(spark).rsplit("/", 1)[-1]):
            continue
        last = max([entry["started"] for entry in steps(spark, folder)], default=status.getModificationTime() / 1000)
        if time.time() - last > seconds:
            found.append((last, folder))
    return [folder for _, folder in sorted(found)]


def _leave(jvm, hadoop, folder: str) -> None:
    try:
        where = jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(hadoop).delete(where, True)
    except Exception as gone:  # the JVM may have left before this process
        print(f"run folder {folder} stays: {type(gone).__name__}", file=sys.stderr)


def _hadoop(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(_hadoop(spark)), where


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    files, where = _file_system(spark, path)
    out = files.create(where)
    try:
        out.write(text.encode())
    finally:
        out.close()
