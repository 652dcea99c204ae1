"""Intermediate results written to storage every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: Counter[str] = Counter()
_before: dict[str, str | None] = {}
_lock = Lock()


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, or else the checkpoint directory.

    Where neither is set a temporary folder becomes the checkpoint directory, but
    only for a local master: on a cluster a driver-local path would not be shared.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to storage shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="bazaarlens-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def session_folder(spark: SparkSession) -> str:
    """Subfolder of the shared folder owned by this application."""
    return f"{shared_folder(spark)}/bazaarlens/{spark.sparkContext.applicationId}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes begun inside delete their shuffle files when they end.

    Else these stay on the executors' disks until the driver collects its garbage, beside
    what was written from them. The session's setting returns once no thread is inside.
    """
    session = spark.sparkContext.applicationId
    with _lock:
        if not _cleaning[session]:
            _before[session] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _cleaning[session] += 1
    try:
        yield
    finally:
        with _lock:
            _cleaning[session] -= 1
            if not _cleaning[session]:
                before = _before.pop(session)
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return a scan of the written table.

    Cuts the lineage: whatever reads the result sees one fixed materialisation
    that outlives any executor.
    """
    spark = df.sparkSession
    path = f"{session_folder(spark)}/scratch/{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, *keys: str) -> DataFrame:
    """``stored`` in buckets of ``keys``, as many as the session has shuffle partitions.

    A join by all of ``keys`` moves only its other side. ``df`` should lie by them already
    (``repartition``), so that each bucket is one task's file. The copy is an external table
    of the session's catalog, as the copies in ``sources/buckets.py`` are.
    """
    spark = df.sparkSession
    name = uuid.uuid4().hex
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{session_folder(spark)}/scratch/{name}"
    entry = f"bazaarlens_scratch_{name}"
    with shuffles_dropped(spark):
        df.write.bucketBy(count, *keys).option("path", path).saveAsTable(entry)
    return spark.table(entry)


def release(df: DataFrame) -> None:
    """Delete what ``stored`` wrote for ``df``, once nothing reads it any more."""
    spark = df.sparkSession
    owned = f"{session_folder(spark)}/scratch/"
    context = spark.sparkContext
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if owned.split(":", 1)[-1].lstrip("/") not in folder:
            raise ValueError(f"{folder} was not written by stored()")
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
