"""Intermediate tables that several later steps read.

A staged table cuts the lineage, survives lost executors, and has a known size, so Spark
broadcasts it in a join only when it really is small.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_local_folder: tempfile.TemporaryDirectory | None = None
_DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writers, _setting_before = Lock(), 0, None
_open_scope: ContextVar[list[str] | None] = ContextVar("open_scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only on a local master without it."""
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="rainledger-", ignore_cleanup_errors=True)
    return _local_folder.name


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of the writes inside as soon as each has ended.

    Otherwise they stay until the driver happens to collect its garbage, and many staged tables add up on the executors'
    disks. A staged frame is written once, so nobody reads them again; the setting is as before when the last write ends.
    """
    global _writers, _setting_before
    with _lock:
        if not _writers:
            _setting_before = spark.conf.get(_DELETE_SHUFFLES, None)
            spark.conf.set(_DELETE_SHUFFLES, "true")
        _writers += 1
    try:
        yield
    finally:
        with _lock:
            _writers -= 1
            if not _writers and _setting_before is None:
                spark.conf.unset(_DELETE_SHUFFLES)
            elif not _writers:
                spark.conf.set(_DELETE_SHUFFLES, _setting_before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str, scoped: bool = True) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and return a scan of it.

    A table that is not ``scoped`` outlives the staging scope that is open.
    """
    path = scratch_path(df.sparkSession, name)
    scope = _open_scope.get()
    if scope is not None and scoped:
        scope.append(path)
    with _shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside the block when it ends.

    Frames that leave the block must not read them: write results to their own tables first.
    """
    paths: list[str] = []
    token = _open_scope.set(paths)
    try:
        yield
    finally:
        _open_scope.reset(token)
        for path in paths:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
