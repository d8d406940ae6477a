"""The Spark session, and the shared folder for tables that outlive a plan."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def session(app_name: str) -> tuple[SparkSession, bool]:
    """The active session, or a new one; the flag says whether the caller has to stop it."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active, False
    created = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .getOrCreate()
    )
    return created, True


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local-mode session may go without the setting; it gets one temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="lakejobs-")
    return _local_dirs[context.applicationId]


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{_own_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/lakejobs/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_staged(spark: SparkSession) -> None:
    """Delete all that this application has staged; for the end of its work, when no result is read any more."""
    _delete(spark, _own_folder(spark))


def staging_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path that a surrounding `scratch` deletes; for what tasks write themselves."""
    path = fresh_path(spark, purpose)
    kept = _scratch.get()
    if kept is not None:
        kept.append(path)
    return path


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back: cuts lineage, survives lost executors.

    Inside `scratch` the copy lives until the end of the block, else until `clear_staged`.
    """
    path = staging_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Hand Python workers batches of some `limit` bytes, or one row; for work that runs its actions inside."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was staged inside; for work that has run its last action by then."""
    paths: list[str] = []
    outer = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(outer)
        for path in paths:
            _delete(spark, path)
