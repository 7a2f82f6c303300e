"""The shared folder in which operators put what must not be computed twice."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Where tables are landed at the moment, if not in the folder of the application.
_own: ContextVar[str | None] = ContextVar("windrow_own_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application below the one that the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a folder of its own is used in local mode only (tests).
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="windrow-shared-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{context.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_own.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def own_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """What is landed inside goes to a folder of its own, which is removed at the end; other tables stay.

    For work that writes all its results: a lazy result that reads landed tables must not leave it.
    """
    path = new_path(spark, name)
    token = _own.set(path)
    try:
        yield path
    finally:
        _own.reset(token)
        remove(spark, path)


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage, and Spark knows its size."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths that match a glob, sorted."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(status.getPath().toString()) for status in found or [])


def remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_shared(spark: SparkSession) -> None:
    """Remove what this application has landed; for its end, when nothing reads it any more."""
    remove(spark, shared_folder(spark))
