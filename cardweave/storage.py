"""Shared-folder helpers: staged tables that cut lineage and survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import quote, urlsplit

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session without one gets a temporary folder of its own; a cluster
    without it is an error, since executors share no local disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir("file:" + tempfile.mkdtemp(prefix="cardweave-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def staging() -> Iterator[None]:
    """Delete the tables staged inside the block when it ends.

    For code that runs for ever, such as a micro-batch: nothing staged may be used later.
    """
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in paths:
            delete(SparkSession.getActiveSession(), path)


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of a path, and the path as its object."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system; a failure is a warning, since no result depends on it."""
    try:
        files, target = hadoop_path(spark, path)
        files.delete(target, True)
    except Exception as error:
        warnings.warn(f"{path} could not be deleted: {error}", stacklevel=2)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Service calls and random IVs behind it are evaluated exactly once, and later
    readers get column pruning, pushed filters and file sizes. The table stays until
    the folder is cleaned, or the surrounding :func:`staging` block ends.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    paths = _staged.get()
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def folder_in_task(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, for use inside a task.

    On a cluster the folder needs its scheme; without one it is local.
    """
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), urlsplit(folder).path.rstrip("/")
    if ":/" not in folder:
        return fs.LocalFileSystem(), os.path.abspath(folder)
    return fs.FileSystem.from_uri(quote(folder.rstrip("/").replace("s3a://", "s3://", 1), safe=":/@"))
