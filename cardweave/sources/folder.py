"""Reading a folder in which every file is one message."""

from __future__ import annotations

import os
import posixpath
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from cardweave.functions.plan import BROADCAST_BYTES, fits_broadcast
from cardweave.functions.text import stem, utf8_text
from cardweave.sources.files import SCHEMA, FolderFiles
from cardweave.storage import folder_in_task, fresh_path

# Fixed value: how long a file must have been left alone.
SETTLE_SECONDS = 0.25


def _plain_path(folder: str) -> str:
    """The folder's path as a scan reports it: no scheme, no doubled slash, no . or .. steps."""
    path = posixpath.normpath(urlsplit(folder).path if ":/" in folder else os.path.abspath(folder))
    return ("/" + path.lstrip("/")).rstrip("/")


def _decoded(uri: Column) -> Column:
    """Spark gives file names and paths in URI form, where a plus is a plus."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def _file_path() -> Column:
    """Path of the file, without scheme and authority."""
    return F.regexp_replace(_decoded(F.col("_metadata.file_path")), r"\A[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def _text_files(reader: DataFrameReader | DataStreamReader) -> DataFrameReader | DataStreamReader:
    # The recursive lookup is what keeps Spark from reading sub-folder names as partitions.
    return reader.format("text").options(wholetext=True, recursiveFileLookup=True)


def _checked(text: Column, on_invalid: str) -> Column:
    return utf8_text(text) if on_invalid == "replace" else F.validate_utf8(text)


def _records(files: DataFrame, folder: str, on_invalid: str) -> DataFrame:
    """Files of sub-folders are not in the feed."""
    path = _file_path()
    directly = F.regexp_replace(path, r"/[^/]*\z", "") == _plain_path(folder)
    return files.filter(directly).select(
        stem(_decoded(F.col("_metadata.file_name"))).alias("key"),
        _checked(F.col("value"), on_invalid).alias("value"),
        path.alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _files(spark: SparkSession, folder: str, names_only: bool = False) -> DataFrame:
    """name, content and modified (microseconds) of every regular file directly in ``folder``, also empty and hidden ones."""
    spark.dataSource.register(FolderFiles)
    reader = spark.read.format(FolderFiles.name()).option("work", fresh_path(spark, "listing"))
    return reader.option("namesOnly", str(names_only).lower()).load(folder)


def list_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(name, path, modified) of every file directly in ``folder``, without reading any."""
    path = F.concat(F.lit(f"{_plain_path(folder)}/"), "name")
    return _files(spark, folder, names_only=True).select(
        "name", path.alias("path"), F.timestamp_micros("modified").alias("modified")
    )


def read_listed(files: DataFrame, folder: str, on_invalid: str = "error") -> DataFrame:
    """The records of listed files (name, path, modified), each read by a task of its own choosing."""
    named = files.select("name", F.unix_micros("modified").alias("modified"))
    return _read_names(named, folder, on_invalid)


def _as_records(files: DataFrame, folder: str, on_invalid: str) -> DataFrame:
    """Read files (name, content, modified in microseconds) as records of the feed."""
    return files.select(
        stem(F.col("name")).alias("key"),
        _checked(F.col("content").cast("string"), on_invalid).alias("value"),
        F.concat(F.lit(f"{_plain_path(folder)}/"), "name").alias("path"),
        F.timestamp_micros("modified").alias("modified"),
    )


def _read_names(names: DataFrame, folder: str, on_invalid: str) -> DataFrame:
    """Read the files of ``names`` in as many tasks as there are partitions."""

    def read_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filesystem, path = folder_in_task(folder)
        for batch in batches:
            for row in batch.itertuples(index=False):
                with filesystem.open_input_stream(f"{path}/{row.name}") as file:
                    content = file.read()
                yield pd.DataFrame({"name": [row.name], "content": [content], "modified": [row.modified]})

    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = names.repartition(tasks, "name").mapInPandas(read_files, SCHEMA)
    return _as_records(files, folder, on_invalid)


def read_folder(
    spark: SparkSession, folder: str, on_invalid: str = "error", ordered: bool = False, complete: bool = True
) -> DataFrame:
    """Every file directly in ``folder``: name without extension as key, content as value.

    A file that is not UTF-8 is an error, as a message must not change on its way;
    ``on_invalid="replace"`` reads it with replacement characters. ``ordered`` sorts by
    path, for a reader to whom order matters. ``complete=False`` leaves out empty files
    and hidden names, as Spark's own reader does.
    """
    if complete:
        records = _as_records(_files(spark, folder), folder, on_invalid)
    else:
        records = _records(_text_files(spark.read).load(folder), folder, on_invalid)
    return records.orderBy("path") if ordered else records


def watch_folder(
    spark: SparkSession, folder: str, on_invalid: str = "error", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the files in ``folder``, those present first, then each new one.

    Files are taken as written once and whole (moved in when complete). Spark's stream
    lists neither empty files nor hidden names, and a rewritten file only once; where
    those matter, use :func:`watch_files`.
    """
    reader = _text_files(spark.readStream.schema("value STRING"))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _records(reader.load(folder), folder, on_invalid)


def watch_files(
    spark: SparkSession,
    folder: str,
    state: str,
    on_invalid: str = "error",
    files_per_batch: int | None = None,
    settle_seconds: float = SETTLE_SECONDS,
) -> DataFrame:
    """Stream of every file in ``folder``, those present first, then each that is new or was written again.

    Also empty files, hidden names, and files written again with an older time; a file
    still being written waits until it was left alone for ``settle_seconds``. What has been seen is kept in
    ``state``, a folder that belongs to the query's checkpoint.
    """
    spark.dataSource.register(FolderFiles)
    reader = spark.readStream.format(FolderFiles.name()).option("state", state).option("settleSeconds", str(settle_seconds))
    if files_per_batch:
        reader = reader.option("filesPerBatch", str(files_per_batch))
    return _as_records(reader.load(folder), folder, on_invalid)


def settled(files: DataFrame, seconds: float = SETTLE_SECONDS) -> DataFrame:
    """Files that were last written at least ``seconds`` ago."""
    pause = F.make_dt_interval(secs=F.lit(seconds))
    return files.filter(F.col("modified") <= F.current_timestamp() - pause)


def changed_files(current: DataFrame, seen: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Files of ``current`` that are new or were modified since ``seen`` (path, modified)."""
    keys = seen.select("path", "modified")
    if fits_broadcast(keys, broadcast_bytes):
        keys = F.broadcast(keys)
    return current.join(keys, ["path", "modified"], "left_anti")
