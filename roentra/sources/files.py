"""Directories of binary files.

A directory of a file system that all tasks see (scheme ``file``) is listed by a task, batch by batch,
and its files are looked up and read by all tasks: no process holds the listing. In other stores,
and where a name is a pattern, Spark's sources list, which hold every file on the driver.
"""

from __future__ import annotations

import errno
import os
import re
import stat
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from roentra.functions.identity import base_name
from roentra.operators.durable import new_table_path
from roentra.sources.tables import read_table, write_table

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
VERSION_SCHEMA = "path string, modified timestamp, length bigint"
# Tasks of a listing for each core.
PARTS_PER_CORE = 4
# Bytes that a task reads, as in Spark's scans.
TASK_BYTES = 128 << 20
# A batch has so many files, or ends with the file whose content reaches so many bytes.
BATCH_FILES = 10_000
BATCH_BYTES = 8 << 20
# The file is gone, or the name a link to nothing.
GONE = (errno.ENOENT, errno.ENOTDIR, errno.ELOOP)
PATTERN = re.compile(r"[*?\[\]{}\\]")


def listing_parts(spark: SparkSession) -> int:
    """Partitions of a frame that carries no content. Left alone the scan takes a file for 4 MB, so it has
    a task, and what is written from it a file, for about every 32 files."""
    return PARTS_PER_CORE * spark.sparkContext.defaultParallelism


def _shared_folder(spark: SparkSession, directory: str, suffix: str) -> str | None:
    """The place of a directory in the file system of all tasks; None if Spark has to list it."""
    if PATTERN.search(directory + suffix):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    uri = store.makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" and os.path.isdir(uri.getPath()) else None


def _skipped(name: str) -> bool:
    """Names that Spark's listings leave out, and those that are no text, which have no path."""
    hidden = name.startswith(".") or name.endswith("._COPYING_")
    return hidden or (name.startswith("_") and "=" not in name) or not _is_text(name)


def _is_text(name: str) -> bool:
    try:
        return name.encode() is not None
    except UnicodeEncodeError:
        return False


def _paths(folder: str, suffix: str) -> Iterator[pa.RecordBatch]:
    """Paths of the entries of a folder, as they come."""
    found: list[str] = []
    with os.scandir(folder) as entries:
        for entry in entries:
            if entry.name.endswith(suffix) and not _skipped(entry.name):
                found.append(f"file:{folder.rstrip('/')}/{entry.name}")
            if len(found) == BATCH_FILES:
                yield pa.record_batch({"path": pa.array(found, pa.string())})
                found = []
    yield pa.record_batch({"path": pa.array(found, pa.string())})


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths -> the rows of ``VERSION_SCHEMA`` of the files that are there and not empty."""
    for batch in batches:
        paths, modified, lengths = [], [], []
        for path in batch["path"].to_pylist():
            try:
                found = os.stat(path.removeprefix("file:"))
            except OSError as problem:
                if problem.errno not in GONE:
                    raise
                continue
            if stat.S_ISREG(found.st_mode) and found.st_size:
                paths.append(path)
                # In milliseconds, as Spark has it.
                modified.append(found.st_mtime_ns // 1_000_000 * 1000)
                lengths.append(found.st_size)
        yield pa.record_batch(
            {
                "path": pa.array(paths, pa.string()),
                "modified": pa.array(modified, pa.timestamp("us", "UTC")),
                "length": pa.array(lengths, pa.int64()),
            }
        )


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths -> (path, content), in batches bounded by size."""

    def batch_of(paths: list[str], contents: list[bytes]) -> pa.RecordBatch:
        return pa.record_batch(
            {"path": pa.array(paths, pa.string()), "content": pa.array(contents, pa.binary())}
        )

    paths, contents, held = [], [], 0
    for batch in batches:
        for path in batch["path"].to_pylist():
            with open(path.removeprefix("file:"), "rb") as file:
                contents.append(file.read())
            paths.append(path)
            held += len(contents[-1])
            if held >= BATCH_BYTES or len(paths) == BATCH_FILES:
                yield batch_of(paths, contents)
                paths, contents, held = [], [], 0
    yield batch_of(paths, contents)


def _listed(spark: SparkSession, folder: str, suffix: str) -> tuple[DataFrame, dict[str, int]]:
    """The listing of a folder as a table in the shared folder, its ``rows`` and ``bytes``."""

    def run(_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _paths(folder, suffix)

    names = spark.range(1, numPartitions=1).mapInArrow(run, "path string")
    dealt = names.repartition(listing_parts(spark), "path")
    place = new_table_path(spark, "listing")
    versions = dealt.mapInArrow(_versions, VERSION_SCHEMA)
    counts = write_table(versions, place, bytes=F.sum("length"))
    return read_table(spark, place, schema=versions.schema), counts


def _scan(spark: SparkSession, directory: str, suffix: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(directory)


def list_files(
    spark: SparkSession, directory: str, suffix: str, limit: int | None = None
) -> DataFrame:
    """Files directly in a directory with a (case-sensitive) suffix: path, file_name, length.

    The files are those there at the call, and no bytes of them are read. ``limit`` keeps
    the first files by name.
    """
    found = list_versions(spark, directory, suffix).select(
        "path", base_name(F.col("path")).alias("file_name"), "length"
    )
    return found if limit is None else found.orderBy("file_name").limit(limit)


def list_versions(spark: SparkSession, directory: str, suffix: str) -> DataFrame:
    """Files directly in a directory: path, modified, length. No bytes are read."""
    folder = _shared_folder(spark, directory, suffix)
    if folder is not None:
        found = _listed(spark, folder, suffix)[0]
    else:
        modified = F.col("modificationTime").alias("modified")
        found = _scan(spark, directory, suffix).select("path", modified, "length")
    return found.coalesce(listing_parts(spark))


def read_files(
    spark: SparkSession, directory: str, suffix: str, limit: int | None = None
) -> DataFrame:
    """Like ``list_files`` with the ``content`` of each file.

    With a limit only the paths of the first files come to the driver (at most
    ``limit`` strings), and only those files are opened.
    """
    folder = _shared_folder(spark, directory, suffix)
    if limit is not None:
        first = list_files(spark, directory, suffix, limit).select("path").collect()
        if not first:
            return spark.createDataFrame([], BINARY_FILE_SCHEMA).select(
                "path", F.col("path").alias("file_name"), "content"
            )
        found = spark.read.format("binaryFile").load([row["path"] for row in first])
    elif folder is not None:
        listed, counts = _listed(spark, folder, suffix)
        parts = max(listing_parts(spark), -(-counts["bytes"] // TASK_BYTES))
        dealt = listed.select("path").repartition(max(1, min(parts, counts["rows"])), "path")
        found = dealt.mapInArrow(_contents, "path string, content binary")
    else:
        found = _scan(spark, directory, suffix)
    return found.select("path", base_name(F.col("path")).alias("file_name"), "content")


class FolderStream(DataSource):
    """The paths in a folder as a stream: every micro-batch has all of them. A position is the time of
    a listing, so it is another one whenever the stream is asked."""

    @classmethod
    def name(cls) -> str:
        return "roentra_folder"

    def schema(self) -> str:
        return "path string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _FolderReader(self.options["folder"], self.options["suffix"])


class _FolderReader(DataSourceStreamReader):
    def __init__(self, folder: str, suffix: str):
        self.folder, self.suffix = folder, suffix

    def initialOffset(self) -> dict:
        return {"listed": 0}

    def latestOffset(self) -> dict:
        return {"listed": time.time_ns()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [] if start == end else [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return _paths(self.folder, self.suffix)


def stream_files(
    spark: SparkSession,
    directory: str,
    suffix: str,
    files_per_batch: int = 100_000,
    on_driver: bool = False,
) -> DataFrame:
    """New files of a directory as a stream (path only).

    No file is too old. Names that begin with ``_`` or ``.`` are hidden from every
    listing of this engine and have to be renamed before. In a folder that all tasks see, the
    names that came before are keyed state of the stream, and a micro-batch takes all
    new files, as none of its tasks holds them; elsewhere it takes ``files_per_batch``, and
    the driver holds the names. ``on_driver`` is for checkpoints made before that: they go on
    with Spark's own source only.
    """
    folder = None if on_driver else _shared_folder(spark, directory, suffix)
    if folder is not None:
        spark.dataSource.register(FolderStream)
        reader = spark.readStream.format(FolderStream.name()).options(folder=folder, suffix=suffix)
        new = reader.load().dropDuplicates(["path"])
        return new.mapInArrow(_versions, VERSION_SCHEMA).select("path")
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", f"*{suffix}")
        .option("maxFileAge", "36500d")
        .load(directory)
        .select("path")
        .coalesce(listing_parts(spark))
    )
