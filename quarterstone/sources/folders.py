"""Folders of very many files, listed and read by tasks.

Spark's file sources hold the status of every file on the driver and open each file through Hadoop. Here tasks list the
folders and read the files, so the driver holds none of their names; Arrow opens the file system, where it can.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession

register_pickle_by_value(sys.modules[__name__])  # a load runs on workers that do not have this package

FILES_A_TASK = 4096
BATCH_BYTES = 8 << 20
QUOTED = re.compile(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]')  # characters that a path's URI holds as their codes

FOUND = pa.schema([("path", pa.string()), ("is_folder", pa.bool_()), ("modified", pa.int64())])
FILES = pa.schema([("path", pa.string()), ("file", pa.string()), ("modified", pa.int64())])


def is_hidden(name: str) -> bool:
    """Names that Spark's file sources pass over."""
    return (name.startswith(("_", ".")) and not (name.startswith("_") and "=" in name) and not name.startswith(("_metadata", "_common_metadata"))
            or name.endswith("._COPYING_"))


def arrow_root(spark: SparkSession, path: str) -> str | None:
    """URI of a folder that Arrow can open; None for patterns, single files, missing folders and other file systems."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toUri().toString()
    try:
        store, folder = FileSystem.from_uri(root)
        return root if store.get_file_info(folder).type == FileType.Directory else None
    except (pa.ArrowException, OSError):
        return None


def files_below(spark: SparkSession, root: str) -> DataFrame:
    """``path, file, modified`` (its URI's path, milliseconds) of all files below a folder that are not empty, as Spark's file sources pass those over too. Two levels are dealt out to tasks one after the
    other, what lies deeper is walked by the task that has the folder."""
    parts = max(spark.sparkContext.defaultParallelism, 2)
    found = spark.createDataFrame([(FileSystem.from_uri(root)[1], True, None)], "path string, is_folder boolean, modified bigint").coalesce(1)
    for _ in range(2):
        found = found.mapInArrow(_listing(root, FOUND, deep=False), "path string, is_folder boolean, modified bigint").repartition(parts, "path")
    return found.mapInArrow(_listing(root, FILES, deep=True), "path string, file string, modified bigint")


def _listing(root: str, kind: pa.Schema, deep: bool):
    """Replaces the folders among a task's rows by what they hold: files and folders, or (``deep``) all files below."""
    def run(batches):
        store, rows = FileSystem.from_uri(root)[0], []
        for batch in batches:
            for path, is_folder, modified in zip(*(batch.column(k).to_pylist() for k in range(3))):
                waiting = [path] if is_folder else []
                if not is_folder:
                    rows.append((path, _uri_path(path) if deep else False, modified))
                while waiting:
                    for info in store.get_file_info(FileSelector(waiting.pop())):
                        below = info.type == FileType.Directory
                        if is_hidden(info.base_name) or not below and not info.size:
                            continue
                        if below and deep:
                            waiting.append(info.path)
                        else:
                            at = None if info.mtime_ns is None else info.mtime_ns // 1_000_000
                            rows.append((info.path, _uri_path(info.path) if deep else below, at))
                            if len(rows) >= 10_000:
                                yield _batch(rows, kind)
                                rows = []
        yield _batch(rows, kind)
    return run


def _uri_path(path: str) -> str:
    return QUOTED.sub(lambda found: f"%{ord(found.group()):02X}", path)


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    values = list(zip(*rows)) or [[]] * len(kind)
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, kind)], schema=kind)


def tasks_for(spark: SparkSession, files: int) -> int:
    return max(-(-files // FILES_A_TASK), min(spark.sparkContext.defaultParallelism, -(-files // 64)), 1)


def contents(files: DataFrame, root: str, tasks: int) -> DataFrame:
    """Adds ``content``, the bytes of each file at ``path``, read by so many tasks; batches are bounded by their bytes. Names are
    dealt out beforehand, contents stay in the task that reads them."""
    kinds = {f.name: f.dataType.simpleString() for f in files.schema}

    def run(batches):
        store = FileSystem.from_uri(root)[0]
        for batch in batches:
            start, read, size = 0, [], 0
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path, compression=None) as stream:
                    read.append(stream.read())
                size += len(read[-1])
                if size >= BATCH_BYTES:
                    yield _with(batch, start, read)
                    start, read, size = start + len(read), [], 0
            yield _with(batch, start, read)

    ordered = files.select("path", *[c for c in files.columns if c != "path"])
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ordered.columns)
    dealt = files.sparkSession.createDataFrame(ordered.repartition(tasks, "path").rdd, schema, verifySchema=False)
    return dealt.mapInArrow(run, f"{schema}, content binary")


def _with(batch: pa.RecordBatch, start: int, read: list[bytes]) -> pa.RecordBatch:
    rows = batch.slice(start, len(read))
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(read, pa.binary())], [*rows.schema.names, "content"])
