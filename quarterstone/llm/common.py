"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterstone.session import shared_dir

# A word is a run of characters other than these: space, tab, line feed, vertical tab,
# form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: lineage ends at the files,
    so a lost executor costs a re-read, not a recomputation, and every use sees the same rows."""
    spark = frame.sparkSession
    path = shared_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def drop_stored(frame: DataFrame) -> None:
    """Remove the files behind a frame made by ``stored`` that nothing reads any more."""
    spark = frame.sparkSession
    for file in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tidied(run):
    """A batch function for ``mapInArrow`` whose process gives its memory back when a task ends:
    idle workers of earlier stages share an executor with those of later ones."""
    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)
    return tidy


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
