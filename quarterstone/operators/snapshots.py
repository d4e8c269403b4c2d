"""Dated snapshots: append with a load stamp, latest batch, open-day gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append_snapshot(rows: DataFrame, path: str, inserted: Column | None = None) -> None:
    """Append one batch; all its rows share one load stamp, and the day is the partition."""
    stamp = F.current_timestamp() if inserted is None else inserted
    (rows.withColumn("inserted", stamp.cast("timestamp_ntz"))
         .withColumn("snapshot_day", F.to_date("inserted"))
         .write.mode("append").partitionBy("snapshot_day").parquet(path))


def replace_day(rows: DataFrame, path: str, day: dt.date) -> None:
    """Write a day's batch; a repeated run replaces it and touches no other day. Its batch number is -1, those
    of streamed batches start at 0."""
    (rows.withColumn("inserted", F.current_timestamp().cast("timestamp_ntz"))
         .withColumn("snapshot_day", F.lit(day)).withColumn("batch", F.lit(-1))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_day", "batch").parquet(path))


def newest_day(spark: SparkSession, path: str) -> DataFrame:
    """The newest day's partition of a table of snapshots. The day is found by folder names, so that
    no file of the history is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    days = [str(f.getPath().getName()) for f in listed if str(f.getPath().getName()).startswith("snapshot_day=")]
    rows = spark.read.parquet(path)
    return rows.where(F.col("snapshot_day") == F.lit(max(days).split("=")[1]).cast("date")) if days else rows


def latest_snapshot(rows: DataFrame, stamps: DataFrame | None = None) -> DataFrame:
    """Rows of the newest batch: stamps equal to the global maximum.

    Codes that are absent from the newest batch are not filled from older ones. The
    maximum is a scalar subquery, so nothing passes through the driver and the equality
    is evaluated at the scan. ``stamps`` may name a cheaper table with the same maximum.
    Of a stored table, give ``newest_day``.
    """
    newest = (rows if stamps is None else stamps).agg(F.max("inserted"))
    return rows.where(F.col("inserted") == newest.scalar())


def open_day_rows(rows: DataFrame, calendar: DataFrame, day: Column) -> DataFrame:
    """Rows whose day is an open trading day (``calendar``: calendarDate, isOpen)."""
    open_days = calendar.where(F.col("isOpen")).select("calendarDate")
    return rows.join(open_days, F.to_date(day) == F.col("calendarDate"), "left_semi")
