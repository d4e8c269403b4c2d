"""Quote snapshots as a stream: new files are parsed and appended, exactly once per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarterstone.sources.quotes import parse_quote_records

# A delivery's stamp in its file's name: year to second; fixed value.
STAMP = r"(\d{14})"


def append_stream(rows: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append every micro-batch of ``rows`` (with ``inserted``) to a partitioned table.

    The batch number is part of the partition path and is replaced when a batch is
    repeated after a failure, so no row is stored twice.
    """
    def store(batch: DataFrame, number: int) -> None:
        (batch.withColumn("snapshot_day", F.to_date("inserted")).withColumn("batch", F.lit(number))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("snapshot_day", "batch").parquet(table))

    return (rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_stream(spark: SparkSession, schema, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def quote_stream(spark: SparkSession, path: str, late: str = "7 days", files_per_batch: int = 1000) -> DataFrame:
    """Parsed quote records of the files under ``path``, a record of a code and stamp once.

    The stamp (``inserted``) comes from the file's name, or is the time of its last change. A
    delivery that comes again, whole or in part and under any name, adds nothing: codes are remembered by stamp until
    stamps are ``late`` behind the newest, and what is older is left out.
    """
    files = (spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True).text(path)
             .select("value", "_metadata.file_name", "_metadata.file_modification_time"))
    named = F.try_to_timestamp(F.nullif(F.regexp_extract("file_name", STAMP, 1), F.lit("")), F.lit("yyyyMMddHHmmss"))
    stamped = files.select("value", F.coalesce(named, "file_modification_time").alias("inserted"))
    return (parse_quote_records(stamped, "value", ["inserted"]).withWatermark("inserted", late)
            .dropDuplicatesWithinWatermark(["code", "inserted"])
            .withColumn("inserted", F.col("inserted").cast("timestamp_ntz")))


def open_day_stream(rows: DataFrame, calendar: DataFrame) -> DataFrame:
    """Records of open trading days (``calendar``: calendarDate, isOpen), which each batch reads anew."""
    open_days = calendar.where(F.col("isOpen")).select("calendarDate").distinct()
    return rows.join(open_days, F.to_date("inserted") == F.col("calendarDate"), "left_semi")
