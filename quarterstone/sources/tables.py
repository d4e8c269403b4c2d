"""Flat tables: pledge sheet, cached classification file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterstone.sources.cleaning import try_numbers

# Column names of the pledge sheet in sheet order, and its rows above the data; fixed values.
PLEDGE_COLUMNS = ["date", "code", "name", "stroke_nu", "am_u", "am_l", "shares", "ratio"]
PREAMBLE_ROWS = 3
# Columns of the classification table; fixed values.
CLASS_COLUMNS = ["code", "name", "class_code", "class_name", "idst_code", "idst_name"]
# Columns of the cached file: code and nine more; fixed values.
CACHE_COLUMNS = [*CLASS_COLUMNS, "pe", "pe_ttm", "pb", "dpr"]


def read_sheet(spark: SparkSession, path: str, cells: int) -> DataFrame:
    """Comma-separated sheets as ``row_no`` (0-based, in its own file) and text columns ``c0``, ...; empty lines
    do not count.

    A sheet of any size is read by as many tasks as it has splits. A line's number is its
    place in its split, from an id that ascends within a task, and the lines of the splits before;
    only one row of counts per split is ordered in one place.
    """
    lines = (spark.read.option("recursiveFileLookup", True).text(path)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
             .where(F.length("value") > 0).withColumn("id", F.monotonically_increasing_id()))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
              .select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")))
    fields = F.split("value", ",")
    return lines.join(splits, ["file", "block"]).select(
        (F.col("earlier") + F.col("id") - F.col("first")).alias("row_no"), *[F.get(fields, F.lit(i)).alias(f"c{i}") for i in range(cells)])


def pledge_ranked(sheet: DataFrame) -> DataFrame:
    """Pledged shares by ascending ratio, then code, so that rows of a frequent ratio (or
    without one) are sorted by several tasks.

    ``sheet`` has the 0-based ``row_no`` and eight text columns in sheet order.
    """
    cells = [c for c in sheet.columns if c != "row_no"]
    rows = sheet.where(F.col("row_no") >= PREAMBLE_ROWS).select(
        *[F.col(c).alias(name) for c, name in zip(cells, PLEDGE_COLUMNS, strict=True)])
    numbers = [c for c in PLEDGE_COLUMNS if c not in ("date", "name")]
    return (try_numbers(rows, numbers)
            .orderBy(F.col("ratio_num").asc_nulls_last(), F.col("ratio").asc_nulls_last(), "code_num"))


def _allow_charset(spark: SparkSession, encoding: str) -> None:
    """Spark takes only UTF and Latin charsets unless the session allows all of Java's."""
    if not encoding.lower().startswith(("utf-", "iso-8859-1", "us-ascii")):
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")


def write_csv_cache(rows: DataFrame, path: str, encoding: str = "GBK") -> None:
    _allow_charset(rows.sparkSession, encoding)
    rows.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)


def read_csv_cache(spark: SparkSession, path: str, schema: str, encoding: str = "GBK") -> DataFrame:
    _allow_charset(spark, encoding)
    return (spark.read.schema(schema).option("header", True).option("encoding", encoding)
            .option("enforceSchema", False).csv(path))


def replace_table(rows: DataFrame, table: str) -> None:
    """Drop the table and create it again with the rows' own schema."""
    rows.write.mode("overwrite").option("overwriteSchema", True).saveAsTable(table)
