"""Statement report files to documents.

A report file is a CSV with line items down and periods across. One file holds one
company's one statement, so a file is read as one value, taken apart by expressions, and
becomes its document without a shuffle. Cells of any origin can be gathered into the same
documents as well.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterstone.functions import MONEY_TYPE, exploded
from quarterstone.operators.keyed import keep_first
from quarterstone.plans.items import STATEMENTS
from quarterstone.sources import folders
from quarterstone.sources.cleaning import clean_report, payload_verdict

# File names: statement prefix, then the six characters of the code (more, if all are
# digits, so that longer codes stay distinct); fixed values.
FILE_NAME = r"(?:^|[/=])(bs|is|cf)_(\d{6,}|[^/]{6})[^/]*(?:/part-[^/]*)?$"
COMPRESSED = r"\.(?:bz2|deflate|gz|lz4|snappy|zst)$"  # names that Spark's text reader unpacks
HEAD = "报告日期"
PERIOD_LABEL = r"^\d{4}-\d{2}-\d{2}$"


def read_statement_folder(spark: SparkSession, path: str) -> DataFrame:
    """``statement, code, loaded, content`` of every report file; other files are ignored.

    A file may be a plain one (``is_600660.csv``) or a written partition folder of that
    name. Tasks list the folder and read its files, so that the driver holds no file's status. Spark's readers take a file
    system that Arrow does not open, and compressed files.
    """
    root = folders.arrow_root(spark, path)
    if root is None:
        return _spark_read(spark, [path])
    found = folders.files_below(spark, root).withColumn("packed", F.rlike("file", F.lit(COMPRESSED)))
    reports = report_files(found)
    numbers = reports.agg(F.count_if(~F.col("packed")).alias("plain"), F.count_if("packed").alias("packed")).first()
    plain = folders.contents(reports.where(~F.col("packed")).drop("packed"), root, folders.tasks_for(spark, numbers["plain"]))
    plain = plain.select(F.col("content").cast("string").alias("content"), F.timestamp_millis("modified").alias("loaded"), "statement", "code")
    if not numbers["packed"]:
        return plain
    names = [re.sub(r"([{}\[\]*?\\])", r"\\\1", r["path"]) for r in reports.where("packed").select("path").collect()]
    start = re.match(r"[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", root).group()
    return plain.unionByName(_spark_read(spark, [start + name for name in names]))


def _spark_read(spark: SparkSession, paths: list[str]) -> DataFrame:
    """As Spark's readers list and read them: the plain ones as bytes, since the text reader sets up its codecs anew for
    each file; it reads those that are compressed."""
    file, loaded = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("loaded")
    folder = spark.read.option("recursiveFileLookup", True)
    packed = F.rlike("file", F.lit(COMPRESSED))
    plain = folder.format("binaryFile").load(paths).select(file, F.col("content").cast("string").alias("content"), loaded)
    coded = folder.text(paths, wholetext=True).select(file, F.col("value").alias("content"), loaded)
    return report_files(plain.where(~packed)).unionByName(report_files(coded.where(packed)))


def report_files(files: DataFrame) -> DataFrame:
    """Statement and code from the name (``file``); rows of other files are dropped. A code that is
    no number is NULL."""
    name = F.col("file")
    return (files.where(F.rlike(name, F.lit(FILE_NAME)))
            .withColumn("statement", F.regexp_extract(name, FILE_NAME, 1))
            .withColumn("code", F.regexp_extract(name, FILE_NAME, 2).try_cast("bigint"))
            .drop("file"))


def _tables(reports: DataFrame) -> DataFrame:
    """Adds ``rows`` (cells of each non-empty line after the head) and ``dated`` (period and
    position of the head's cells that are dates; other columns are dropped)."""
    lines = F.filter(F.split("content", r"\r?\n"), lambda x: F.length(x) > 0)
    cells = reports.withColumn("cells", F.transform(lines, lambda x: F.split(x, ",")))
    head = F.transform(F.get("cells", F.lit(0)), lambda label, i: F.struct(
        label.alias("period"), i.alias("position")))
    body = F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0)))
    return cells.select("statement", "code", body.alias("rows"), F.filter(
        head, lambda h: F.rlike(h["period"], F.lit(PERIOD_LABEL))).alias("dated"))


def _values(row: Column) -> Column:
    """Pairs of period and value of a row; an empty cell is NULL."""
    return F.transform("dated", lambda d: F.struct(
        d["period"].alias("period"),
        F.nullif(F.get(row, d["position"]), F.lit("")).try_cast(MONEY_TYPE).alias("value")))


def judged_reports(reports: DataFrame) -> DataFrame:
    """Downloaded reports, cleaned, with ``verdict``: ``ok``, or why a report must not become a document (an error page,
    no head, a file name without a code, no dated period, an item that occurs twice, a cell that is
    no number). Each report is judged by its own text, so a bad one stops no other."""
    raw = reports.withColumn("page", payload_verdict(F.col("content"), HEAD))
    reports = raw.withColumn("content", clean_report(F.col("content")))
    tables = _tables(reports.withColumn("statement", F.struct("statement", *[c for c in reports.columns if c != "statement"])))
    items = F.transform("rows", lambda row: F.get(row, F.lit(0)))
    bad = F.exists("rows", lambda row: F.exists("dated", lambda d: F.coalesce(
        (F.get(row, d["position"]) != "") & F.get(row, d["position"]).try_cast(MONEY_TYPE).isNull(), F.lit(False))))
    verdict = (F.when(F.col("statement.page") != "ok", F.col("statement.page"))
               .when(F.col("code").isNull(), "code").when(F.size("dated") == 0, "no_period")
               .when(F.size(F.array_distinct(items)) < F.size(items), "repeated_item")
               .when(F.size(F.array_distinct("dated.period")) < F.size("dated"), "repeated_period")
               .when(bad, "bad_cell").otherwise("ok"))
    return tables.select("statement.*", verdict.alias("verdict")).drop("page")


def newest_reports(reports: DataFrame) -> DataFrame:
    """One report per statement and code: of several files the last modified, then the last by text."""
    return keep_first(reports, ["statement", "code"], [-F.unix_micros("loaded"), F.xxhash64("content")])


def file_documents(reports: DataFrame) -> DataFrame:
    """Documents ``statement, code, rp, data`` (item -> {period -> value}), one per report."""
    items = F.transform("rows", lambda row: F.struct(
        F.get(row, F.lit(0)), F.map_from_entries(_values(row))))
    return _tables(reports).select(
        "statement", "code", F.array_max("dated.period").alias("rp"), F.map_from_entries(items).alias("data"))


def report_cells(reports: DataFrame) -> DataFrame:
    """``statement, code, item, period, value``: one row per cell of each report."""
    rows = exploded(_tables(reports), ["statement", "code", "dated"], "rows", "row")
    rows = rows.withColumn("item", F.get("row", F.lit(0)))
    cells = exploded(rows, ["statement", "code", "item"], _values(F.col("row")), "c")
    return cells.select("statement", "code", "item", "c.period", "c.value")


def nested_documents(cells: DataFrame) -> DataFrame:
    """Documents ``statement, code, rp, data`` with ``data`` = item -> {period -> value}.

    The first grouping is by item, so no task meets more than one company's one item at a
    time; a document is bounded by its items and periods.
    """
    items = cells.groupBy("statement", "code", "item").agg(
        F.max("period").alias("rp"),
        F.map_from_entries(F.collect_list(F.struct("period", "value"))).alias("periods"))
    return items.groupBy("statement", "code").agg(
        F.max("rp").alias("rp"),
        F.map_from_entries(F.collect_list(F.struct("item", "periods"))).alias("data"))


def lookup_form(documents: DataFrame, statement: str) -> DataFrame:
    """Nested documents (``data`` item -> {period -> value}) in lookup form, without a shuffle.

    Keeps one output row per document, so several documents of a company stay several.
    """
    periods = F.array_distinct(F.flatten(F.transform(F.map_values("data"), F.map_keys)))

    def element(period: Column) -> Column:
        return F.struct(period.alias("period"), *[
            F.col("data")[label][period].cast(MONEY_TYPE).alias(field)
            for field, label in STATEMENTS[statement].items()])

    return documents.withColumn("data", F.transform(periods, element))


def parse_documents(documents: DataFrame) -> DataFrame:
    """Documents stored as JSON text to nested maps."""
    parsed = F.from_json("data", "map<string,map<string,string>>")
    return documents.withColumn("data", parsed)


def variant_documents(documents: DataFrame) -> DataFrame:
    """Documents stored as JSON text, with ``data`` as VARIANT: parsed once, and looked into by path."""
    return documents.withColumn("data", F.parse_json("data"))


def document_value(data: Column, item: Column | str, period: Column) -> Column:
    """Value of an item at a period in a VARIANT document; NULL when either is missing."""
    item = F.lit(item) if isinstance(item, str) else item
    path = F.concat(F.lit("$['"), item, F.lit("']['"), period, F.lit("']"))
    return F.try_variant_get(data, path, MONEY_TYPE)


def store_documents(documents: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Save documents bucketed by code: later joins on code need no exchange.

    Rows are put into their bucket's task first, so that each bucket is one file.
    """
    rows = documents.repartition(buckets, "code").write.mode("overwrite")
    rows = rows.option("path", path) if path else rows
    rows.bucketBy(buckets, "code").sortBy("code").format("parquet").saveAsTable(table)
