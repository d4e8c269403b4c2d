"""Agreement of the three statements' latest periods, and load checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterstone.operators.statements import Lookup, StatementSource, report


def data_stats(source: StatementSource) -> DataFrame:
    """Latest period of each statement, for companies that have all three."""
    def columns(lk: Lookup):
        return [F.col("code"), lk.rp("bs").alias("bsrp"), lk.rp("is").alias("isrp"),
                lk.rp("cf").alias("cfrp")]
    return report(source, columns)


def period_errors(source: StatementSource) -> DataFrame:
    """Companies whose statements end at different periods; an unknown period is no error."""
    bs, is_, cf = F.col("bsrp"), F.col("isrp"), F.col("cfrp")
    return data_stats(source).where((bs != cf) | (bs != is_) | (is_ != cf))


def period_counts(documents: DataFrame) -> DataFrame:
    """Number of documents per latest period; periods that occur in all three statements.

    ``documents`` holds ``statement, rp``. One conditional aggregation replaces three
    aggregations and two joins; a NULL period never joins, so it is left out first.
    """
    def count(statement: str):
        return F.count_if(F.col("statement") == statement)

    counts = documents.where(F.col("rp").isNotNull()).groupBy("rp").agg(
        count("bs").alias("bsrp"), count("is").alias("isrp"), count("cf").alias("cfrp"))
    return counts.where((F.col("bsrp") > 0) & (F.col("isrp") > 0) & (F.col("cfrp") > 0))


def stale_reports(loads: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    """Loaded reports (``code, c_date``) that are at least ``days`` old."""
    age = F.datediff(F.lit(as_of), F.col("c_date"))
    return loads.withColumn("age", age).where(F.col("age") >= days)


def expected_statements(company: DataFrame) -> DataFrame:
    """One row per company and statement that should be loaded."""
    kinds = F.array(F.lit("bs"), F.lit("is"), F.lit("cf"))
    return company.select("code", F.explode(kinds).alias("statement"))


def missing_statements(company: DataFrame, present: DataFrame) -> DataFrame:
    """Company and statement pairs without a loaded report (``present``: code, statement)."""
    return expected_statements(company).join(present, ["code", "statement"], "left_anti")


def load_progress(company: DataFrame, present: DataFrame) -> DataFrame:
    """Loaded and expected number of reports."""
    loaded = present.select("code", "statement").distinct().withColumn("loaded", F.lit(1))
    return (expected_statements(company).join(loaded, ["code", "statement"], "left")
            .agg(F.count("loaded").alias("loaded"), F.count("*").alias("total")))
