"""Analyst consensus and institutional surveys, held as documents.

A document maps a column head to a map of row number (text) to value (text).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Row numbers and heads inside the documents; fixed values.
GROWTH_ROW, PE_ROW = "3", "5"
FORECAST = "预测"
SURVEY_HEADS = {"家数": "inst", "评级系数": "ef"}
SURVEY_ROWS = {"1": "2", "2": "3"}  # row number -> suffix of the public name


def year_keys(as_of: Column) -> list[Column]:
    """Heads for last year, and for the forecasts of this year and the two after it."""
    year = F.year(as_of)
    return [(year - 1).cast("string")] + [
        F.concat((year + k).cast("string"), F.lit(FORECAST)) for k in range(3)]


def _cell(key: Column, row: str) -> Column:
    return F.round(F.col("data")[key][row].cast("decimal(20,4)"), 2)


def _consensus(documents: DataFrame, row: str, names: list[str], as_of: dt.date | None) -> DataFrame:
    today = F.current_date() if as_of is None else F.lit(as_of)
    return documents.select(
        "code", *[_cell(key, row).alias(name) for key, name in zip(year_keys(today), names)])


def consensus_growth(documents: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return _consensus(documents, GROWTH_ROW, ["pg", "e_pg0", "e_pg1", "e_pg2"], as_of)


def consensus_pe(documents: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return _consensus(documents, PE_ROW, ["pe", "e_pe0", "e_pe1", "e_pe2"], as_of)


def surveys(documents: DataFrame) -> DataFrame:
    return documents.select("code", *[
        F.col("data")[head][row].cast("decimal(20,4)").alias(f"{name}{suffix}")
        for head, name in SURVEY_HEADS.items() for row, suffix in SURVEY_ROWS.items()])


def company_outlook(company: DataFrame, consensus: DataFrame, survey: DataFrame) -> DataFrame:
    """Company with consensus (growth or P/E) and survey figures."""
    dim = company.select("code", "name", F.col("industry").alias("idst"), "area")
    return dim.join(consensus, "code").join(survey, "code")
