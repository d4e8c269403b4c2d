"""Cleaning rules for downloaded text and tables, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks and their replacements; fixed values.
NO_VALUE = "--"
HTML_PAGE = "<!DOCTYPE html"


def _swap(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def clean_report(text: Column) -> Column:
    """Statement text: no-value marks become 0; blanks and surplus commas go."""
    text = _swap(_swap(_swap(text, NO_VALUE, "0"), " ", ""), ",\t", "")
    text = _swap(text, ",\r\n", "\r\n")
    return F.regexp_replace(text, r",\z", "")


def payload_verdict(text: Column, keyword: str) -> Column:
    """``html`` for an error page, ``no_keyword`` when the keyword is missing, else ``ok``."""
    return (F.when(F.contains(text, F.lit(HTML_PAGE)), "html")
            .when(~F.contains(text, F.lit(keyword)), "no_keyword").otherwise("ok"))


def zero_marks(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace cells that consist of the no-value mark by 0."""
    return rows.replace(NO_VALUE, "0", subset=columns)


def try_numbers(rows: DataFrame, columns: list[str], suffix: str = "_num") -> DataFrame:
    """Numeric value beside each text column; NULL where the text is not a number.

    A Spark column has one type, so the text stays in its own column.
    """
    return rows.withColumns({f"{c}{suffix}": F.col(c).try_cast("double") for c in columns})


def complete_columns(rows: DataFrame, key: str, keep: int = 2) -> DataFrame:
    """The key and the first ``keep`` other columns that have no missing value.

    One aggregation finds them; only its single row of counts reaches the driver.
    """
    others = [c for c in rows.columns if c != key]
    missing = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in others]).first()
    return rows.select(key, *[c for c in others if missing[c] == 0][:keep])
