"""Fiscal-period arithmetic on ISO date labels, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _offset(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def any_q4(date: Column | str, years: Column | int = 0) -> Column:
    """Label of the latest fiscal year end on or before ``date``, moved by ``years``.

    The day after a year end already lies in the next year, so the year of the next
    day less one is the wanted one, without a branch.
    """
    year = F.year(F.date_add(F.to_date(_column(date)), 1)) - 1 + _offset(years)
    return F.concat(year.cast("string"), F.lit("-12-31"))


def eofm(date: Column | str, months: Column | int = 0) -> Column:
    """Label of the last day of the month ``months`` away from ``date``."""
    moved = F.add_months(F.to_date(_column(date)), _offset(months))
    return F.last_day(moved).cast("string")
