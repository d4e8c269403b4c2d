"""Checks on embedding columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """True for a vector that is not null and holds neither nulls nor infinite or NaN components."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))
