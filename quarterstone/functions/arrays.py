"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(rows: DataFrame, keys: list[str], array: Column | str, value: str,
             position: str | None = None) -> DataFrame:
    """``keys``, the element's position (optional) and the element: one row per element.

    Elements must not be NULL. For a plain explode the optimizer adds a filter that
    computes the array a second time; the outer form with a filter on the element does not.
    """
    if position:
        out = rows.select(*keys, F.posexplode_outer(array).alias(position, value))
    else:
        out = rows.select(*keys, F.explode_outer(array).alias(value))
    return out.where(F.col(value).isNotNull())
