"""Security codes and publication dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_code(code: Column | str) -> Column:
    """Six-character code: longer text is cut, shorter text gets leading zeros."""
    return F.lpad(code, 6, "0")


def _by_exchange(code: Column, shanghai: str, shenzhen: str) -> Column:
    return F.when(code.startswith("6"), shanghai).otherwise(shenzhen)


def exchange_prefix(code: Column) -> Column:
    """Quote symbol: market letters in front of the code."""
    return F.concat(_by_exchange(code, "sh", "sz"), code)


def exchange_suffix(code: Column) -> Column:
    """Consensus and survey symbol: market number behind the code."""
    return F.concat(code, _by_exchange(code, "01", "02"))


def pub_date(day: Column) -> Column:
    """Friday of the week before ``day`` (weeks start on Monday)."""
    return F.date_sub(F.to_date(day), F.weekday(day) + 3)
