"""Division and growth with the rules the reports rely on.

Statement values are DECIMAL(20,4): a quotient of two such columns keeps 18 decimals,
so the rounding that follows is not a second rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,4)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def safe_div(a: Column, b: Column) -> Column:
    """NULL when a side is NULL, zero when the divisor is zero, the quotient otherwise."""
    return F.when(a.isNull() | b.isNull(), None).when(b == 0, 0).otherwise(a / b)


def ratio(a: Column, b: Column, digits: int = 4) -> Column:
    return F.round(safe_div(a, b), digits)


def growth(new: Column, base: Column) -> Column:
    """Relative change; a zero base therefore gives -1."""
    return ratio(new, base) - 1


def compound3(new: Column, base: Column) -> Column:
    """Yearly growth that compounds to ``new`` in three years; keeps the ratio's sign."""
    root = F.cbrt(safe_div(new, base).cast("double"))
    return F.round(root, 4).cast(MONEY) - 1


def scaled(value: Column, unit: int, digits: int) -> Column:
    """``value`` in larger units, rounded."""
    return F.round(value / unit, digits)


_LOW_BITS = 24


def exact_sum(value: Column, places: int = 4) -> Column:
    """Sum of doubles that stand for decimals of ``places`` digits, free of rounding drift.

    Each value becomes a whole number of its last digit; high and low bits are summed
    apart as longs. That is many times cheaper than summing decimals, does not depend on
    the order, and cannot overflow below 2**39 rows in one group.
    """
    units = F.floor(value * 10 ** places + 0.5)
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit(2 ** _LOW_BITS - 1)))
    total = high * F.lit(2 ** _LOW_BITS).cast("decimal(8,0)") + low.cast("decimal(20,0)")
    last_digit = F.lit(f"{10 ** -places:.{places}f}").cast(f"decimal({places + 1},{places})")
    return (total * last_digit).cast(f"decimal(24,{places})")
