"""Exact money arithmetic on decimals.

Amounts are DECIMAL(14,2); Spark widens their sums to DECIMAL(24,2). Quotients
go through :func:`ratio`, which keeps at least 14 fractional digits before it
rounds half away from zero, and never divides by zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def cents(amount: Column) -> Column:
    """An amount of two decimals as a whole number of cents."""
    return (amount * 100).cast("bigint")


def ratio(numerator: Column, denominator: Column, places: int | None = None) -> Column:
    """numerator / denominator as a decimal, null where the denominator is 0."""
    quotient = numerator.cast("decimal(26,4)") / F.nullif(
        denominator.cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)")
    )
    return quotient if places is None else F.round(quotient, places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return ratio(part * 100, whole, places)


def mean(value: Column, places: int | None = None) -> Column:
    """Mean of the non-null values of a group, from an exact sum and count."""
    return ratio(F.sum(value), F.count(value), places)


def close_to(a: Column, b: Column, atol: float) -> Column:
    """Whether two amounts agree within ``atol`` plus 1e-5 of the second one."""
    return F.abs(a - b) <= F.lit(atol) + F.lit(1e-5) * F.abs(b)
