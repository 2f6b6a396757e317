"""Numeric repair, and rounding that is the same on every run.

Money is DECIMAL inside the plans, so sums do not depend on the order in which
tasks finish. Ratios are one DOUBLE division, fixed to six decimals before the
half-up rounding, and published as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"
RATIO = "decimal(28,6)"


def positive_or(c: Column, default) -> Column:
    """``c`` when it is above zero, else ``default`` (also for null)."""
    return F.when(c > 0, c).otherwise(default)


def not_negative(c: Column) -> Column:
    """Null and negative become 0."""
    return F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))


def half_up(c: Column, scale: int = 2) -> Column:
    return F.round(c.cast("double").cast(RATIO), scale).cast("double")


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """num / den, null when den is 0."""
    return half_up(F.try_divide(num.cast("double"), den.cast("double")), scale)


def percent(num: Column, den: Column, scale: int = 2) -> Column:
    """num / den * 100, null when den is 0."""
    return half_up(F.try_divide(num.cast("double"), den.cast("double")) * 100, scale)


def money(c: Column) -> Column:
    """An exact amount as it is published."""
    return F.round(c, 2).cast("double")


def sum_money(c: Column) -> Column:
    """Exact sum of published (DOUBLE, two decimals) amounts."""
    return F.sum(c.cast(MONEY_SUM))


def mean(c: Column, scale: int = 2) -> Column:
    """Rounded mean of published amounts or of integers."""
    return ratio(F.sum(c.cast(MONEY_SUM)), F.count(c), scale)
