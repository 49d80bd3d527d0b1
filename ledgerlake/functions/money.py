"""Exact money arithmetic on integer cents.

Cents are DECIMAL(18,0) and rates DECIMAL(12,6), so every product below fits into 38
digits without losing scale. The cast to the result type rounds it exactly once, half away
from zero. All currencies are divided by 100, zero-decimal ones included.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(12,6)"

CENT = Decimal("0.01")
WEEKS_PER_MONTH = Decimal("4.333")
DAYS_PER_MONTH = Decimal("30")
MONTHS_PER_YEAR = 12


def _exact(cents: Column) -> Column:
    return cents.cast("decimal(18,0)")


def rate_or_one(rate: Column) -> Column:
    """A missing exchange rate counts as 1."""
    return F.coalesce(rate.cast(RATE), F.lit(Decimal("1.000000")).cast(RATE))


def from_cents(cents: Column) -> Column:
    """Cents to currency units."""
    return (_exact(cents) * F.lit(CENT)).cast(MONEY)


def from_cents_at(cents: Column, rate: Column) -> Column:
    """Cents to currency units converted with ``rate``."""
    return (_exact(cents) * F.lit(CENT) * rate.cast(RATE)).cast(MONEY)


def monthly(cents: Column, interval: Column, rate: Column | None = None,
            interval_count: Column | None = None, scale_daily: bool = True) -> Column:
    """Monthly equivalent of a recurring amount billed every ``interval``.

    Year is divided by 12, week multiplied by 4.333, day by 30, anything else kept.
    ``scale_daily=False`` leaves daily plans unscaled. ``interval_count`` additionally
    divides by the number of intervals per bill.
    """
    factor = rate.cast(RATE) if rate is not None else F.lit(Decimal("1")).cast("decimal(1,0)")

    def scaled(multiplier: Decimal) -> Column:
        # The constants are folded first: fewer digits in the running product.
        return _exact(cents) * F.lit(CENT * multiplier) * factor

    yearly = _exact(cents) * factor / F.lit(Decimal(100 * MONTHS_PER_YEAR))
    daily = scaled(DAYS_PER_MONTH) if scale_daily else scaled(Decimal(1))
    # A common type of all branches would have to give up digits, so each is rounded by itself.
    value = (
        F.when(interval == "year", yearly.cast(MONEY))
        .when(interval == "week", scaled(WEEKS_PER_MONTH).cast(MONEY))
        .when(interval == "day", daily.cast(MONEY))
        .otherwise(scaled(Decimal(1)).cast(MONEY))
    )
    if interval_count is None:
        return value
    n = F.when(interval_count > 1, interval_count).otherwise(F.lit(1)).cast("decimal(9,0)")
    return (value / n).cast(MONEY)


def negated(amount: Column) -> Column:
    return (-amount).cast(MONEY)


def outflow(amount: Column) -> Column:
    """Minus the absolute value."""
    return (-F.abs(amount)).cast(MONEY)
