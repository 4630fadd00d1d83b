"""Exact money arithmetic on long cents.

Summing DECIMAL(16,2) widens to DECIMAL(26,2), which Spark aggregates with
arbitrary-precision buffers; summing whole cents as BIGINT is a fixed-width
hash aggregate and just as exact (prices carry two decimals)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daypulse.schemas import MONEY


def cents(amount: Column) -> Column:
    """A two-decimal amount (double or decimal) as whole cents."""
    return F.round(amount.cast("double") * F.lit(100)).cast("long")


def hundredths(rate: Column) -> Column:
    """A two-decimal rate (e.g. a discount of 0.07) as whole hundredths."""
    return F.round(rate.cast("double") * F.lit(100)).cast("long")


def cents_to_money(c: Column) -> Column:
    """Whole cents -> DECIMAL(16,2), exactly."""
    return (c.cast("decimal(20,0)") / F.lit(100)).cast(MONEY)


def cents_to_double(c: Column) -> Column:
    """Whole cents -> the double nearest to the decimal amount."""
    return c.cast("double") / F.lit(100.0)


def round_half_up_to_cents(units_1e4: Column) -> Column:
    """Non-negative amounts in 1/10000 -> whole cents, half up."""
    return F.floor((units_1e4 + F.lit(50)) / F.lit(100)).cast("long")
