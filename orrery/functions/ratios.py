"""Ratios with the two zero-denominator rules the reports use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Double quotient, zero when it is undefined (the BI ``DIVIDE(a, b, 0)`` rule)."""
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def money(amount: Column) -> Column:
    """Exact money type: sums do not depend on the order of the rows."""
    return amount.cast("decimal(18,2)")


def as_amount(total: Column, digits: int = 2) -> Column:
    """A money total as a rounded double, for reports."""
    return F.round(total.cast("double"), digits)


def cents(x: Column) -> Column:
    """Two decimals of a double, half a cent up as written in decimals: its binary value may lie just below the half."""
    return F.round(x.cast("decimal(30,9)"), 2).cast("double")
