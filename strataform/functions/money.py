"""Exact decimal measures.

All money stays DECIMAL: products and differences are exact, ``F.round`` on a
decimal rounds half away from zero, and percentages divide with
``try_divide`` so a zero denominator gives NULL (as the source database does)
instead of an ANSI division error.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import LINE_MONEY, SUM_MONEY


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def line_amount(quantity: Column | str, unit_price: Column | str) -> Column:
    """``ROUND(quantity * unit_price, 2)`` stored as DECIMAL(12,2)."""
    return F.round(_c(quantity) * _c(unit_price), 2).cast(LINE_MONEY)


def line_margin(quantity: Column | str, unit_price: Column | str, unit_cost: Column | str) -> Column:
    """``ROUND(q * price - q * cost, 2)`` stored as DECIMAL(12,2)."""
    q = _c(quantity)
    return F.round(q * _c(unit_price) - q * _c(unit_cost), 2).cast(LINE_MONEY)


def money_sum(col: Column | str) -> Column:
    """``SUM`` of line money as DECIMAL(22,2) (NULL over no rows)."""
    return F.sum(_c(col)).cast(SUM_MONEY)


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    """``ROUND(numerator * 100.0 / denominator, digits)`` as DOUBLE.

    Division and rounding are decimal (the quotient keeps at least 12
    fractional digits for DECIMAL(22,2) sums); only the rounded result is a
    double.  NULL when the denominator is zero or NULL.
    """
    ratio = F.try_divide(numerator * F.lit(Decimal("100.0")), denominator)
    return F.round(ratio, digits).cast("double")


def flag(condition: Column) -> Column:
    """``IF(condition, 1, 0)`` as INT; a NULL condition gives 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
