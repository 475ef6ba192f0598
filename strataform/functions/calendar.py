"""Calendar expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(d: Column | str) -> Column:
    """Smart day key YYYYMMDD as INT.

    Same value as ``CAST(DATE_FORMAT(d, '%Y%m%d') AS UNSIGNED)`` but computed
    with integer arithmetic instead of formatting and parsing text.
    """
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_key_to_date(key: Column | str) -> Column:
    """Inverse of ``date_key``."""
    k = _c(key)
    return F.make_date((k / 10000).cast("int"), ((k / 100) % 100).cast("int"), (k % 100).cast("int"))


def day_name(d: Column | str) -> Column:
    """Full English day name ('Monday').  ``F.dayname`` gives 'Mon'."""
    return F.date_format(_c(d), "EEEE")


def month_name(d: Column | str) -> Column:
    """Full English month name ('January').  ``F.monthname`` gives 'Jan'."""
    return F.date_format(_c(d), "MMMM")


def month_bucket(d: Column | str) -> Column:
    """Month text 'YYYY-MM' (``DATE_FORMAT(d, '%Y-%m')``)."""
    return F.date_format(_c(d), "yyyy-MM")


def is_weekend(d: Column | str) -> Column:
    """1 on Saturday and Sunday (``DAYOFWEEK`` 1 = Sunday, 7 = Saturday), else 0."""
    return F.when(F.dayofweek(_c(d)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def day_before(d: Column | str) -> Column:
    """``DATE_SUB(d, INTERVAL 1 DAY)``."""
    return F.date_sub(_c(d), 1)


def as_date(value: dt.date | str | Column) -> Column:
    """A date literal from a ``datetime.date``, ISO text or a column."""
    if isinstance(value, Column):
        return F.to_date(value)
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


def calendar_columns(d: Column | str) -> list[Column]:
    """The nine ``dim_date`` columns derived from one date column."""
    d = _c(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        day_name(d).alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month_number"),
        month_name(d).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        is_weekend(d).alias("is_weekend"),
    ]
