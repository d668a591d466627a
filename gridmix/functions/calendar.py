"""Calendar helpers: UTC day, season, event period, date parts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.constants import EVENT_LABELS, SEASON_MONTHS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_day(ts) -> Column:
    """``DATE(timestamp)``; the session time zone is UTC."""
    return F.to_date(_col(ts))


def season(date_col, months: dict | None = None) -> Column:
    """Season from the calendar month (CASE without ELSE: unknown month -> NULL)."""
    months = months or SEASON_MONTHS
    m = F.month(_col(date_col))
    expr = None
    for name, values in months.items():
        cond = m.isin(values)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value)


def period(date_col, event_date, labels: tuple = EVENT_LABELS) -> Column:
    """Before/after marker: rows before ``event_date`` get ``labels[0]``; the event day itself is after."""
    before, after = labels
    return F.when(_col(date_col) < as_date(event_date), F.lit(before)).otherwise(F.lit(after))


def year_of(date_col) -> Column:
    return F.year(_col(date_col)).cast("bigint")


def month_num_of(date_col) -> Column:
    return F.month(_col(date_col)).cast("bigint")


def month_start(date_col) -> Column:
    """First day of the month as DATE."""
    return F.trunc(_col(date_col), "MM")


def date_parts(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add ``month`` (first day), ``year`` and ``month_num`` columns."""
    return df.withColumns({
        "month": month_start(date_col),
        "year": year_of(date_col),
        "month_num": month_num_of(date_col),
    })


def days_before(anchor, n: int) -> Column:
    """``DATE_SUB(anchor, INTERVAL n DAY)``."""
    return F.date_sub(as_date(anchor), n)
