"""Dates. "Today" is always the parameter ``as_of``; no expression reads the clock."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions.text import col

US_DATE = "MM/dd/yyyy"


def moment(as_of: dt.datetime) -> Column:
    """``as_of`` with its time of day."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def midnight(as_of: dt.datetime) -> Column:
    """Start of the ``as_of`` day."""
    return F.lit(as_of.date().isoformat()).cast("timestamp_ntz")


def _other_forms(c: Column) -> Column:
    """Timestamp from month/day/year, with or without a time, or from yyyymmdd."""
    return F.try_to_timestamp(F.nullif(F.rtrim(c.cast("string")), F.lit("")), F.lit("[M/d/yyyy[ H:mm[:ss]]][yyyyMMdd]"))


def as_date(c: str | Column) -> Column:
    """Date from a date, timestamp or text (ISO, month/day/year with or without a time, or yyyymmdd); NULL where it does
    not parse."""
    c = col(c)
    return F.coalesce(c.try_cast("date"), _other_forms(c).cast("date"))


def as_moment(c: str | Column) -> Column:
    """Zone-free timestamp from a date, timestamp or text; NULL where it does not parse."""
    c = col(c)
    return F.coalesce(c.try_cast("timestamp_ntz"), _other_forms(c).cast("timestamp_ntz"))


def order_date(c: str | Column) -> Column:
    """Sort key: a blank text sorts as 1900-01-01 (above NULL, below real dates)."""
    c = col(c)
    blank = F.rtrim(c.cast("string")) == ""
    return F.when(blank, F.lit(dt.date(1900, 1, 1))).otherwise(as_date(c))


def text_us(c: str | Column) -> Column:
    return F.date_format(col(c), US_DATE)


def shift_days(c: str | Column, n: int) -> Column:
    return F.date_add(as_date(c), n)


def years_before(c: str | Column, n: int) -> Column:
    return F.add_months(col(c), -12 * n)


def year_diff(start: str | Column, end: str | Column) -> Column:
    """Year boundaries crossed, not full years."""
    return F.year(col(end)) - F.year(col(start))
