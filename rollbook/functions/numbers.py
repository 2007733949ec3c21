"""Decimal arithmetic with a stated scale."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions.text import col


def dec(c: str | Column, precision: int, scale: int) -> Column:
    """Decimal from a text, half away from zero; NULL where it does not parse. For computed values see ``to_scale``."""
    return col(c).try_cast(f"decimal({precision},{scale})")


def to_scale(c: str | Column, precision: int, scale: int) -> Column:
    """A computed value with the stated scale, half away from zero. It raises where it does not fit (in ANSI mode, Spark's
    default and part of ``session.SETTINGS``): a sum that overflows must not pass for a missing one."""
    return col(c).cast(f"decimal({precision},{scale})")


def safe_div(a: Column, b: Column) -> Column:
    """Quotient; NULL on a zero or missing divisor."""
    return F.try_divide(a, b)


def trunc_int(c: str | Column) -> Column:
    """Integer part, toward zero."""
    return col(c).try_cast("bigint")
