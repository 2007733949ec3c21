"""Flags, labels, bands and conditional values."""
from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions.numbers import trunc_int
from rollbook.functions.text import col, is_blank, norm

# Spellings that count as "yes" on the profile sheets, and as "false" on service rows.
YES_SPELLINGS = ("Y", "YES", "1")
FALSE_SPELLINGS = ("", "0", "False")


def _lower(values: Iterable[str]) -> list[str]:
    return [v.rstrip().lower() for v in values]


def _otherwise(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def is_yes(c: str | Column) -> Column:
    return norm(c).isin(_lower(YES_SPELLINGS))


def is_false(c: str | Column) -> Column:
    return norm(c).isin(_lower(FALSE_SPELLINGS))


def yes_no(c: str | Column, yes: Iterable[str] = ("Y",), no: Iterable[str] = ("N",), other=None) -> Column:
    """'YES'/'NO' by spelling; anything else is ``other`` (by default the value itself)."""
    return (F.when(norm(c).isin(_lower(yes)), "YES").when(norm(c).isin(_lower(no)), "NO")
            .otherwise(col(c) if other is None else _otherwise(other)))


def label(rules: Iterable[tuple[Column, object]], otherwise=None) -> Column:
    """First matching rule gives the value; NULL without ``otherwise``."""
    chain = F
    for condition, value in rules:
        chain = chain.when(condition, value)
    return chain.otherwise(_otherwise(otherwise))


def band(c: str | Column, bands: Iterable[tuple[object, object, str]]) -> Column:
    """Label of the closed band [low, high] that holds the value; a bound of None is open (strict)."""
    def inside(low, high):
        if high is None:
            return col(c) > low
        return col(c) < high if low is None else col(c).between(low, high)
    return label([(inside(low, high), name) for low, high, name in bands])


def recode(c: str | Column, codes: Mapping[str, str]) -> Column:
    """Replace listed codes, keep the rest."""
    return label([(col(c) == old, new) for old, new in codes.items()], col(c))


def when_flag(flag: Column, value: str | Column, otherwise="") -> Column:
    """Carry ``value`` only where the flag holds."""
    return F.when(flag, col(value)).otherwise(_otherwise(otherwise))


def fill_blank(c: str | Column, other: str | Column) -> Column:
    return F.when(is_blank(c), col(other)).otherwise(col(c))


def clamp_min(c: str | Column, low: int = 0) -> Column:
    """Values whose integer part lies below ``low`` become ``low``."""
    return F.when(trunc_int(c) < low, F.lit(low)).otherwise(col(c))


def any_flag(flags: Iterable[str | Column]) -> Column:
    """'YES' if any flag reads YES, else 'NO'."""
    hit = reduce(lambda a, b: a | b, [norm(f) == "yes" for f in flags])
    return F.when(hit, "YES").otherwise("NO")
