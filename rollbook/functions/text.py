"""Text comparison where NULL, '' and blanks all mean "missing" and neither case nor trailing blanks count.

``norm`` serves flags and labels. Key and code columns are folded once when a table is landed
(``sources.tidy``), so joins, groups and scan filters on them stay plain equality: hashable and pushed down.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c: str | Column) -> Column:
    """Comparable form of a text: lower case, no trailing blanks, NULL as ''."""
    return F.lower(F.rtrim(F.coalesce(col(c).cast("string"), F.lit(""))))


def fold(c: str | Column) -> Column:
    """Key form of a code: upper case, no trailing blanks; NULL stays NULL."""
    return F.upper(F.rtrim(col(c).cast("string")))


def is_blank(c: str | Column) -> Column:
    return F.rtrim(F.coalesce(col(c).cast("string"), F.lit(""))) == ""


def not_blank(c: str | Column) -> Column:
    return ~is_blank(c)


def equals(c: str | Column, value: str) -> Column:
    """``c`` equals the literal; NULL counts as ''. Never NULL."""
    return norm(c) == value.rstrip().lower()


def same(a: str | Column, b: str | Column) -> Column:
    return norm(a) == norm(b)


def one_of(c: str | Column, values: Iterable[str]) -> Column:
    """IN list; NULL when ``c`` is NULL, so that neither the list nor its negation keeps the row."""
    return F.lower(F.rtrim(col(c).cast("string"))).isin([v.rstrip().lower() for v in values])


def coded(df: DataFrame, code: str, c: str, values: Iterable[str]) -> Column:
    """``c`` is in the list. Where the landed frame has the folded companion ``code``, that is compared: a plain test of a stored
    column, which reaches the scan."""
    values = list(values)
    return F.col(code).isin([v.rstrip().upper() for v in values]) if code in df.columns else one_of(c, values)


def none_of(c: str | Column, values: Iterable[str]) -> Column:
    return ~one_of(c, values)


def like_ci(c: str | Column, pattern: str) -> Column:
    """LIKE with % and _ that ignores case and trailing blanks of the tested text."""
    return F.rtrim(col(c).cast("string")).ilike(pattern)
