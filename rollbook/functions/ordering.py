"""Lexicographic comparison."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def precedes(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """``left`` < ``right`` position by position; False where a needed value is NULL.

    Comparing two structs would not do: there NULL sorts below every value, here it makes the answer unknown.
    """
    terms = []
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        ties = [x == y for x, y in zip(left[:i], right[:i], strict=True)]
        terms.append(reduce(lambda p, q: p & q, [*ties, a < b]))
    return F.coalesce(reduce(lambda p, q: p | q, terms), F.lit(False))
