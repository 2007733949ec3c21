"""Data-quality reports. Each returns the offending rows."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import is_blank, not_blank, same
from rollbook.operators.aggregates import duplicates
from rollbook.operators.joins import Keys, enrich, semi


def dq_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once (NULL keys never match)."""
    return semi(df, duplicates(df, keys), keys)


def dq_mismatch(result: DataFrame, record: DataFrame, keys: Keys, cols: dict[str, str]) -> DataFrame:
    """Result rows that differ from the system of record in a compared column, blanks being equal."""
    seen = {f"record_{mine}": theirs for mine, theirs in cols.items()}
    joined = enrich(result, [(record, keys, seen)], how="inner")
    return joined.where(reduce(lambda a, b: a | b, [~same(mine, f"record_{mine}") for mine in cols]))


def dq_missing(result: DataFrame, record: DataFrame, keys: Keys, result_col: str, record_col: str,
               active: Column) -> DataFrame:
    """Active rows of the record with a value where the result has none; ``keys`` maps record to result columns."""
    joined = enrich(record, [(result, keys, {"_result": result_col})])
    return joined.where(is_blank("_result") & not_blank(record_col) & active).drop("_result")


def dq_rule(df: DataFrame, violated: Column) -> DataFrame:
    return df.where(violated)
