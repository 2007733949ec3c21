"""Grouped operators."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import col, dec, equals, fold, is_blank, label, norm, to_scale

# How often a service of a period code falls in a week, in 36ths (1 daily x5, 2 weekly x1,
# 3 monthly /4, 6 yearly /36). Whole 36ths keep the sum exact; the one division comes last.
WEEKLY_36THS = {"1": 180, "2": 36, "3": 9, "6": 1}


def minutes_36ths(spent: str | Column = "time_spent", units: str | Column = "time_units",
                  period: str | Column = "time_period", sessions: str | Column = "num_sessions") -> Column:
    """Weekly minutes of one service row times 36; NULL for another period code."""
    time = F.when(is_blank(spent), F.lit(0)).otherwise(dec(spent, 10, 2))
    unit = F.when(equals(units, "1"), 1).otherwise(60)
    weight = label([(equals(period, code), w) for code, w in WEEKLY_36THS.items()])
    count = F.when(is_blank(sessions), 1).otherwise(col(sessions).try_cast("bigint"))
    return time.cast("decimal(10,2)") * (unit * weight * count).cast("decimal(12,0)")


def from_36ths(total: Column) -> Column:
    return to_scale(total / F.lit(36), 18, 6)


def weekly_minutes(df: DataFrame, keys: Sequence[str], out: str = "minutes", **columns: str | Column) -> DataFrame:
    """Weekly service minutes per key."""
    return df.groupBy(*keys).agg(from_36ths(F.sum(minutes_36ths(**columns))).alias(out))


def duplicates(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def multi_flag_keys(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Keys with more than one YES row."""
    return duplicates(df.where(norm(flag) == "yes"), [key]).select(key)


def max_level(df: DataFrame, key: str = "usi", level: str = "special_education_level",
              out: str = "max_sped_level") -> DataFrame:
    """Greatest non-blank level text per key, without regard to case; of equal ones the greatest as written."""
    return df.where(~is_blank(level)).groupBy(key).agg(F.max(F.struct(fold(level), F.col(level).alias("text")))["text"].alias(out))


def pivot_fields(df: DataFrame, keys: Sequence[str], label_col: str, value_col: str,
                 labels: Sequence[str]) -> DataFrame:
    """Long to wide over a fixed label list, least value per cell; a key without listed labels keeps its row."""
    named = label([(equals(label_col, name), name) for name in labels], col(label_col))
    return (df.select(*keys, named.alias("_label"), F.col(value_col).alias("_value"))
            .groupBy(*keys).pivot("_label", list(labels)).agg(F.min("_value")))
