"""Reading dated histories and yearly extracts."""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions import moment
from rollbook.operators.sets import union_distinct
from rollbook.sources.schemas import DAY


def snapshot(df: DataFrame, date_col: str, day: dt.date, whole_day: bool = False) -> DataFrame:
    """Rows logged at midnight of ``day``; with ``whole_day`` at any time of that day.

    Both are range tests on the bare column, so they reach the scan. Of a history landed by ``landing.land_days`` only the day's
    partition is read.
    """
    if DAY in df.columns:
        df = df.where(F.col(DAY) == F.lit(day))
    start = F.lit(day.isoformat()).cast("timestamp_ntz")
    if not whole_day:
        return df.where(F.col(date_col) == start)
    end = F.lit((day + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    return df.where((F.col(date_col) >= start) & (F.col(date_col) < end))


def since(df: DataFrame, date_col: str, day: dt.date) -> DataFrame:
    """Rows dated after ``day`` (its own rows excluded); of a landed history only the later days' partitions are read."""
    if DAY in df.columns:
        df = df.where(F.col(DAY) > F.lit(day))
    return df.where(F.col(date_col) >= F.lit((day + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz"))


def union_years(dfs: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """Yearly extracts as one source, equal rows once."""
    return union_distinct(*[df.select(*cols) for df in dfs])


def with_snapshot(df: DataFrame, as_of: dt.datetime, out: str = "snapshot_date") -> DataFrame:
    return df.withColumn(out, moment(as_of))
