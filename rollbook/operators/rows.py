"""Row-wise operators: projection, tags, overrides and date filters."""
from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import as_date, as_moment, col, fold, label, midnight


def conform(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Select a canonical record: {new name: column or expression}, in that order."""
    return df.select(*[col(source).alias(name) for name, source in mapping.items()])


def tag(df: DataFrame, **values) -> DataFrame:
    """Add constant columns; None makes an integer NULL column."""
    return df.withColumns({n: F.lit(None).cast("int") if v is None else F.lit(v) for n, v in values.items()})


def distinct_of(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.select(*[col(c) for c in cols]).distinct()


def override(df: DataFrame, condition: Column, values: Mapping[str, object]) -> DataFrame:
    """Set several columns where the condition is true; the condition sees the values before the change."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        name: F.when(condition, v if isinstance(v, Column) else F.lit(v).cast(types[name])).otherwise(F.col(name))
        for name, v in values.items()})


def active_as_of(df: DataFrame, begin: str | Column, end: str | Column, as_of: Column) -> DataFrame:
    """Rows with begin <= as_of <= end, compared as timestamps."""
    return df.where((as_moment(begin) <= as_of) & (as_moment(end) >= as_of))


def expired_as_of(df: DataFrame, end: str | Column, as_of: Column | dt.datetime) -> DataFrame:
    """Rows whose end lies before as_of (a datetime means the start of its day)."""
    limit = midnight(as_of) if isinstance(as_of, dt.datetime) else as_of
    return df.where(as_moment(end) < limit)


def overage(df: DataFrame, grade: str, dob: str, cutoffs: Mapping[str, dt.date] | DataFrame,
            out: str = "overage", grades: Sequence[str] = ("09", "10", "11", "12")) -> DataFrame:
    """Add a boolean: born on or before the cut-off date of the grade.

    ``cutoffs`` maps a grade to a date, or is a frame (grade, cutoff). The frame is reduced to one row per listed
    grade before it is broadcast, so the broadcast side never exceeds ``len(grades)`` rows.
    """
    if isinstance(cutoffs, Mapping):
        cutoff = label([(fold(grade) == g, F.lit(d)) for g, d in cutoffs.items()])
        return df.withColumn(out, F.coalesce(as_date(dob) <= cutoff, F.lit(False)))
    table = (cutoffs.where(F.col("grade").isin(list(grades)))
             .groupBy(F.col("grade").alias("_grade")).agg(F.max("cutoff").alias("_cutoff")))
    return (df.join(F.broadcast(table), fold(grade) == F.col("_grade"), "left")
            .withColumn(out, F.coalesce(as_date(dob) <= F.col("_cutoff"), F.lit(False)))
            .drop("_grade", "_cutoff"))
