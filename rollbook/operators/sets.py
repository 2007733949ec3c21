"""Unions that drop equal rows."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()


def merge_sources(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of two conformed sources, by column name."""
    return union_distinct(a, b)


def with_literal_row(df: DataFrame, **values) -> DataFrame:
    """Distinct rows plus one literal row (columns not named are NULL)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    row = df.sparkSession.range(1).select(*[F.lit(values.get(n)).cast(t).alias(n) for n, t in fields.items()])
    return union_distinct(df, row)
