"""Choosing rows per key.

Every pick is an aggregate: Spark combines on the map side, so a key that holds a third of all rows costs one
partial result per task. A window would move the whole group into one task.
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rollbook.functions import col, fold


def _struct(order: Sequence[Column], *more: Column) -> Column:
    return F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *more)


def _folded(df: DataFrame, order: Sequence[str | Column]) -> list[str | Column]:
    """Text columns given by name compare without case and trailing blanks."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return [fold(o) if isinstance(o, str) and o in texts else o for o in order]


def _packed(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> Column:
    """One comparable struct per row: the order columns, then the remaining columns as tie breaker."""
    first = [o if isinstance(o, str) else o.alias(f"_o{i}") for i, o in enumerate(order)]
    named = {o for o in order if isinstance(o, str)}
    return F.struct(*first, *[F.col(c) for c in df.columns if c not in keys and c not in named])


def _unpacked(df: DataFrame, keys: Sequence[str], best: DataFrame, struct: str = "_best") -> DataFrame:
    """The winning rows as rows of ``df``."""
    return best.select(*[F.col(c) if c in keys else F.col(f"{struct}.`{c}`").alias(c) for c in df.columns])


def _at_top(df: DataFrame, top: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows of ``df`` whose order columns equal the struct ``_top`` of their key."""
    side = top.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                      *[F.col(f"_top._o{i}").alias(f"_t{i}") for i in range(len(order))])
    match = ([F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
             + [o.eqNullSafe(F.col(f"_t{i}")) for i, o in enumerate(order)])
    return df.join(side, reduce(lambda a, b: a & b, match), "left_semi")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], ties: bool = False) -> DataFrame:
    """Row with the greatest ``order`` per key, NULLs lowest.

    One winner by default; equal rows are decided by the remaining columns, so the result does not depend on row
    order. With ``ties`` every row equal to the greatest stays: the maximum per key is joined back on key and
    order value, which spreads a hot key over its order values.
    """
    if not ties:
        return _unpacked(df, keys, df.groupBy(*keys).agg(F.max(_packed(df, keys, order)).alias("_best")))
    order = [col(o) for o in order]
    top = df.groupBy(*keys).agg(F.max(_struct(order)).alias("_top"))
    return _at_top(df, top, keys, order)


def preferred(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Rows with the greatest attribute values per key, texts without regard to case; equal rows all stay."""
    return latest(df, keys, _folded(df, order), ties=True)


def resolve_ties(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], preferred: Column,
                 tie_order: Sequence[str | Column]) -> DataFrame:
    """Rows with the greatest ``order`` per key, then: all preferred ones if there are any, else the single row
    with the greatest ``tie_order``.

    One grouping answers both questions: the greatest (order, preferred) tells whether a top row is preferred, the
    greatest (order, tie order, row) is the fallback. Both uses of it read all it gives, so that its shuffle is reused.
    """
    packed = _packed(df, keys, [*order, *tie_order])
    order, liked = [col(o) for o in order], F.coalesce(preferred, F.lit(False))
    best = df.groupBy(*keys).agg(F.max(_struct(order, liked.alias("liked"))).alias("_top"),
                                 F.max(packed).alias("_best"))
    fallback = _unpacked(df, keys, best.where(~F.col("_top.liked")))
    chosen = _at_top(df.where(liked), best.where(F.col("_top.liked") & F.col("_best").isNotNull()), keys, order)
    return chosen.unionByName(fallback)


def dedupe_preferred(df: DataFrame, keys: Sequence[str], required: Column,
                     attrs: Sequence[str | Column]) -> DataFrame:
    """Among keys that occur several times, the rows that carry a required attribute, best attributes first.

    Equal rows all stay. One grouping counts the key and finds its best required attributes.
    """
    order = [col(a) for a in _folded(df, attrs)]
    top = (df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("_n"), F.max(F.when(required, _struct(order))).alias("_top"))
           .where((F.col("_n") > 1) & F.col("_top").isNotNull()))
    return _at_top(df.where(required), top, keys, order)
