"""Ordered results: row numbers over the whole, without a task that has all rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions import col
from rollbook.sources.tables import stage

#: Tasks over which equal rows are dealt at most.
SALTS = 64


def numbered(df: DataFrame, by: Sequence[str | Column], out: str = "row_no", partitions: int | None = None) -> DataFrame:
    """The rows with their number from 1 in the order ``by``, then of the remaining columns (NULLs first); equal rows in any order.

    Rows are dealt out by ranges of the order, sorted in each, and written once; a row's number is its place in its range plus
    the rows of the ranges before, which are summed over one row a range. Many rows of one order value are cut by the other columns,
    equal rows by a salt. The files hold the ranges in order: read in order of their names, they are the ordered result.
    """
    rows = stage(df)  # the salt below must come out the same if a task runs again: from files it does
    named = {b for b in by if isinstance(b, str)}
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in named]
    keyed = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    order = [*[col(b) for b in by], *rest, F.col("_salt")]
    dealt = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    place = F.monotonically_increasing_id()  # the task in the upper bits, the place in it in the lower 33
    placed = stage(dealt.sortWithinPartitions(*order).drop("_salt")
                   .withColumns({"_range": F.shiftright(place, 33), "_place": place.bitwiseAND(F.lit((1 << 33) - 1))}))
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # one row a range: as few as tasks
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_range", before.alias("_before"))
    return (placed.join(starts, "_range").select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_before") + F.col("_place") + 1).alias(out)))
