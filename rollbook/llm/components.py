"""Connected components of an edge table by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.sources.tables import release, stage


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("v", "u"))


def _hung(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """Hang the neighbours v of each u on the least of them: (v, low)."""
    return pairs.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, root): the least node reachable from each node of ``edges`` (u, v), itself left out where it is the root.

    A node's neighbours are never gathered: the least is an aggregate with map-side combine, and the join back can be
    split at a hot node. Each round is written to the shared folder. Self-loops and repeated edges do no harm; NULLs
    are dropped.
    """
    now = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(max_rounds):
        pairs = _both(now)
        least = pairs.groupBy("u").agg(F.min(F.least("u", "v")).alias("low"))
        large = _hung(pairs.where("v > u"), least).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = stage(_hung(large, low).union(low).select("u", F.col("v").alias("v")).distinct())
        found = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).head()
        release(now)
        now = small
        if found == mark:
            return now.select("u", F.col("v").alias("root"))
        mark = found
    raise RuntimeError(f"no end after {max_rounds} rounds")
