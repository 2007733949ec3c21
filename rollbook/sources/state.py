"""Stored state of closed extracts: what they add to a result is computed once, and merged with the live extract at every run.

A closed extract is a folder of files that no longer changes, such as last year's levels. Its partial result is kept as a versioned target
under the extract's name, with the extract's signature (names, sizes and times of its files) as its note; the merged partial
result of all closed extracts is kept likewise. A run compares signatures, which reads directory listings only. It computes
the partial results of new and changed extracts, merges anew if there are any, and otherwise reads the merged state alone.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.functions import fold, is_blank
from rollbook.sources.versions import publish, versions

Build = Callable[[DataFrame], DataFrame]


def signature(spark: SparkSession, path: str) -> str:
    """Digest of the names, sizes and modification times of all files below a folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found, listed = [], files.listFiles(place, True)
    while listed.hasNext():
        status = listed.next()
        found.append([status.getPath().toString(), status.getLen(), status.getModificationTime()])
    return hashlib.sha256(json.dumps(sorted(found)).encode()).hexdigest()


def closed_state(spark: SparkSession, extracts: Mapping[str, str], folder: str, partial: Build, merge: Build,
                 load: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """The merged partial result of the closed extracts (name -> path), from the state in ``folder`` as far as it still holds.

    ``partial`` turns an extract into its partial result, ``merge`` the union of partial results into one of the same columns. An extract
    that has left the mapping leaves the merged result too.
    """
    folder, load = folder.rstrip("/"), load or spark.read.parquet
    marks = {name: signature(spark, path) for name, path in extracts.items()}
    whole = json.dumps(marks, sort_keys=True)
    merged = versions(spark, f"{folder}/merged")
    if merged and merged[0].note == whole:
        return merged[0].read(spark)
    parts = []
    for name, path in extracts.items():
        own = versions(spark, f"{folder}/extract-{name}")
        if not own or own[0].note != marks[name]:
            own = [publish(partial(load(path)), f"{folder}/extract-{name}", note=marks[name])]
        parts.append(own[0].read(spark))
    if not parts:
        raise ValueError("no closed extract")
    return publish(merge(reduce(DataFrame.unionByName, parts)), f"{folder}/merged", note=whole).read(spark)


# ---------------------------------------------------------------- greatest level per student

def partial_levels(extract: DataFrame, key: str = "usi", level: str = "special_education_level") -> DataFrame:
    """(key, best): the greatest level text, without regard to case, in a form that can be merged."""
    return extract.where(~is_blank(level)).groupBy(key).agg(F.max(F.struct(fold(level).alias("folded"), F.col(level).alias("text"))).alias("best"))


def merged_levels(partials: DataFrame, key: str = "usi") -> DataFrame:
    return partials.groupBy(key).agg(F.max("best").alias("best"))


def levels_with_state(spark: SparkSession, closed: Mapping[str, str], live: DataFrame, folder: str, key: str = "usi",
                      level: str = "special_education_level", out: str = "max_sped_level") -> DataFrame:
    """Greatest level per student over closed extracts and the live one, as ``plans.sped.highest_levels`` gives it from all of them."""
    state = closed_state(spark, closed, folder, lambda df: partial_levels(df, key, level), lambda df: merged_levels(df, key)) if closed else None
    live = partial_levels(live, key, level)
    return merged_levels(live if state is None else live.unionByName(state), key).select(key, F.col("best.text").alias(out))
