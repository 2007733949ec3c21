"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of one Arrow batch. Texts may be long, so few at a time.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


#: What operators keep in a Python worker from task to task, by their names.
_CACHES: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """A dictionary that stays in a Python worker while ``owner``'s tasks follow each other."""
    return _CACHES.setdefault(owner, {})


def release_caches(owner: str | None) -> None:
    """Empty the caches of all other operators: workers are reused, and their memory counts in every later stage."""
    held = [cache for name, cache in _CACHES.items() if name != owner and cache]
    for cache in held:
        cache.clear()
    if held:
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries give memory back by themselves, or not
            ctypes.CDLL(None).malloc_trim(0)


def arrow_map(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType, owner: str | None = None) -> DataFrame:
    """``mapInArrow`` with batches small enough for whole long texts. ``owner`` names the cache that the work goes on using."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches(owner)
        yield from work(batches)

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def widened(df: DataFrame, ddl: str) -> StructType:
    """The schema of a frame with the columns of a DDL string added."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def set_aside(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The needed columns and one struct of all others, so that no name can clash with an operator's; and a function that
    puts the columns of its result (with changed or fewer rows) back as they were."""
    others = [c for c in df.columns if c not in needed]
    rest = F.struct(*[F.col(f"`{c}`") for c in others], F.lit(None).cast("int").alias("nothing_else")).alias("set_aside")

    def restore(result: DataFrame) -> DataFrame:
        return result.select(*[F.col(f"`{c}`") if c in needed else F.col(f"set_aside.`{c}`").alias(c) for c in df.columns])
    return df.select(*needed, rest), restore


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to be no column of the frame."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that an operator is about to add: its own result replaces an input column of the same name."""
    lowered = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in lowered])


def batch_of(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once: a lambda's argument is never inlined by the optimizer."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blank_split(text: Column) -> Column:
    """Words of a text, apart at ASCII blanks; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
