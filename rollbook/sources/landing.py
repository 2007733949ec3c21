"""Landing a dated history day by day, and landing with rejected rows set aside.

``land_days`` keeps a copy of a history, partitioned by ``logday``. A record, a versioned target beside it, holds each landed day and the number
of rows the source had for it. A run counts the source's rows per day, lands the days that are new or whose number
has changed, replacing just their partitions, and publishes the record last: a day is read only once it is recorded.

``land_checked`` writes a source twice over, its good rows and its rejected cells, in one reading of it.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StructType, TimestampNTZType, TimestampType

from rollbook.functions import as_date, as_moment
from rollbook.sources.schemas import CODES, COMPANIONS, DAY, SOURCES
from rollbook.sources.tables import Conf, load, stage, tidy
from rollbook.sources.versions import publish, versions

_ONE_DAY = dt.timedelta(days=1)


# ---------------------------------------------------------------- days

def _ranges(days: Sequence[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Sorted days as ranges of neighbouring days, ends excluded."""
    out: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if out and out[-1][1] == day:
            out[-1] = (out[-1][0], day + _ONE_DAY)
        else:
            out.append((day, day + _ONE_DAY))
    return out


def on_days(date_col: str, days: Sequence[dt.date]) -> Column:
    """Whether a timestamp column lies on one of the days: ranges of the bare column, which a scan can use."""
    at = lambda day: F.lit(day.isoformat()).cast("timestamp_ntz")
    return reduce(lambda a, b: a | b, [(F.col(date_col) >= at(a)) & (F.col(date_col) < at(b)) for a, b in _ranges(days)], F.lit(False))


@dataclass(frozen=True)
class Landing:
    """What a run landed, and the history as recorded after it."""
    days: list[dt.date]
    undated: bool
    history: DataFrame


def record_of(spark: SparkSession, folder: str) -> dict[dt.date | None, int]:
    """Landed days and their number of source rows."""
    found = versions(spark, f"{folder.rstrip('/')}/record")
    return {r[DAY]: r["n"] for r in found[0].read(spark).collect()} if found else {}


def recorded(spark: SparkSession, folder: str) -> DataFrame:
    """The landed history: the recorded days, and the rows without a day."""
    days = record_of(spark, folder)
    rows = spark.read.parquet(f"{folder.rstrip('/')}/rows")
    return rows.where(F.col(DAY).isin([d for d in days if d is not None]) | (F.col(DAY).isNull() if None in days else F.lit(False)))


def land_days(spark: SparkSession, name: str, conf: Conf, folder: str, date_col: str = "logdate", where: str | Column | None = None,
              columns: Sequence[str] | None = None) -> Landing:
    """Land the days of a history that are new, or whose number of rows in the source is another than the recorded one.

    ``where`` and ``columns`` reach the source's scan. They belong to the folder: take another one for other values. Rows whose date is missing
    or does not parse form a partition of their own, which any change of their number replaces. A day that has gone from the source stays
    as landed. The first step reads one column of the source.
    """
    folder = folder.rstrip("/")
    source = load(spark, name, conf)
    if where is not None:
        source = source.where(where)
    present = {c.lower(): c for c in source.columns}
    stored = F.col(f"`{present[date_col]}`")
    schema = StructType.fromDDL(SOURCES[name])
    typed = dict(source.dtypes)[present[date_col]].startswith("timestamp")
    moment = stored.cast("timestamp_ntz") if typed else as_moment(stored)
    counts = {r["day"]: r["n"] for r in source.groupBy(moment.cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a day
    landed = record_of(spark, folder)
    new = {day for day, n in counts.items() if landed.get(day) != n}
    days = sorted(d for d in new if d is not None)
    if new:
        wanted = on_days(present[date_col], days) if typed else moment.cast("date").isin(days)
        rows = tidy(source.where(wanted | (moment.isNull() if None in new else F.lit(False))), schema, CODES.get(name, ()), COMPANIONS.get(name))
        rows = rows.select(*(columns or rows.columns), F.col(date_col).cast("date").alias(DAY))
        (rows.repartition(DAY, F.pmod(F.xxhash64(*[c for c in rows.columns if c != DAY]), F.lit(_files_per_day(counts, new))))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(f"{folder}/rows"))
        landed |= {d: counts[d] for d in new}
        publish(spark.createDataFrame([(d, n) for d, n in landed.items()], f"{DAY} date, n long").coalesce(1), f"{folder}/record")
    return Landing(days, None in new, recorded(spark, folder))


#: Rows of a day's file, about; a day with more is dealt over several tasks.
FILE_ROWS = 2_000_000


def _files_per_day(counts: dict, new: set) -> int:
    return max(1, -(-max(counts[d] for d in new) // FILE_ROWS))


# ---------------------------------------------------------------- rejected cells

REASONS: dict[type[DataType], str] = {IntegralType: "not an integer of this size", DateType: "not a date", TimestampNTZType: "not a moment", TimestampType: "not a moment"}


def _parsed(source: Column, kind: DataType) -> Column:
    if isinstance(kind, DateType):
        return as_date(source)
    return as_moment(source).cast(kind) if isinstance(kind, (TimestampType, TimestampNTZType)) else source.try_cast(kind)


def rejections(df: DataFrame, schema: str | StructType, required: Sequence[str] = ()) -> Column:
    """array<struct<column, text, reason>> of a source row: texts that do not fit their column's type, and blank required columns."""
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    present = {c.lower(): c for c in df.columns}
    tests = []
    for field in fields:
        if field.name not in present:
            if field.name in required:
                tests.append((F.lit(True), field.name, F.lit(None).cast("string"), "missing"))
            continue
        source = F.col(f"`{present[field.name]}`")
        text = source.cast("string")
        blank = F.coalesce(F.trim(text) == "", F.lit(True))
        if field.name in required:
            tests.append((blank, field.name, text, "missing"))
        for kind, reason in REASONS.items():
            if isinstance(field.dataType, kind):
                tests.append((~blank & _parsed(source, field.dataType).isNull(), field.name, text, reason))
    found = [F.when(bad, F.struct(F.lit(name).alias("column"), text.alias("text"), F.lit(reason).alias("reason"))) for bad, name, text, reason in tests]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<struct<column:string,text:string,reason:string>>")


class TooManyRejected(ValueError):
    """More rows were rejected than the threshold allows."""


@dataclass(frozen=True)
class Checked:
    """Good rows in tidy form; rejected cells (row, column, text, reason), ``row`` being the whole source row; counts."""
    good: DataFrame
    rejected: DataFrame
    n_rows: int
    n_rejected: int


def land_checked(spark: SparkSession, name: str, conf: Conf, where: str | Column | None = None, columns: Sequence[str] | None = None,
                 required: Sequence[str] = (), most_rejected: float = 1.0) -> Checked:
    """Land a source with its bad rows set aside: a row with a text that does not fit its column, or without a required value, is rejected,
    and each such cell is told. The source is read once; the rows are counted by ``observe`` while they are written.

    Raises where more than the share ``most_rejected`` of the rows is rejected; what was written then goes with the driver.
    """
    source = load(spark, name, conf)
    source = source if where is None else source.where(where)
    return check(source, SOURCES[name], CODES.get(name, ()), COMPANIONS.get(name), columns, required, most_rejected)


def check(source: DataFrame, schema: str | StructType, codes: Sequence[str] = (), companions: Mapping[str, str] | None = None,
          columns: Sequence[str] | None = None, required: Sequence[str] = (), most_rejected: float = 1.0) -> Checked:
    """``land_checked`` of a frame."""
    seen = Observation()
    told = F.col("rejections")
    marked = source.select(F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("whole"), rejections(source, schema, required).alias("rejections"))
    marked = marked.withColumn("bad", F.size(told) > 0).observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.size(told) > 0).alias("bad"))
    both = stage(marked, partition_by="bad")
    n, bad = seen.get["n"], seen.get["bad"]
    if bad > most_rejected * n:
        raise TooManyRejected(f"{bad} of {n} rows rejected, at most the share {most_rejected} is allowed")
    good = tidy(both.where(~F.col("bad")).select("whole.*"), schema, codes, companions)
    rejected = both.where(F.col("bad")).select(F.col("whole").alias("row"), F.inline(told))
    return Checked(good if columns is None else good.select(*columns), rejected, n, bad)
