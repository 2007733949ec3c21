"""Loading, landing, staging and refreshing whole tables."""
from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, StructType, TimestampNTZType, TimestampType

from rollbook.functions import as_date, as_moment, fold
from rollbook.sources import versions
from rollbook.sources.schemas import CODES, COMPANIONS, SOURCES

Conf = Mapping[str, Mapping[str, object]]


def load(spark: SparkSession, name: str, conf: Conf) -> DataFrame:
    """Read the logical source ``name``.

    Its entry in ``conf`` holds ``table`` (catalog), or ``path`` with an optional ``format`` (parquet by default; 'versions' is a
    versioned target, of which ``version`` may name a kept one), or ``format`` 'jdbc' with ``options``; these must hold partitionColumn, lowerBound, upperBound and numPartitions,
    as otherwise the whole table would come through one task.
    """
    entry = conf[name]
    if str(entry.get("format", "")).lower() == "jdbc":
        missing = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} - set(entry.get("options", {}))
        if missing:
            raise ValueError(f"{name}: a JDBC source needs {', '.join(sorted(missing))}")
    if "table" in entry:
        return spark.read.table(str(entry["table"]))
    if entry.get("format") == "versions":
        return versions.read(spark, str(entry["path"]), entry.get("version"))
    reader = spark.read.format(str(entry.get("format", "parquet"))).options(**entry.get("options", {}))
    return reader.load(entry["path"]) if "path" in entry else reader.load()


def tidy(df: DataFrame, schema: str | StructType, codes: Sequence[str] = (), companions: Mapping[str, str] | None = None) -> DataFrame:
    """Canonical names and types; code columns folded; ``companions`` (new column: text column) added, folded. Missing columns become NULL.

    A non-blank value that does not fit an integer column raises; ``landing.land_checked`` sets such rows aside instead."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    present = {c.lower(): c for c in df.columns}

    def cell(field):
        if field.name not in present:
            return F.lit(None).cast(field.dataType)
        source = F.col(f"`{present[field.name]}`")
        if isinstance(field.dataType, DateType):
            return as_date(source)
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return as_moment(source).cast(field.dataType)
        if field.name in codes and isinstance(field.dataType, StringType):
            return fold(source)
        value = source.try_cast(field.dataType)
        if isinstance(field.dataType, IntegralType):
            # a number that does not fit must not end as NULL and drop out of every join
            lost = value.isNull() & (F.trim(source.cast("string")) != "")
            return F.when(lost, F.raise_error(F.concat(F.lit(f"{field.name} does not fit {field.dataType.simpleString()}: "),
                                                       source.cast("string"))).cast(field.dataType)).otherwise(value)
        return value
    def folded(name):
        return fold(F.col(f"`{present[name]}`")) if name in present else F.lit(None).cast("string")
    return df.select(*[cell(f).alias(f.name) for f in schema.fields], *[folded(text).alias(new) for new, text in (companions or {}).items()])


def land(spark: SparkSession, name: str, conf: Conf, folder: str, where: str | Column | None = None,
         columns: Sequence[str] | None = None, partition_by: str | None = None) -> DataFrame:
    """Copy a source once into ``folder`` in tidy form, and read it back.

    ``where`` is applied to the source as it is, so that the source can evaluate it; ``columns`` limits what is copied.
    Later filters on code columns and companions are plain comparisons on stored columns and reach the Parquet scan.
    """
    path = f"{folder.rstrip('/')}/{name}"
    source = load(spark, name, conf)
    rows = tidy(source if where is None else source.where(where), SOURCES[name], CODES.get(name, ()), COMPANIONS.get(name))
    writer = (rows if columns is None else rows.select(*columns)).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it. Only where the session names none, as in
    tests on one machine, a new temporary folder is made and set."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="rollbook-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder name in the shared folder; what is written there goes when the driver ends."""
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stage(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write a frame that feeds several branches to the shared folder and read it back: computed once, lineage cut.

    Parquet keeps columns and footer statistics, so each branch reads the columns it needs. The files outlive lost
    executors; they are deleted when the driver ends, or earlier by ``release``.
    """
    spark = df.sparkSession
    path = scratch(spark, "stage")
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    frame = spark.read.schema(df.schema).parquet(path)
    frame._staged = path
    return frame


def stage_bucketed(df: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``stage``, bucketed and sorted by the keys: groupings by them (or by more columns), and joins on them with frames that are
    grouped or bucketed alike, need no exchange. The rows are dealt out by the keys once, when they are written.

    For keys without hot values, as a bucket is read by one task. ``buckets`` is ``spark.sql.shuffle.partitions`` by default, so
    that a shuffled side meets a bucketed one. The catalog holds the table only while the frame is resolved.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = scratch(spark, "stage"), f"stage_{uuid.uuid4().hex}"
    (df.repartition(n, *keys).write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(n, *keys).sortBy(*keys).saveAsTable(name))
    frame = spark.table(name)
    frame.schema  # resolved: the files and their buckets are known to the frame
    spark.sql(f"DROP TABLE `{name}`")  # a table with a path of its own: the files stay
    frame._staged = path
    return frame


def release(*frames: DataFrame) -> None:
    """Delete the files of staged frames that are read no more, and let the driver collect its garbage: the shuffle
    files of frames that nothing refers to any longer go with it."""
    for frame in frames:
        spark = frame.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(frame._staged)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    if frames:
        gc.collect()
        spark._jvm.System.gc()


def _replace(spark: SparkSession, new: str, target: str) -> None:
    """Put a finished folder in the target's place: the old one steps aside by a rename and is deleted last."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    old = path(f"{target}.old-{uuid.uuid4().hex}")
    had = files.exists(path(target))
    if had and not files.rename(path(target), old):
        raise OSError(f"cannot set {target} aside")
    if not files.rename(path(new), path(target)):
        if had:
            files.rename(old, path(target))
        raise OSError(f"cannot put {new} in place of {target}")
    if had:
        files.delete(old, True)


def refresh(df: DataFrame, target: str, schema: str | StructType | None = None, *, table: bool = False) -> None:
    """Replace a target in full, columns by name and cast to ``schema``.

    ``target`` is a path, or a catalog table with ``table=True``. A path's new version is written beside the old one and
    takes its place when it is complete, so a failed job leaves the target as it was. A catalog table is overwritten by Spark:
    take a table format with atomic overwrite, and stage a query that reads the target it replaces.
    """
    if schema is not None:
        fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
        df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
    if table:
        df.write.mode("overwrite").format("parquet").saveAsTable(target)
        return
    target = target.rstrip("/")
    new = f"{target}.new-{uuid.uuid4().hex}"
    df.write.parquet(new)
    _replace(df.sparkSession, new, target)
