"""Versioned targets: complete versions in folders of their own, and one small pointer that says which is current.

A target is a folder. Each version is written in full to a new folder in it; then the pointer, a file of a few hundred bytes,
is replaced in one atomic step. So at every moment there is a target and it is complete: before the step the old version, after it the
new one. Readers resolve the pointer once and read that version's files, which nothing changes any more; they are deleted only
when ``keep`` newer versions have come. A run that fails on the way leaves the pointer as it was, and a folder that ``sweep`` finds.

One writer at a time: a writer that finds another version than the one it began with raises, and its version is dropped.
The pointer is replaced by the file system's own overwriting rename (HDFS, POSIX); an object store without one needs a table format.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTER = "_current"


class ConcurrentWrite(RuntimeError):
    """Another writer has published since this one began."""


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    schema: str  # Spark's JSON
    note: str = ""

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(StructType.fromJson(json.loads(self.schema))).parquet(self.folder)


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, name: str):
    """The file system of a path; a local one without its checksum files, which would be replaced a moment later."""
    files = _path(spark, name).getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getRawFileSystem() if files.getUri().getScheme() == "file" else files


def _write_text(spark: SparkSession, name: str, text: str) -> None:
    out = _files(spark, name).create(_path(spark, name), True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def _read_text(spark: SparkSession, name: str) -> str | None:
    files, place = _files(spark, name), _path(spark, name)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_file(spark: SparkSession, new: str, old: str) -> None:
    """Put a file in another's place in one step."""
    files = _files(spark, old)
    if files.getUri().getScheme() == "file":  # the system call replaces the file
        if not files.rename(_path(spark, new), _path(spark, old)):
            raise OSError(f"cannot put {new} in place of {old}")
        return
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, old).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(_path(spark, new), _path(spark, old), options)


def versions(spark: SparkSession, target: str) -> list[Version]:
    """The versions that the pointer lists, the current one first; none before the first is published."""
    target = target.rstrip("/")
    text = _read_text(spark, f"{target}/{POINTER}")
    return [] if text is None else [Version(v["number"], f"{target}/{v['folder']}", v["schema"], v["note"]) for v in json.loads(text)["versions"]]


def current(spark: SparkSession, target: str) -> Version:
    found = versions(spark, target)
    if not found:
        raise FileNotFoundError(f"{target} has no version yet")
    return found[0]


def read(spark: SparkSession, target: str, number: int | None = None) -> DataFrame:
    """The current version, or a kept one by its number."""
    if number is None:
        return current(spark, target).read(spark)
    for version in versions(spark, target):
        if version.number == number:
            return version.read(spark)
    raise FileNotFoundError(f"{target} no longer has, or never had, version {number}")


def conformed(df: DataFrame, schema: str | StructType | None) -> DataFrame:
    """Columns by name, cast to a target's schema."""
    if schema is None:
        return df
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])


def publish(df: DataFrame, target: str, schema: str | StructType | None = None, keep: int = 2,
            partition_by: Sequence[str] = (), note: str = "") -> Version:
    """Write ``df`` as the target's next version and make it current; ``keep`` versions stay, this one included. ``note`` is kept with it.

    ``df`` may read the target's own versions: nothing it reads is touched before the new version is current.
    """
    if keep < 2:
        raise ValueError("a reader of the version before needs its files: keep two at least")
    spark, target = df.sparkSession, target.rstrip("/")
    before = versions(spark, target)
    number = before[0].number + 1 if before else 1
    rows = conformed(df, schema)
    new = Version(number, f"{target}/v-{number:08d}-{uuid.uuid4().hex}", rows.schema.json(), note)
    writer = rows.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(new.folder)
    if versions(spark, target)[:1] != before[:1]:
        _files(spark, new.folder).delete(_path(spark, new.folder), True)
        raise ConcurrentWrite(f"{target} was published by another writer meanwhile")
    listed, gone = [new, *before][:keep], [new, *before][keep:]
    text = json.dumps({"versions": [{"number": v.number, "folder": v.folder.rpartition("/")[2], "schema": v.schema, "note": v.note} for v in listed]})
    draft = f"{target}/_next-{uuid.uuid4().hex}"
    _write_text(spark, draft, text)
    replace_file(spark, draft, f"{target}/{POINTER}")
    for version in gone:
        _files(spark, version.folder).delete(_path(spark, version.folder), True)
    return new


def sweep(spark: SparkSession, target: str) -> list[str]:
    """Delete what failed writers have left: folders and drafts that the pointer does not list. To be called while none writes."""
    target = target.rstrip("/")
    files, listed = _files(spark, target), {v.folder.rpartition("/")[2] for v in versions(spark, target)}
    found = [s.getPath().getName() for s in files.listStatus(_path(spark, target))]
    left = sorted(n for n in found if n.startswith(("v-", "_next-")) and n not in listed)
    for name in left:
        files.delete(_path(spark, f"{target}/{name}"), True)
    return left


def publish_table(df: DataFrame, table: str, folder: str, schema: str | StructType | None = None, keep: int = 2) -> Version:
    """Publish a catalog table: versions in ``folder``, and the table's location set to the current one.

    The catalog's change of location is the step that readers see. Queries that have resolved the table go on with the version they
    found. A run that fails between the two steps leaves the table at the version before; the next run sets it right.
    """
    spark = df.sparkSession
    version = publish(df, folder, schema, keep)
    name = ".".join(f"`{part}`" for part in table.split("."))
    if spark.catalog.tableExists(table):
        have = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
        want = [(f.name, f.dataType) for f in StructType.fromJson(json.loads(version.schema)).fields]
        if have == want:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{version.folder}'")
            return version
        spark.sql(f"DROP TABLE {name}")  # another schema: an external table's files stay
    spark.catalog.createTable(table, path=version.folder, source="parquet", schema=StructType.fromJson(json.loads(version.schema)))
    return version
