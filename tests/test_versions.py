"""Versioned targets: what readers see, and what a run that fails leaves behind."""
from __future__ import annotations

import pytest
from conftest import values
from pyspark.sql import functions as F

from rollbook.sources import load, publish, publish_table, versions
from rollbook.sources.versions import ConcurrentWrite, current, read, replace_file, sweep


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "target")


def numbers(frame, *rows):
    return frame("n int, s string", rows)


def folders(spark, target):
    return {v.folder.rpartition("/")[2] for v in versions.versions(spark, target)}


def test_a_reader_keeps_its_version(spark, frame, target):
    publish(numbers(frame, (1, "a"), (2, "b")), target)
    reader = read(spark, target)
    publish(numbers(frame, (3, "c")), target, "s string, n bigint")
    assert values(reader, "n") == [(1,), (2,)]
    assert values(read(spark, target), "n") == [(3,)] and read(spark, target).dtypes == [("s", "string"), ("n", "bigint")]
    assert values(read(spark, target, 1), "n") == [(1,), (2,)]
    assert values(load(spark, "x", {"x": {"path": target, "format": "versions"}}), "s") == [("c",)]
    assert values(load(spark, "x", {"x": {"path": target, "format": "versions", "version": 1}}), "s") == [("a",), ("b",)]


def test_old_versions_go(spark, frame, target, tmp_path):
    for i in range(4):
        publish(numbers(frame, (i, "x")), target, keep=3)
    assert [v.number for v in versions.versions(spark, target)] == [4, 3, 2]
    assert {p.name for p in (tmp_path / "target").iterdir() if p.name.startswith("v-")} == folders(spark, target)
    with pytest.raises(FileNotFoundError):
        read(spark, target, 1)
    with pytest.raises(ValueError, match="two"):
        publish(numbers(frame, (9, "x")), target, keep=1)


def test_a_target_may_be_made_from_itself(spark, frame, target):
    publish(numbers(frame, (1, "a")), target)
    for _ in range(3):
        publish(read(spark, target).withColumn("n", F.col("n") + 1), target)
    assert values(read(spark, target), "n") == [(4,)]


def test_nothing_published_yet(spark, target):
    assert versions.versions(spark, target) == []
    with pytest.raises(FileNotFoundError):
        current(spark, target)


def test_empty_and_partitioned_versions(spark, frame, target):
    publish(numbers(frame), target)
    assert read(spark, target).count() == 0 and read(spark, target).columns == ["n", "s"]
    publish(numbers(frame, (1, "a"), (2, "b")), target, partition_by=["s"])
    plan = read(spark, target).where("s = 'b'")
    assert values(plan, "n") == [(2,)] and "PartitionFilters: [isnotnull(s" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("step", ["write", "draft", "pointer", "clean"])
def test_a_crash_between_steps_leaves_a_whole_target(spark, frame, target, monkeypatch, step):
    """The run ends in each step; the target is the old version before the pointer is replaced and the new one after it."""
    for i in (1, 2):
        publish(numbers(frame, (i, "old")), target)
    real_text, real_replace, real_files = versions._write_text, versions.replace_file, versions._files

    class Gone(Exception):
        pass

    def stop(*_):
        raise Gone

    rows = numbers(frame, (3, "new"))
    if step == "write":
        rows = rows.withColumn("n", F.raise_error(F.lit("executor failure")).cast("int"))
    elif step == "draft":
        monkeypatch.setattr(versions, "_write_text", stop)
    elif step == "pointer":
        monkeypatch.setattr(versions, "replace_file", stop)
    else:
        def replaced(*args):
            real_replace(*args)
            monkeypatch.setattr(versions, "_files", stop)
        monkeypatch.setattr(versions, "replace_file", replaced)
    with pytest.raises(Exception):  # noqa: B017
        publish(rows, target)
    for name, real in (("_write_text", real_text), ("replace_file", real_replace), ("_files", real_files)):
        monkeypatch.setattr(versions, name, real)
    assert values(read(spark, target), "n", "s") == ([(3, "new")] if step == "clean" else [(2, "old")])
    assert sweep(spark, target) or step == "write"
    assert sweep(spark, target) == []
    publish(numbers(frame, (4, "next")), target)
    assert values(read(spark, target), "n", "s") == [(4, "next")]
    assert values(read(spark, target, current(spark, target).number - 1), "s") == [("new",)] if step == "clean" else True


def test_a_writer_that_was_overtaken_raises(spark, frame, target, monkeypatch):
    publish(numbers(frame, (1, "a")), target)
    real = versions.conformed

    def overtaken(df, schema):
        monkeypatch.setattr(versions, "conformed", real)
        publish(numbers(frame, (2, "other")), target)
        return real(df, schema)
    monkeypatch.setattr(versions, "conformed", overtaken)
    with pytest.raises(ConcurrentWrite):
        publish(numbers(frame, (3, "late")), target)
    assert values(read(spark, target), "s") == [("other",)] and sweep(spark, target) == []


def test_pointer_is_replaced_by_other_file_systems_too(spark, tmp_path, monkeypatch):
    """Away from the local scheme the overwriting rename of Hadoop's FileContext does it."""
    new, old = str(tmp_path / "new"), str(tmp_path / "old")
    for name, text in ((new, "2"), (old, "1")):
        versions._write_text(spark, name, text)

    class Remote:
        def getUri(self):  # noqa: N802
            return self

        def getScheme(self):  # noqa: N802
            return "hdfs"
    real = versions._files
    monkeypatch.setattr(versions, "_files", lambda *_: Remote())
    replace_file(spark, new, old)
    monkeypatch.setattr(versions, "_files", real)
    assert versions._read_text(spark, old) == "2" and versions._read_text(spark, new) is None


def test_catalog_table_moves_to_the_new_version(spark, frame, tmp_path):
    folder = str(tmp_path / "versions")
    publish_table(numbers(frame, (1, "a")), "versioned_target", folder)
    try:
        reader = spark.table("versioned_target")
        assert values(reader, "n") == [(1,)]
        publish_table(spark.table("versioned_target").withColumn("n", F.col("n") + 10), "versioned_target", folder)
        assert values(spark.table("versioned_target"), "n") == [(11,)] and values(reader, "n") == [(1,)]
        publish_table(frame("only string", [("x",)]), "versioned_target", folder)
        assert spark.table("versioned_target").columns == ["only"]
    finally:
        spark.sql("DROP TABLE IF EXISTS versioned_target")
