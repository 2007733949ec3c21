"""Landing by day, rejected rows, staged state, numbered rows, named stages."""
from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import values
from pyspark.sql import functions as F

from rollbook.operators.ordering import numbered
from rollbook.plans import recent
from rollbook.plans.enrollments import certified_roster
from rollbook.sources import Stages, since, snapshot
from rollbook.sources.landing import TooManyRejected, check, land_checked, land_days, record_of
from rollbook.sources.state import levels_with_state

DAYS = [dt.date(2017, 10, d) for d in (1, 2, 3, 5)]
ROSTER = "USI string, enrollment_status string, enrollment_stage string, enrollment_responsible_lea_id string, logdate timestamp_ntz"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def history(frame, tmp_path):
    """add(rows) appends to the source of a roster history; its conf and folder."""
    source = str(tmp_path / "source")

    def add(*rows, ddl=ROSTER):
        frame(ddl, rows).write.mode("append").parquet(source)
    return add, {"roster_history": {"path": source}}, str(tmp_path / "landed")


def at(day, hour=0):
    return dt.datetime.combine(day, dt.time(hour))


def test_a_second_run_lands_new_and_changed_days_only(spark, history):
    add, conf, folder = history
    add(*[(f"u{d.day} ", "Enrolled", "Stage 5", "001", at(d, 9)) for d in DAYS[:3]])
    first = land_days(spark, "roster_history", conf, folder)
    assert first.days == DAYS[:3] and not first.undated
    files = {os.path.join(d, f) for d, _, names in os.walk(f"{folder}/rows") for f in names if f.endswith(".parquet")}
    add(("u9", "Enrolled", "Stage 5", "1", at(DAYS[3])), ("late", "withdrawn ", "Stage 5", "1", at(DAYS[1], 23)))
    second = land_days(spark, "roster_history", conf, folder)
    assert second.days == [DAYS[1], DAYS[3]]
    assert values(second.history, "usi", "logday") == [("LATE", DAYS[1]), ("U1", DAYS[0]), ("U2", DAYS[1]), ("U3", DAYS[2]), ("U9", DAYS[3])]
    after = {os.path.join(d, f) for d, _, names in os.walk(f"{folder}/rows") for f in names}
    assert len([f for f in files if f in after]) == 2  # the files of the first and the third day are as they were
    third = land_days(spark, "roster_history", conf, folder)
    assert third.days == [] and third.history.count() == 5
    assert record_of(spark, folder) == {DAYS[0]: 1, DAYS[1]: 2, DAYS[2]: 1, DAYS[3]: 1}


def test_rows_without_a_day_and_text_dates(spark, history):
    add, conf, folder = history
    ddl = ROSTER.replace("timestamp_ntz", "string")
    add(("a", "Enrolled", "Stage 5", "1", "10/2/2017"), ("b", "Enrolled", "Stage 5", "1", "soon"), ("c", "Enrolled", "Stage 5", "1", None), ddl=ddl)
    landing = land_days(spark, "roster_history", conf, folder)
    assert (landing.days, landing.undated) == ([DAYS[1]], True)
    assert values(landing.history, "usi", "logday") == [("A", DAYS[1]), ("B", None), ("C", None)]
    add(("d", "Enrolled", "Stage 5", "1", ""), ddl=ddl)
    again = land_days(spark, "roster_history", conf, folder)
    assert (again.days, again.undated, again.history.count()) == ([], True, 4)
    assert values(since(again.history, "logdate", DAYS[0]), "usi") == [("A",)]


def test_an_unrecorded_day_is_not_read(spark, history, monkeypatch):
    """A run that fails before the record is published adds nothing to the history; the next one lands the day again."""
    add, conf, folder = history
    add(("a", "Enrolled", "Stage 5", "1", at(DAYS[0])))
    land_days(spark, "roster_history", conf, folder)
    add(("b", "Enrolled", "Stage 5", "1", at(DAYS[1])))
    from rollbook.sources import landing

    def stop(*_, **__):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as patched:
        patched.setattr(landing, "publish", stop)
        with pytest.raises(RuntimeError, match="lost"):
            land_days(spark, "roster_history", conf, folder)
    assert values(landing.recorded(spark, folder), "usi") == [("A",)]
    assert land_days(spark, "roster_history", conf, folder).days == [DAYS[1]]
    assert values(landing.recorded(spark, folder), "usi") == [("A",), ("B",)]


def test_filters_reach_partitions_and_the_scan(spark, history):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)  # else the plan's text is cut
    add, conf, folder = history
    add(*[(f"u{d.day}", "Enrolled ", "stage 5", "001", at(d)) for d in DAYS], ("x", "Pending", "Stage 5", "1", at(DAYS[0])))
    landed = land_days(spark, "roster_history", conf, folder, where="upper(rtrim(enrollment_status)) = 'ENROLLED'").history
    one = certified_roster(snapshot(landed, "logdate", DAYS[2]))
    assert values(one, "usi", "enrollment_status") == [("U3", "Enrolled ")]
    text = plan(one)
    assert "PartitionFilters" in text and f"(logday#" in text and "2017-10-03" in text.split("PartitionFilters")[1][:300]
    assert "In(status_code, [ENROLLED,WITHDRAWN])" in text and "EqualTo(stage_code,STAGE 5)" in text
    later = recent.recent_universe(landed, spark.createDataFrame([("U5",)], "usi string"), DAYS[1])
    assert values(later, "usi", "lea_code") == [("U5", "1")]
    assert "(logday#" in plan(later) and "In(status_code, [ENROLLED,WITHDRAWN])" in plan(later)


SCHEMA = "id bigint, born date, seen timestamp_ntz, name string"


def test_bad_rows_are_set_aside_with_their_reasons(frame):
    rows = [("1", "2017-10-02", "2017-10-02 08:00:00", "a"), ("x", "soon", "", "b"), ("99999999999999999999", "", "never", None), (" ", None, None, " "), ("7", "10/2/2017", None, "c")]
    found = check(frame("ID string, born string, seen string, name string, other string", rows), SCHEMA, codes=["name"], required=["name"])
    assert (found.n_rows, found.n_rejected) == (5, 3)
    assert values(found.good, "id", "born", "name") == [(1, dt.date(2017, 10, 2), "A"), (7, dt.date(2017, 10, 2), "C")]
    assert values(found.rejected.withColumn("first", F.col("row.ID")), "first", "column", "text", "reason") == [
        (" ", "name", " ", "missing"), ("99999999999999999999", "id", "99999999999999999999", "not an integer of this size"),
        ("99999999999999999999", "name", None, "missing"), ("99999999999999999999", "seen", "never", "not a moment"),
        ("x", "born", "soon", "not a date"), ("x", "id", "x", "not an integer of this size")]


def test_a_threshold_decides_on_failure(spark, frame, tmp_path):
    frame("id string, studentcode string", [("1", "a"), ("x", "b")]).write.parquet(str(tmp_path / "in"))
    conf = {"sped_students": {"path": str(tmp_path / "in")}}
    with pytest.raises(TooManyRejected, match="1 of 2"):
        land_checked(spark, "sped_students", conf, most_rejected=0.4)
    found = land_checked(spark, "sped_students", conf, where="studentcode <> 'c'", columns=["id"], most_rejected=0.5)
    assert values(found.good, "id") == [(1,)] and found.good.columns == ["id"] and found.n_rejected == 1
    empty = check(frame("id string", []), "id bigint, born date")
    assert (empty.n_rows, empty.n_rejected, empty.good.count(), empty.rejected.count()) == (0, 0, 0, 0)


LEVELS = "usi string, special_education_level string"


def test_state_of_closed_years(spark, frame, tmp_path):
    """The second run reads no closed extract; a changed one is read again, alone."""
    closed = {y: str(tmp_path / y) for y in ("2016", "2017")}
    frame(LEVELS, [("a", "Level 2"), ("b", "level 3 "), ("c", " ")]).write.parquet(closed["2016"])
    frame(LEVELS, [("a", "LEVEL 1"), ("d", "Level 4")]).write.parquet(closed["2017"])
    live = frame(LEVELS, [("b", "Level 1"), ("e", "Level 1"), ("c", None)])
    folder = str(tmp_path / "state")
    expected = [("a", "Level 2"), ("b", "level 3 "), ("d", "Level 4"), ("e", "Level 1")]
    first = levels_with_state(spark, closed, live, folder)
    assert values(first, "usi", "max_sped_level") == expected
    read = []

    def counted(path):
        read.append(path)
        return spark.read.parquet(path)
    from rollbook.sources import state
    real = state.closed_state

    def watched(*args):
        return real(*args, load=counted)
    state.closed_state = watched
    try:
        second = levels_with_state(spark, closed, live, folder)
        assert values(second, "usi", "max_sped_level") == expected and read == []
        assert not any(p in f for f in second.inputFiles() for p in closed.values())
        frame(LEVELS, [("d", "Level 9")]).write.mode("append").parquet(closed["2017"])
        third = levels_with_state(spark, closed, live, folder)
        assert values(third, "usi", "max_sped_level")[2] == ("d", "Level 9") and read == [closed["2017"]]
        fourth = levels_with_state(spark, {"2016": closed["2016"]}, live, folder)  # one extract has left
        assert [r[0] for r in values(fourth, "usi")] == ["a", "b", "e"] and read == [closed["2017"]]
    finally:
        state.closed_state = real
    assert values(levels_with_state(spark, {}, live, folder), "usi") == [("b",), ("e",)]


def test_numbered_rows(spark, frame):
    rows = [(i % 3 if i % 7 else None, f"s{i % 5}", i % 2) for i in range(500)] + [(1, "same", 1)] * 300
    df = frame("k int, s string, x int", rows)
    got = numbered(df, [F.col("k").desc(), "s"], partitions=6)
    ordered = sorted(((r["row_no"], r["k"], r["s"], r["x"]) for r in got.collect()))
    assert [r[0] for r in ordered] == list(range(1, 801))
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2])  # noqa: E731  (descending: NULLs last)
    assert [r[1:] for r in ordered] == sorted(rows, key=key)
    assert numbered(df.limit(0), ["k"]).collect() == []


def test_no_task_has_all_rows(spark):
    """A value that half of the rows have, and 1000 equal rows, are spread over the ranges."""
    df = spark.range(4000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("x"))
    got = numbered(df, ["k"], partitions=8)
    files = got.groupBy(F.expr("_metadata.file_path")).count() if "_metadata" in got.columns else None
    assert files is None
    parts = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in got.inputFiles() if "stage-" in f}).groupBy("_range").count().collect()
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 1500


def test_stages_are_written_once_and_released(frame):
    calls = []

    def build():
        calls.append(1)
        return frame("a int", [(1,)])
    with Stages() as stages:
        for day in (1, 1, 2):
            stages.once("rows", build, day=day)
        assert len(calls) == 2 and stages.cut("rows", day=1)(frame("b int", [])).columns == ["a"]
        folder = stages.once("rows", build, day=1)._staged
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and stages.held == {}
