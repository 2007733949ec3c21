"""No value is lost by its size, and texts compare without case."""
import datetime as dt
from decimal import Decimal

import pytest

from conftest import values
from rollbook.functions import as_date, as_moment, to_scale
from rollbook.operators import max_level, preferred
from rollbook.plans import enrollments as en
from rollbook.plans import sped as sp
from rollbook.sources import SOURCES, land, load, stage, tidy


def test_large_ids_land_whole(frame):
    rows = tidy(frame("id string, studentid string, eventdate string", [("3000000000", "4000000000", "2017-10-02")]), SOURCES["sped_events"])
    assert values(rows, "id", "studentid") == [(3_000_000_000, 4_000_000_000)]


@pytest.mark.parametrize("bad", ["99999999999999999999", "x1"])
def test_an_id_that_does_not_fit_raises(frame, bad):
    with pytest.raises(Exception, match="does not fit"):
        tidy(frame("id string", [(bad,)]), "id bigint").collect()
    assert values(tidy(frame("id string", [(" ",), (None,), ("7",)]), "id bigint"), "id") == [(None,), (None,), (7,)]


def test_many_minutes_are_kept(frame):
    rows = frame("units_per_day decimal(10,2), outside_minutes decimal(18,6), inside_minutes decimal(18,6), aide_minutes decimal(18,6), dedicated_aide string",
                 [(Decimal("6.5"), Decimal(2_500_000), Decimal(1), Decimal(2_500_000), "Yes")])
    got = sp.sped_level(sp.hours_columns(rows)).head()
    assert (got.total_minutes, got.aide_total_minutes) == (Decimal("2500001.0000"), Decimal("2500000.0000"))
    assert got.sped_level == "Level 4" and got.total_hours_with_aide == Decimal("83333.35")


def test_computed_overflow_raises(frame):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        frame("n decimal(38,0)", [(Decimal(10) ** 20,)]).select(to_scale("n", 18, 2)).collect()


def test_case_blind_order(frame):
    assert values(max_level(frame("usi string, special_education_level string", [("1", "level 2"), ("1", "Level 4"), ("1", "")])), "max_sped_level") == [("Level 4",)]
    plans = frame("usi string, enrollment_responsible_lea_id string, accommodation_504 string", [("1", "3000000000", "n"), ("1", "3000000000", "Y")])
    assert values(sp.plan_504(plans), "lea_code", "accommodation_504") == [(3_000_000_000, "YES")]
    assert values(preferred(frame("k int, t string", [(1, "b"), (1, "C"), (1, "c ")]), ["k"], ["t"]), "t") == [("C",), ("c ",)]
    day = frame("usi string, enrollment_responsible_lea_id string, new_to_us string, native_language_code string",
                [("1", "2", "y", "amh"), ("1", "2", "Y", "SPA"), ("1", "2", "", "")])
    assert values(en.language_duplicates(day), "native_language_code") == [("SPA",)]


def test_date_texts(frame):
    forms = ["2017-10-02", "10/2/2017", "10/02/2017 00:00:00", "20171002", "2017-10-02 00:00:00"]
    df = frame("c string", [(x,) for x in forms])
    assert values(df.select(as_date("c").alias("d")), "d") == [(dt.date(2017, 10, 2),)] * 5
    assert values(df.select(as_moment("c").alias("m")), "m") == [(dt.datetime(2017, 10, 2),)] * 5
    assert values(frame("c string", [("",), (" ",), (None,), ("soon",)]).select(as_date("c").alias("d")), "d") == [(None,)] * 4


def test_jdbc_needs_partitions(spark):
    with pytest.raises(ValueError, match="numPartitions"):
        load(spark, "x", {"x": {"format": "jdbc", "options": {"dbtable": "t"}}})


def test_landing_takes_a_filter_and_columns(spark, frame, tmp_path):
    frame("usi string, logdate string, enrollment_status string", [("a ", "2017-10-02", "Enrolled"), ("b", "2017-10-03", "Other")]).write.parquet(str(tmp_path / "in"))
    got = land(spark, "roster_history", {"roster_history": {"path": str(tmp_path / "in")}}, str(tmp_path / "stage"),
               where="enrollment_status = 'Enrolled'", columns=["usi", "logdate"], partition_by="logdate")
    assert values(got, "usi") == [("A",)] and set(got.columns) == {"usi", "logdate"}
    plan = got.where("usi = 'A'").select("usi")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(usi,A)" in plan and "ReadSchema: struct<usi:string>" in plan


def test_stage_is_parquet_with_pruned_columns(frame):
    cut = stage(frame("a int, b string", [(1, "x"), (2, "y")]))
    plan = cut.where("a > 1").select("b")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(a), GreaterThan(a,1)]" in plan and values(cut.where("a > 1"), "b") == [("y",)]
