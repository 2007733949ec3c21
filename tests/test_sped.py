import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import values
from rollbook.plans import sped as sp
from rollbook.sources import SOURCES

AS_OF = dt.datetime(2018, 3, 4, 12)
LONG = dt.datetime(2018, 12, 31)


def ts(day, hour=0):
    return dt.datetime.fromisoformat(day) + dt.timedelta(hours=hour)


@pytest.fixture(scope="module")
def feeds(named):
    def event(id, student, kind, day, created="2018-01-01", end=LONG, lea="101", inactive="0", begin=None, pd="3"):
        return dict(id=id, studentid=student, district_code=lea, eventtype=kind, eventdate=ts(day),
                    begindate=ts(begin or day), enddate=end, datecreated=ts(created), primary_disability=pd,
                    inactive=inactive)
    events = [
        event(1, 11, "2", "2017-09-01"), event(2, 11, "2", "2018-01-05"), event(3, 11, "2", "2018-02-05", inactive="1"),
        event(4, 11, "1", "2017-08-01"), event(5, 11, "7", "2017-12-01"),
        # the student's second id carries the last IEP; it is an amendment
        event(6, 12, "2", "2018-02-01", created="2018-02-02"),
        # cancelled: same day, same creation, greater id
        event(20, 21, "2", "2018-01-05"), event(21, 21, "54", "2018-01-05"), event(22, 21, "1", "2018-01-01"),
        # the eligibility is cancelled by its begin date, in the other district as well
        event(30, 31, "2", "2018-01-05"), event(31, 31, "1", "2017-12-01", begin="2017-11-01"),
        event(32, 31, "110", "2017-12-01"),
        event(33, 31, "1", "2018-02-01", lea="102"), event(34, 31, "2", "2018-02-02", lea="102"),
        # IEP ends on the as-of day
        event(40, 41, "2", "2018-01-05", end=ts("2018-03-04")), event(41, 41, "9", "2018-03-01"),
        # ended IEP, running eligibility
        event(50, 51, "2", "2017-01-05", end=ts("2018-01-31")), event(51, 51, "1", "2017-06-01"),
    ]

    def service(event, student, location="86", period="1", spent="60", serviceid="100", begin="2018-01-01",
                end="2018-12-31", lea="101", **more):
        return dict(eventid=event, studentid=student, district_code=lea, location=location, time_period=period,
                    time_spent=spent, time_units="1", num_sessions="", serviceid=serviceid, inactive="0",
                    begin_date=dt.date.fromisoformat(begin), end_date=dt.date.fromisoformat(end),
                    consultation=None, extended_school_year="False", **more)
    services = [
        service(6, 12), service(6, 12, location="83", period="2", spent="90"),
        service(6, 12, serviceid="584", location="99", spent="120"),
        service(6, 12, end="2018-03-03"), service(6, 12, serviceid="200"), service(6, 12, location="99"),
        {**service(6, 12), "consultation": "1"}, {**service(6, 12), "extended_school_year": "True"},
        {**service(6, 12), "inactive": "1"},
        service(30, 31, location="83", spent="300"), service(40, 41, spent="400"),
        service(50, 51, spent="50", begin="2016-01-01", end="2016-12-31"), service(34, 31, lea="102", spent="10")]
    people = [("S1", "101", "301"), ("S1", "101", "302"), ("S2", "101", "301"), ("S3", "101", "301"), ("S3", "102", "303"),
              ("S4", "101", "301"), ("S5", "101", "301"), ("S6", "101", "301")]
    enrollments = named("usi string, lea_code string, school_code string, first_name string, last_name string, dob date",
                        *[dict(usi=u, lea_code=lea, school_code=s, first_name="F" + u, last_name="L") for u, lea, s in people])
    students = named(SOURCES["sped_students"], *[
        dict(id=i, studentcode=c, district_code=d) for i, c, d in [
            (11, "S1", "101"), (12, "S1", "101"), (21, "S2", "101"), (31, "S3", "101"), (31, "S3", "102"),
            (41, "S4", "101"), (51, "S5", "101"), (61, "S6", "101"), (71, "S7", "101")]])
    return dict(
        enrollments=enrollments, students=students, events=named(SOURCES["sped_events"], *events),
        amendments=named(SOURCES["iep_amendments"], dict(studentid=12, lea="101", eventid=6)),
        services=named(SOURCES["service_history"], *services),
        service_types=named(SOURCES["service_types"], *[dict(serviceid=i, exclude_from_618=e) for i, e in [
            ("100", None), ("200", "1")]]),
        schools=named(SOURCES["sped_schools"], *[
            dict(schoolcode=s, district_code=d, name="School " + s, category=c, units_per_day=u, inactive="0")
            for s, d, c, u in [("301", "101", 1, "6.5"), ("302", "101", 9, "0"), ("303", "102", 1, None)]]),
        categories=named(SOURCES["school_category"], dict(id=1, school_type="Charter", description="Regular")),
        leas=named(SOURCES["lea_directory"], dict(lea_id="101", lea_name="One", valid_for_enrollment="1"),
                   dict(lea_id="102", lea_name="Two", valid_for_enrollment="0")),
        race=named(SOURCES["student_race"], dict(usi="S1", raceethnicity="5", race_fin="Asian")),
        disabilities=named(SOURCES["primary_disabilities"],
                           dict(id="3", name="Speech", code_618="SI", district_code="1", inactive="0"),
                           dict(id="3", name="Old", code_618="X", district_code="1", inactive="1")),
        custom=named(SOURCES["student_custom_data"],
                     dict(studentid=11, district_code="101", eventid=6, name="AideRequired", value="yes"),
                     dict(studentid=12, district_code="101", eventid=6, name="AideRequired", value="No "),
                     dict(studentid=12, district_code="101", eventid=6, name="LREFullTime", value="env a")),
        env_map=named(SOURCES["environment_map"], dict(seds_environment="Env A", childcount_environment="Count A")),
        errors=named(SOURCES["unified_errors"],
                     dict(studentcode="S1", district_code="101", error_type="Special Education (SPED)", cc_exclusion="Yes"),
                     dict(studentcode="S5", district_code=None, error_type="Special Education (SPED)", cc_exclusion="Yes")))


@pytest.fixture(scope="module")
def current(feeds):
    universe = sp.sped_students(feeds["enrollments"], feeds["students"])
    summary = sp.event_summary(feeds["events"], feeds["amendments"])
    return universe, sp.current_events(universe, summary)


def test_current_events_and_cancellation(current):
    universe, events = current
    got = sp.cancel_events(events)
    assert values(got, "studentcode", "district_code", "iep_id", "elig_id", "dated_id") == sorted([
        ("S1", "101", 6, None, 2),       # a later negative event than the eligibility begin, earlier than the IEP
        ("S2", "101", None, None, None), ("S3", "101", 30, None, 30), ("S3", "102", 34, None, 34),
        ("S4", "101", 40, None, 40), ("S5", "101", 50, 51, 50)], key=lambda r: tuple((v is not None, str(v)) for v in r))
    # a cancelled eligibility keeps its event date
    assert [r[0] for r in got.where("studentcode = 'S3' and district_code = '102'").select("elig_event_date").collect()] \
        == [ts("2018-02-01")]


def test_eligibility_events_are_optional(current):
    got = sp.cancel_events(current[1], sp.FIRST)
    assert got.where(F.col("elig_id").isNotNull() | F.col("elig_event_date").isNotNull()).count() == 0


def univ(feeds, current, as_of=AS_OF):
    events = sp.cancel_events(current[1])
    return sp.eligibility_status(sp.sped_universe(current[0], events, feeds["schools"], feeds["categories"],
                                                  feeds["leas"]), as_of)


def test_universe_and_status_use_the_time_of_day(feeds, current):
    got = univ(feeds, current)
    columns = ("studentid", "studentcode", "school_code", "lea_name", "lea_type", "eligibility_status")
    assert got.count() == 8
    assert set(values(got, *columns)) == {
        (11, "S1", "301", "One", "Charter", "YES"), (12, "S1", "301", "One", "Charter", "YES"),
        (11, "S1", "302", "One", None, "YES"), (12, "S1", "302", "One", None, "YES"),
        (31, "S3", "301", "One", "Charter", "YES"), (31, "S3", "303", "Two", "Charter", "YES"),
        (41, "S4", "301", "One", "Charter", None),   # ends today: over at noon
        (51, "S5", "301", "One", "Charter", "YES")}  # by eligibility
    assert {r.eligibility_status for r in got.where("studentcode = 'S4'").collect()} == {None}
    assert {r.eligibility_status for r in univ(feeds, current, dt.datetime(2018, 3, 4)).where("studentcode = 'S4'").collect()} \
        == {"YES"}


def test_service_minutes_current_and_expired(feeds, current):
    rows = univ(feeds, current)

    def got(expired):
        m = sp.service_minutes(feeds["services"], feeds["service_types"], rows, AS_OF, expired)
        return {(r.studentcode, r.district_code): (r.outside_minutes, r.inside_minutes, r.aide_minutes) for r in m.collect()}
    d = Decimal
    running = {("S1", "101"): (d("300.000000"), d("90.000000"), d("600.000000")),
               ("S3", "101"): (None, d("1500.000000"), None), ("S3", "102"): (d("50.000000"), None, None),
               ("S4", "101"): (d("2000.000000"), None, None)}  # services still run on the last day
    assert got(False) == running
    assert got(True) == {**running, ("S5", "101"): (d("250.000000"), None, None)}


def run(feeds, options=sp.CURRENT, **changes):
    return sp.sped_current(**{**feeds, **changes}, as_of=AS_OF, options=options)


def test_published_table(feeds):
    got = run(feeds)
    rows = {(r.studentcode, r.school_code, r.studentid): r for r in got.collect()}
    assert {k[:2] for k in rows} == {("S1", "301"), ("S1", "302"), ("S3", "301"), ("S5", "301")}  # LEA 102 is inactive
    r = rows[("S1", "301", 12)]
    # aide flag 'No ' clears the aide minutes and hours
    assert (r.aide_total_minutes, r.aide_hours, r.dedicated_aide) == (Decimal("0.0000"), None, "NO")
    assert (r.outside_hours, r.inside_hours, r.total_hours) == (Decimal("5.00"), Decimal("1.50"), Decimal("6.50"))
    assert (r.outside_percent, r.inside_percent, r.lre) == (15, 85, "A: 0-20%")  # 300 of 1950 minutes
    assert (r.sped_level, r.race_description, r.primary_disability_name) == ("Level 1", "Asian", "Speech")
    assert (r.seds_environment, r.ude, r.flag, r.snapshot_date) == ("Count A", "Yes", "", AS_OF)
    r = rows[("S1", "301", 11)]
    assert (r.aide_hours, r.total_hours_with_aide, r.sped_level, r.dedicated_aide) == (
        Decimal("10.00"), Decimal("16.50"), "Level 3", "YES")
    r = rows[("S1", "302", 12)]
    assert (r.school_hours_per_week, r.outside_percent, r.inside_percent, r.lre) == (Decimal("5.00"), 100, 0, "C: 60+ %")
    r = rows[("S5", "301", 51)]
    assert (r.dedicated_aide, r.ude, r.total_hours) == ("NO", None, Decimal("0.00"))


def test_missing_units_give_null_percent(feeds):
    valid = feeds["leas"].withColumn("valid_for_enrollment", F.lit("1"))
    r = run(feeds, leas=valid).where("district_code = '102'").collect()[0]
    assert (r.outside_percent, r.inside_percent, r.school_hours_per_week, r.lre) == (None, None, None, "A: 0-20%")


def test_a_null_in_the_lea_list_deletes_nothing(feeds, named):
    gap = feeds["leas"].unionByName(named(SOURCES["lea_directory"], dict(lea_name="?", valid_for_enrollment="1")))
    assert "102" in {r.district_code for r in run(feeds, leas=gap).collect()}


def test_first_version_keeps_everyone_and_the_long_code(feeds, named):
    got = run(feeds, sp.FIRST)
    by = {r.studentcode: r for r in got.collect()}
    assert by["S4"].flag == sp.NOT_SERVED and by["S5"].eligibility_status is None
    assert by["S5"].total_hours == Decimal("4.17")  # services of the ended IEP


def test_final_lea_code(feeds):
    def dcps(df, c):
        return df.withColumn(c, F.when(F.col(c) == "101", "1").otherwise(F.col(c)))
    swapped = {n: dcps(feeds[n], c) for n, c in [
        ("students", "district_code"), ("events", "district_code"), ("amendments", "lea"), ("services", "district_code"),
        ("schools", "district_code"), ("custom", "district_code"), ("leas", "lea_id")]}
    swapped["enrollments"] = feeds["enrollments"].withColumn(
        "lea_code", F.when(F.col("lea_code") == "101", "001").otherwise(F.col("lea_code")))
    assert {r.district_code for r in run(feeds, **swapped).collect()} == {"1"}
    assert "001" in {r.district_code for r in run(feeds, sp.SpedOptions(final_lea_code="001"), **swapped).collect()}
    assert {r.lea_name for r in run(feeds, **swapped).collect()} == {"One"}


def test_levels(frame):
    df = frame("aide_hours decimal(10,2), total_hours decimal(10,2)", [
        (None, None), (Decimal("0.01"), Decimal("8.00")), (None, Decimal("8.00")), (Decimal("8.00"), Decimal("8.00")),
        (None, Decimal("16.01")), (Decimal("24.01"), None)])
    assert [r.sped_level for r in sp.sped_level(df).collect()] == [
        "Level 1", "Level 2", "Level 1", "Level 2", "Level 3", "Level 4"]


def test_sheet(feeds, named, frame):
    current = run(feeds)
    levels = sp.highest_levels([
        named(SOURCES["level_history"], dict(usi="S1", special_education_level="Level 2")),
        named(SOURCES["level_history"], dict(usi="S1", special_education_level="Level 4"),
              dict(usi="S5", special_education_level=" "))])
    plans = sp.plan_504(named(SOURCES["roster"],
                              dict(usi="S1", enrollment_responsible_lea_id="0101", accommodation_504="N"),
                              dict(usi="S1", enrollment_responsible_lea_id="101", accommodation_504="Y"),
                              dict(usi=" ", enrollment_responsible_lea_id="101", accommodation_504="Y")))
    assert values(plans, "usi", "lea_code", "accommodation_504") == [("S1", 101, "YES")]
    sheet = sp.swd_sheet(current, feeds["enrollments"], levels, plans)
    rows = {(r.studentcode, r.current_hours): r for r in sheet.collect()}
    r = rows[("S1", Decimal("6.50"))]
    assert (r.current_iep_start_date, r.current_iep_end_date) == ("02/01/2018", "12/31/2018")
    assert r.current_iep_amendment_date == "null"  # another event gives the date
    assert (r.highest_swd_level, r.accommodation_504, r.first_name) == ("Level 4", "YES", "FS1")
    assert rows[("S5", Decimal("0.00"))].highest_swd_level is None
    gone = feeds["enrollments"].where("usi <> 'S5'")
    assert "S5" in {r.studentcode for r in sp.swd_sheet(current, gone, levels, plans).collect()}
    inner = sp.swd_sheet(current, gone, levels, plans, sp.WITH_504)
    assert "S5" not in {r.studentcode for r in inner.collect()}
    assert "accommodation_504" not in sp.swd_sheet(current, gone, levels, plans, sp.FIRST).columns
