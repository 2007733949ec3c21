import datetime as dt

from conftest import values
from rollbook.plans import enrollments as en
from rollbook.plans import profiles as pr
from rollbook.plans import refresh as rf
from rollbook.plans import risk as rk
from rollbook.sources import (SOURCES, load, refresh, since, snapshot, stage, tidy, union_years,
                              with_headers)

D = dt.date


def roster_row(usi, school="301", lea="101", **more):
    return {**dict(usi=usi, last_name="L", enrollment_responsible_lea_id=lea, enrollment_attending_school_id=school,
                   race_ethnicity_code="5", race_ethnicity_desc="White", enrollment_stage="Stage 5",
                   enrollment_status="Enrolled", lep_indicator="N"), **more}


def test_enrollments(named):
    roster = named(SOURCES["roster"], roster_row("1", lea="001"), roster_row("1", lea="1"), roster_row("2", custom1="Special"),
                   roster_row("3", enrollment_stage="Stage 4"), roster_row(" "), roster_row(None),
                   roster_row("4", enrollment_status="WITHDRAWN ", race_ethnicity_code="3"),
                   roster_row("5", enrollment_status="Pending"))
    audit = named(SOURCES["audit_records"],
                  dict(usi="1", lea_code="1", school_code="301"), dict(usi="1", lea_code="1", school_code="302", lep_indicator="1"),
                  dict(usi="7", lea_code="101", school_code="301", race_ethnicity="white ", lep_indicator="0"),
                  dict(usi="8", lea_code="101", school_code=None, race_ethnicity="Martian", lep_indicator=""),
                  dict(usi="8", lea_code="101", school_code=None, race_ethnicity="Martian", lep_indicator=""))
    got = en.build_enrollments(roster, audit)
    columns = ("usi", "lea_code", "school_code", "race_eth", "lep_indicator", "category")
    assert got.count() == 6
    assert set(values(got, *columns)) == {
        ("1", "1", "301", "5", "N", "RosterUncertifiedMaster"), ("1", "1", "302", None, "Y", "AuditnotRoster"),
        ("2", "101", "301", "5", "N", "Special"), ("4", "101", "301", "3", "N", "RosterUncertifiedMaster"),
        ("7", "101", "301", "3", "N", "AuditnotRoster"),  # 'white' has two codes: the least
        ("8", "101", None, "Martian", "", "AuditnotRoster")}
    short = en.build_enrollments(roster, audit, language=False)
    assert "lep_indicator" not in short.columns
    assert {r.category for r in short.collect()} == {"RosterUncertifiedMaster", "AuditnotRoster"}


def test_language_duplicates(named):
    day = named(SOURCES["roster_history"], *[
        dict(usi=u, enrollment_responsible_lea_id="1", new_to_us=n, native_language_code=lang, source_local_id=s)
        for u, n, lang, s in [("1", "Y", "spa", "a"), ("1", "N", "spa", "b"), ("1", "Y", "spa", "c"), ("2", "Y", "", "a"),
                              ("3", "", "", "a"), ("3", None, "amh", "a")]])
    assert values(en.language_duplicates(day), "usi", "new_to_us", "native_language_code") == [
        ("1", "Y", "spa"), ("3", None, "amh")]


def test_at_risk(named, frame):
    people = named("usi string, lea_code string, school_code string, grade string, dob date",
                   dict(usi="1", grade="09", dob=D(2002, 9, 30)), dict(usi="1", grade="09", dob=D(2002, 9, 30)),
                   dict(usi="2", grade="10", dob=D(2005, 1, 1)), dict(usi="3", grade="AW", dob=D(1980, 1, 1)),
                   dict(usi="4", grade="11"))
    flags = named(SOURCES["indicators"], dict(usi="2", tanf="y", snap="N", housing_status=" "), dict(usi="3", housing_status="x"),
                  dict(usi="2", tanf="N", snap="", cfsa=None))
    now = dt.datetime(2018, 3, 4, 12)
    got = rk.at_risk(people, flags, now)
    assert values(got, "usi", "overage", "tanf", "snap", "housing_status", "at_risk") == [
        ("1", "YES", None, None, " ", "YES"), ("2", " ", "NO", "", " ", "NO"), ("2", " ", "YES", "NO", " ", "YES"),
        ("3", " ", None, None, "YES", "NO"), ("4", " ", None, None, " ", "NO")]
    assert {r.last_refreshed for r in got.collect()} == {now}


def test_overage_cutoffs_by_year_rule(frame):
    days = frame("date date", [(D(2015, 1, 1) + dt.timedelta(days=i),) for i in range(365 * 5)])

    def chosen(as_of, rule=rk.year_as_written):
        return {r.grade: r.cutoff for r in rk.overage_cutoffs(days, as_of, rule).collect()}
    assert chosen(dt.datetime(2018, 3, 4, 12)) == {"09": D(2002, 9, 30), "10": D(2001, 9, 30), "11": D(2000, 9, 30),
                                                   "12": D(1999, 9, 30)}
    assert chosen(dt.datetime(2017, 11, 1))["09"] == D(2003, 9, 30)          # as written: the next year
    assert chosen(dt.datetime(2017, 11, 1), rk.year_of_last_cutoff)["09"] == D(2002, 9, 30)
    assert chosen(dt.datetime(2018, 9, 30, 12)) == {}                        # last year's noon is already too late
    assert chosen(dt.datetime(2018, 9, 30))["09"] == D(2002, 9, 30)
    assert rk.cutoff_dates(days, dt.datetime(2018, 3, 4)).count() == 3


def test_profiles(named):
    def field(building, number, value, screen="8003"):
        return dict(district="1", building=building, screen_number=screen, field_number=number, field_value=value)
    labels = {"1": "School Social Media Presence?", "2": "Twitter Link", "3": "FOR CHARTER SCHOOLS ONLY",
              "4": "Parent Representative POC?", "5": "POC First Name", "6": "POC Last Name", "7": "Parent Org - POC?",
              "8": "Unlisted"}
    dictionary = named(SOURCES["field_dictionary"], *[
        dict(district="1", screen_number="8003", field_number=n, field_label=text) for n, text in labels.items()])
    values_ = named(SOURCES["building_fields"], field("10", "1", "yes"), field("10", "2", "a" * 600), field("10", "2", "zz"),
                    field("10", "3", "1"), field("10", "4", "Y"), field("10", "5", "Ann"), field("10", "6", "Lee"),
                    field("20", "8", "x"), field("30", "1", "N"), field("30", "5", "Bo"), field("40", "1", "x", "8004"),
                    field("50", "1", "x", "1"))
    sheets = pr.profile_sheets(values_, dictionary)
    parent = sheets[pr.PARENT_SCREEN]
    assert {r.building for r in parent.collect()} == {"10", "20", "30"} and len(parent.columns) == 22
    assert len(sheets[pr.ENVIRONMENT_SCREEN].columns) == 23
    assert {r.feed_type for r in pr.labelled_fields(values_, dictionary).collect()} == {
        "Parent engagement", "School environment"}
    master = named(SOURCES["profile_master"], dict(school_code="10", after_care_available="x", care_is_free="p",
                                                   care_scale_or_voucher="Sliding scale"),
                   dict(school_code="30", care_is_free="p"), dict(school_code="141"))
    profiles = pr.school_profiles(parent, master)
    assert {r.school_code for r in profiles.collect()} == {"10", "30", "9000"}
    got = {r.school_code: r for r in pr.school_environment(profiles).collect()}
    ten, thirty, other = got["10"], got["30"], got["9000"]
    assert (ten.social_media, len(ten.twitter_link), ten.charter_first_name) == ("Y", 600, "AnnLee")
    assert (ten.poc_first_name, ten.parent_org_poc, ten.care_paid, ten.care_sliding, ten.care_voucher) == (
        None, "N", "p", "Y", "N")
    assert (thirty.social_media, thirty.twitter_link, thirty.charter_first_name, thirty.dcps_first_name) == ("N", "", "", None)
    assert (thirty.care_available, thirty.care_paid, other.lea_code, other.advisory_poc) == ("N", "", None, "N")


def test_history_reads(named, frame):
    df = frame("v int, logdate timestamp_ntz", [(1, dt.datetime(2017, 10, 2)), (2, dt.datetime(2017, 10, 2, 9)),
                                                (3, dt.datetime(2017, 10, 3)), (4, None)])
    day = D(2017, 10, 2)
    assert values(snapshot(df, "logdate", day), "v") == [(1,)]
    assert values(snapshot(df, "logdate", day, whole_day=True), "v") == [(1,), (2,)]
    assert values(since(df, "logdate", day), "v") == [(3,)]
    years = union_years([frame("a int, b int", [(1, 2)]), frame("b int, a int, c int", [(2, 1, 9), (3, 1, 9)])], ["a", "b"])
    assert values(years, "a", "b") == [(1, 2), (1, 3)]


def test_tidy_folds_codes_and_types(frame):
    df = frame("USI string, lea_code string, dob string, extra int", [("ab1 ", "c ", "9/30/2002", 1)])
    got = tidy(df, "usi string, lea_code string, dob date, missing int", ["usi"]).collect()[0]
    assert tuple(got) == ("AB1", "c ", D(2002, 9, 30), None)


def test_stage_cuts_the_lineage(frame):
    df = frame("a int", [(1,), (2,)]).where("a > 1")
    cut = stage(df)
    assert values(cut, "a") == [(2,)]
    assert "Filter" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_headers(frame):
    assert with_headers(frame("a int, b int", [(1, 2)]), {"a": "A Name"}).columns == ["A Name", "b"]


def test_refresh_of_a_table_and_a_path(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for rows in ([(1, "a"), (2, "b")], [(3, "c")]):
        refresh(frame("n int, s string", rows), path, "s string, n bigint")
    assert spark.read.parquet(path).dtypes == [("s", "string"), ("n", "bigint")]
    assert values(spark.read.parquet(path), "s") == [("c",)]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS refreshed LOCATION '{tmp_path}/db'")
    for rows in ([(1, "a"), (2, "b")], [(3, "c")]):
        refresh(frame("n int, s string", rows), "refreshed.target", table=True)
    assert values(load(spark, "x", {"x": {"table": "refreshed.target"}}), "n") == [(3,)]
    csv = str(tmp_path / "csv")
    frame("n int", [(7,)]).write.option("header", True).csv(csv)
    assert values(load(spark, "x", {"x": {"path": csv, "format": "csv", "options": {"header": True}}}), "n") == [("7",)]


def test_refresh_jobs(spark, named, tmp_path):
    """Every job from source folders to targets, run twice: a refresh replaces its target."""
    rows = {
        "roster": [roster_row("1"), roster_row("2", date_of_birth=D(2000, 1, 1), enrollment_grade_level_code="09")],
        "sped_students": [dict(id=1, studentcode="1 ", district_code="101")],
        "sped_events": [dict(id=5, studentid=1, district_code="101", eventtype="2", inactive="0",
                             eventdate=dt.datetime(2018, 1, 1), begindate=dt.datetime(2018, 1, 1),
                             enddate=dt.datetime(2018, 12, 31), datecreated=dt.datetime(2018, 1, 1))],
        "service_history": [dict(studentid=1, district_code="101", eventid=5, serviceid="9", location="86", inactive="0",
                                 time_spent="60", time_units="1", time_period="1", begin_date=D(2018, 1, 1),
                                 end_date=D(2018, 12, 31))],
        "service_types": [dict(serviceid="9")],
        "sped_schools": [dict(schoolcode="301", district_code="101", units_per_day="6", inactive="0")],
        "lea_directory": [dict(lea_id="101", lea_name="One", school_id="301", valid_for_enrollment="1")],
        "level_history": [dict(usi="1", special_education_level="Level 3")],
        "student_records": [dict(usi="1", lea_code="101", school_code="301", current_enrolled_grade="09",
                                 enrollment_status="Enrolled", stage5_entry_date=D(2017, 9, 1))],
        "degree_schools": [dict(school_id="301", lea_id="101", degree_granting="Y")],
        "roster_history": [dict(usi="1", enrollment_responsible_lea_id="101", enrollment_attending_school_id="301",
                                enrollment_status="Enrolled", enrollment_stage="Stage 5", logdate=dt.datetime(2017, 9, 1))],
        "date_table": [dict(date=D(2017, 9, 30))],
        "building_fields": [dict(district="1", building="10", screen_number="8003", field_number="1", field_value="x")],
        "profile_master": [dict(school_code="10")],
    }
    conf = {}
    for name, ddl in SOURCES.items():
        path = str(tmp_path / "in" / name)
        named(ddl, *rows.get(name, [])).write.parquet(path)
        conf[name] = {"path": path}
    targets = {n: str(tmp_path / "out" / n) for n in (
        "enrollments", "sped_current", "swd_sheet", "cohort_data", "cohort_report", "at_risk", "overage_dates",
        "profile_8003", "profile_8004", "school_profiles", "school_environment")}
    targets["swd_sheet_titled"] = str(tmp_path / "out" / "titled")
    job = rf.Job(spark, conf, str(tmp_path / "stage"), targets)
    now = dt.datetime(2018, 3, 4, 12)
    for _ in range(2):
        assert rf.refresh_enrollments(job).count() == 2
        assert values(rf.refresh_special_education(job, now), "studentcode", "current_swd_level", "highest_swd_level") == [
            ("1", "Level 1", "Level 3")]
        assert values(rf.refresh_cohort(job), "usi", "lea_detail", "lea_indicator") == [
            ("1", "Currently Enrolled", "YES")]
    overall, degree = rf.recent_enrollments(job)
    assert (overall.count(), degree.count()) == (1, 1)
    assert values(rf.refresh_at_risk(job, now), "usi", "at_risk") == [("1", "NO"), ("2", "YES")]
    assert values(rf.refresh_at_risk(job, now, derived=True), "usi", "at_risk") == [("1", "NO"), ("2", "YES")]
    assert values(rf.refresh_profiles(job), "school_code", "lea_code") == [("10", "1")]
    assert load(spark, "x", {"x": {"path": targets["swd_sheet_titled"], "format": "versions"}}).columns[:2] == ["Studentcode", "First Name"]
    assert set(job.landed["roster:" + rf.CERTIFIED + ":" + ",".join(rf.ROSTER_TAKEN)].columns) == set(rf.ROSTER_TAKEN)
    assert set(job.history().columns) == {*rf.HISTORY_TAKEN, "logday"} and list(job.stages.held) == [("recent_universe", ("after", dt.date(2017, 8, 1)))]
    job.close()
    tables = rf.Job(spark, conf, str(tmp_path / "stage"), {"at_risk": "job_at_risk", "enrollments": "job_enrollments"}, tables=True,
                    table_folder=str(tmp_path / "tables"))
    try:
        for _ in range(2):
            assert rf.refresh_enrollments(tables).count() == 2 and rf.refresh_at_risk(tables, now).count() == 2
    finally:
        for name in tables.targets.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    plan = job.source("sped_events").where("inactive = '0' and eventtype = '2'")
    assert "EqualTo(inactive,0)" in plan._jdf.queryExecution().executedPlan().toString()
