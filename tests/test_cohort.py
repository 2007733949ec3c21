import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import values
from rollbook.plans import cohort as co
from rollbook.plans import recent as rc
from rollbook.sources import SOURCES

D = dt.date


def record(usi, school="301", lea="101", grade="09", status="Enrolled", final=None, entry=D(2017, 9, 1), out=None,
           code=None, name="High"):
    return dict(usi=usi, lea_code=lea, lea_name=f"LEA {lea}", school_code=school, school_name=name,
                current_enrolled_grade=grade, first_name="F", last_name="L", enrollment_status=status,
                enrollment_status_final=final, stage5_entry_date=entry, stage5_exit_date=out, stage5_exit_code=code)


@pytest.fixture(scope="module")
def lists(named):
    return dict(
        degree_schools=named(SOURCES["degree_schools"],
                             dict(school_id="301", lea_id="101", degree_granting="Y"),
                             dict(school_id="302", lea_id="101", degree_granting="y "),
                             dict(school_id="860", lea_id="101", degree_granting="N", non_granting="Y"),
                             dict(school_id="400", lea_id="102", non_granting="Y")),
        leas=named(SOURCES["lea_directory"], dict(lea_id="5000", school_id="501"), dict(lea_id="101", school_id="301")),
        exit_status=named(SOURCES["exit_status"], *[dict(exitstatusid=i, display_status=s) for i, s in [
            (1, "Pending Approval"), (2, "OSSE Accepted Exits"), (3, "OSSE NOt Accepted Exits"), (4, "A first")]]),
        workflow=named(SOURCES["workflow_status"], dict(statusid=1, status="open")),
        power_leas=named(SOURCES["shift_leas"], dict(lea_code="103", school_year="2017-2018"),
                         dict(lea_code="101", school_year="2016-2017")))


def test_most_recent_status_cascade(named, lists):
    rows = named(SOURCES["student_records"],
                 record("A", "900", entry=D(2017, 9, 1)), record("A", "301", entry=D(2018, 1, 1), out=D(2018, 2, 1), code="2002"),
                 record("B", "301"), record("B", "302"), record("B", "900"),
                 record("C", "700"), record("C", "800"), record("C", "800", grade="10"),
                 record("D", "700", out=D(2018, 1, 1), code=" "), record("D", "301"))
    degree, _ = co.degree_lists(lists["degree_schools"])
    got = co.most_recent_status(rows, degree)
    assert values(got, "usi", "school_code", "current_status") == [
        ("A", "301", "Currently Completely Inactive"), ("B", "301", "Currently Active"), ("B", "302", "Currently Active"),
        ("C", "800", "Currently Active"), ("D", "700", "Currently Active")]


def test_blank_text_dates_sort_above_null(frame, lists):
    """As text, a blank exit date counts as 1900-01-01 in the order: below real dates, above NULL."""
    ddl = ("usi string, lea_code string, school_code string, stage5_entry_date string, stage5_exit_date string, "
           "stage5_exit_code string")
    df = frame(ddl, [("A", "1", "700", "9/1/2017", None, "1"), ("A", "1", "600", "2017-09-01", " ", "1"),
                     ("B", "1", "700", "9/1/2017", "", "1"), ("B", "1", "600", "9/1/2017", "1/5/2018", "1")])
    degree, _ = co.degree_lists(lists["degree_schools"])
    assert values(co.most_recent_status(df, degree), "usi", "school_code", "current_status") == [
        ("A", "600", "Currently Active"), ("B", "600", "Currently Completely Inactive")]


def test_current_school_only_for_rows_not_enrolled(named, frame):
    rows = named("usi string, enrollment_status string", dict(usi="A", enrollment_status="enrolled "),
                 dict(usi="A", enrollment_status="Withdrawn"), dict(usi="A", enrollment_status=""), dict(usi="A"))
    status = frame("usi string, lea_code string, school_code string, stage5_entry_date date, x string",
                   [("A", "1", "301", None, "p"), ("A", "1", "301", None, "q"), ("A", "1", "302", None, "p")])
    got = co.attach_current_school(rows, status)
    assert values(got, "enrollment_status", "current_school_code") == [
        (None, None), ("", "301"), ("", "302"), ("Withdrawn", "301"), ("Withdrawn", "302"), ("enrolled ", None)]


def test_universe_rules(named, lists):
    rows = named(SOURCES["student_records"], *[record(g or "none", "301" if i % 2 else "999", grade=g) for i, g in enumerate(
        ["09", "9", "C1", "c2", "AD", "AO", "P3", "08", None, "KG"])])
    degree, _ = co.degree_lists(lists["degree_schools"])
    got = co.cohort_universe(rows, degree, "current_enrolled_grade")
    assert {r.usi for r in got.collect()} == {"09", "9", "C1", "c2", "AO"}


def test_exits_shift_match_and_least_status(named, lists):
    rows = named(SOURCES["student_records"],
                 record("A", lea="103", out=D(2018, 1, 1), code="1940"), record("B", lea="101", out=D(2018, 1, 1), code="1940"),
                 record("C", lea="1", out=D(2018, 1, 1), code="1940"), record("D", lea="103"))

    def exit(usi, lea, day, status=2, year="2017-18"):
        return dict(usi=usi, leaid=lea, schoolid="301", enrollment_exit_code="1940", enrollment_exit_date=day,
                    exitstatusid=status, workflowid=1, school_year=year)
    exits = named(SOURCES["exit_enrollments"], exit("A", "103", D(2018, 1, 2)), exit("A", "103", D(2018, 1, 2), 4),
                  exit("B", "101", D(2018, 1, 1), 9), exit("C", "001", D(2018, 1, 2)), exit("D", "103", D(2018, 1, 2)),
                  exit("B", "101", D(2018, 1, 1), 1, "2016-17"))
    listed = lists["power_leas"].where("school_year = '2017-2018'").select("lea_code").unionByName(
        named("lea_code string", dict(lea_code="1")))
    got = co.apply_exits(rows, co.exit_records(exits, lists["exit_status"], lists["workflow"], "2017-18"), listed)
    assert values(got, "usi", "stage5_exit_date", "ex_mn_exit_date", "ex_mn_display_status") == [
        ("A", D(2018, 1, 2), "2018-01-02", "A first"), ("B", D(2018, 1, 1), "2018-01-01", None),
        ("C", D(2018, 1, 2), "2018-01-02", "OSSE Accepted Exits"), ("D", None, "", "")]


def test_exit_indicators_last_update_wins(frame):
    ddl = "n int, enrollment_status_final string, stage5_exit_date date, stage5_exit_code string, ex_mn_display_status string"
    out = D(2018, 1, 1)
    df = frame(ddl, [
        (1, " ", out, "1940", ""), (2, None, None, "1940", ""), (3, "", out, " ", ""), (4, "withdrawn", None, "", ""),
        (5, "Exited", out, "1940", "Still Pending"), (6, "Exited", out, "1940", "osse not accepted exits"),
        (7, "Exited", out, "", "OSSE Accepted Exits"), (8, "Exited", out, "1", "pending, OSSE Accepted"),
        (9, "Enrolled", out, "1940", "pending"), (10, "Other", out, "1940", "pending")])
    got = {r.n: (r.enrollment_indicator, r.exit_indicator) for r in co.exit_indicators(df).collect()}
    assert got == {1: ("Exited", "Complete"), 2: ("Enrolled", "NA"), 3: ("Enrolled", "NA"), 4: ("Exited", "Incomplete"),
                   5: ("Exited", "Incomplete"), 6: ("Exited", "Incomplete"), 7: ("Exited", "Complete"),
                   8: ("Exited", "Complete"), 9: ("Enrolled", "NA"), 10: ("Other", "")}


def test_flags(frame, named, lists):
    ddl = ("n int, school_code string, school_name string, stage5_exit_code string, current_school_code string, "
           "current_lea_code string, enrollment_indicator string, exit_indicator string")
    df = frame(ddl, [
        (1, "301", "x", "1940", None, None, "Exited", "Incomplete"),
        (2, "301", "x", "2002", "860", "101", "Exited", "complete"),
        (3, "301", "x", "2002", "400", "4002", "Exited", "Complete"),
        (4, "301", "x", "2002", "400", "102", "Exited", "Complete"),
        (5, "301", "x", "2040", "301", "101", "Exited", "Complete"),
        (6, "301", "x", "1999", "501", "101", "Exited", "Complete"),
        (7, "301", "x", "1999", None, None, "Exited", "Incomplete"),
        (8, "301", "x", None, None, None, "Exited", "Incomplete"),
        (9, "301", "x", None, None, None, "Exited", "Complete"),
        (10, "301", "x", "1944", None, None, "Exited", "Complete"),
        (11, "501", "non-public SCHOOL ", "", None, None, "Enrolled", "NA"),
        (12, "501", "Non-Public School", "2002", "400", "102", "Exited", "Complete"),
        (13, "501", "Non-Public School", "1944", None, None, "Exited", "Complete")])
    degree, non_degree = co.degree_lists(lists["degree_schools"])
    nonpublic = lists["leas"].where("lea_id = '5000'").select("school_id")
    got = co.responsibility_flags(df, degree, non_degree, nonpublic)
    names = [f for f, _, _ in co.DETAILS]
    on = {r.n: {f for f in names if r[f]} for r in got.collect()}
    assert on == {1: {"incomplete_exit"}, 2: {"to_state", "to_non_degree"}, 3: {"to_state", "to_non_degree"},
                  4: {"to_non_degree"}, 5: {"to_degree"}, 6: {"to_degree", "no_transfer"}, 7: {"no_transfer"},
                  8: {"no_transfer"}, 9: set(), 10: {"left_state"}, 11: {"enrolled", "idea"},
                  12: {"to_non_degree", "idea"}, 13: {"left_state"}}


def test_detail_order_and_indicator(frame):
    flags = [f for f, _, _ in co.DETAILS]
    ddl = "school_code string, school_name string, enrollment_indicator string, at_degree_school boolean, " + ", ".join(
        f"{f} boolean" for f in flags)

    def row(on, school="301", name="x", ind="Exited", degree=False):
        return (school, name, ind, degree, *[f in on for f in flags])
    df = frame(ddl, [row({"idea", "incomplete_exit"}), row({"incomplete_exit", "to_state"}), row({"to_state", "to_degree"}),
                     row({"to_degree", "to_non_degree"}), row({"to_non_degree", "no_transfer"}),
                     row({"no_transfer", "left_state"}), row({"idea", "enrolled"}, ind="Enrolled", degree=True),
                     row({"enrolled"}, ind="Enrolled"), row({"enrolled"}, ind="Enrolled", name="NON-public school"),
                     row({"enrolled"}, "947", ind="Enrolled"), row({"enrolled"}, "861", ind="enrolled"), row(set())])
    got = co.responsibility_indicator(co.responsibility_detail(df, flags, "d"), "d", "i")
    assert [(r.d, r.i) for r in got.collect()] == [
        ("Recently Enrolled, Incomplete Exit", "YES"), ("Transfer to State", "NO"), ("Transfer to Degree-Granting", "NO"),
        ("Transfer to NOn-Degree-Granting", "YES"), ("Recently Enrolled, NO Transfer", "YES"), ("Exited the State", "NO"),
        ("Currently Enrolled", "YES"), ("Currently Enrolled", ""), ("Currently Enrolled", "YES"),
        ("Transfer to NOn-Degree-Granting", "YES"), ("Transfer to State", "NO"), ("", "")]


def test_whole_cohort(named, lists):
    rows = named(SOURCES["student_records"],
                 record("A", "301"), record("A", "302", status="Withdrawn", entry=D(2016, 9, 1), out=D(2017, 5, 1), code="1999"),
                 record("B", "501", lea="5000"), record("B", "501", lea="5000"), record("P", grade="P3", school="999"),
                 record("E", "302", status="Withdrawn", out=D(2018, 1, 1), code="1941"),
                 record("N", "302", lea=None, status="Withdrawn", out=D(2018, 1, 1), code="1941"))
    exits = named(SOURCES["exit_enrollments"], dict(
        usi="E", leaid="101", schoolid="302", enrollment_exit_code="1941", enrollment_exit_date=D(2018, 1, 1),
        exitstatusid=1, school_year="2017-18"))
    got = co.cohort_data(rows, lists["degree_schools"], lists["leas"], exits, lists["exit_status"], lists["workflow"],
                         lists["power_leas"])
    assert values(got, "usi", "school_name", "lea_detail", "lea_indicator", "school_indicator") == [
        # two responsible rows, one of them current: the other is demoted
        ("A", "High", "Currently Enrolled", "YES", "YES"), ("A", "High", "Recently Enrolled, NO Transfer", "NO", "NO"),
        ("B", "Non-Public School", "Currently Enrolled", "YES", "YES"),
        ("E", "High", "Recently Enrolled, Incomplete Exit", "YES", "YES"),
        ("N", "High", "", "", "")]  # a NULL key matches nothing
    report = co.cohort_report(got)
    assert report.count() == 5 and "stage5_exit_date" not in report.columns


def test_recent_enrollment(named, lists):
    def logged(usi, school, entry, out=None, log=dt.datetime(2017, 9, 1), status="enrolled", lea="101"):
        return dict(usi=usi, enrollment_responsible_lea_id=lea, enrollment_attending_school_id=school, logdate=log,
                    enrollment_stage5_date=entry, enrollment_exit_date=out, enrollment_status=status,
                    enrollment_stage="Stage 5", enrollment_responsible_lea_name="L")
    history = named(SOURCES["roster_history"],
                    logged("A", "301", D(2017, 9, 1)), logged("A", "999", D(2017, 9, 1), D(2018, 1, 1)),
                    logged("A", "999", D(2017, 9, 1), D(2018, 1, 1), log=dt.datetime(2017, 10, 1)),
                    logged("A", "302", D(2018, 2, 1), log=dt.datetime(2017, 8, 1, 23)),
                    logged("A", "302", D(2018, 2, 1), status="Pending"), logged("Z", "301", D(2017, 9, 1)),
                    logged("B", "301", D(2017, 9, 1), lea="001"), logged("B", "302", D(2017, 9, 1), lea="001"))
    cohort = named("usi string", dict(usi="A"), dict(usi="A"), dict(usi="B"))
    after = D(2017, 8, 1)
    got = rc.most_recent_enrollment(history, cohort, after)
    assert values(got, "usi", "most_recent_school_code", "most_recent_lea_code") == [
        ("A", "999", "101"), ("B", "301", "1"), ("B", "302", "1")]
    got = rc.most_recent_degree_granting(history, cohort, lists["degree_schools"].where("degree_granting is not null"), after)
    assert values(got, "usi", "most_recent_degree_school_code") == [("A", "301")]
