"""Graduation cohort: which LEA and school answer for a student.

The source's long chain of ordered updates becomes a few selects: match exits, derive the two indicators, set the
flags, spread them over their key groups, and read one ordered rule table for the detail text.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import (as_date, equals, is_blank, label, like_ci, none_of, not_blank, one_of,
                                order_date, recode, shift_days)
from rollbook.operators import (distinct_of, enrich, mark, propagate_flag, resolve_ties, single_responsible,
                                with_literal_row)
from rollbook.sources.tables import stage

# Grades, exit codes, schools and status texts the rules name.
HIGH_GRADES = ("09", "9", "10", "11", "12")
LOW_GRADES = ("P3", "PK3", "PK4", "KG", "P4", "01", "1", "02", "2", "03", "3", "04", "4", "05", "5", "06", "6",
              "07", "7", "08", "8")
OUT_OF_STATE = ("1940", "1941", "1942", "1943", "1944")
TRANSFER = ("2002", "2040", "2041", "2042", "2043")
STATE_SCHOOLS = ("860", "861", "480", "948", "958", "7000", "8100")
STATE_LEAS = ("4002",)
NON_PUBLIC_LEA, NON_PUBLIC_NAME = "5000", "Non-Public School"
ENROLLED_AT_NON_DEGREE, ENROLLED_AT_STATE = ("947",), ("861", "480")
EXIT_ACCEPTED, EXIT_REFUSED, EXIT_PENDING = "%OSSE Accepted%", "OSSE NOt Accepted Exits", "%pending%"
ACTIVE, INACTIVE = "Currently Active", "Currently Completely Inactive"

# Detail texts, strongest last, with the indicator each one implies (None: depends on the school).
DETAILS: list[tuple[str, str, str | None]] = [
    ("idea", "Responsible for IDEA Services", "YES"),
    ("incomplete_exit", "Recently Enrolled, Incomplete Exit", "YES"),
    ("to_state", "Transfer to State", "NO"),
    ("to_degree", "Transfer to Degree-Granting", "NO"),
    ("to_non_degree", "Transfer to NOn-Degree-Granting", "YES"),
    ("no_transfer", "Recently Enrolled, NO Transfer", "YES"),
    ("left_state", "Exited the State", "NO"),
    ("enrolled", "Currently Enrolled", None),
]
TEXT = {flag: text for flag, text, _ in DETAILS}
GROUP = ["usi", "lea_code", "school_code", "enrollment_indicator"]
EXIT_KEYS = ["stage5_exit_code", "stage5_exit_date"]


def degree_lists(degree_schools: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Degree-granting and non-granting (school_code, lea_code) lists."""
    def listed(flag: str) -> DataFrame:
        return (degree_schools.where(equals(flag, "Y"))
                .select(F.col("school_id").alias("school_code"), F.col("lea_id").alias("lea_code")))
    return listed("degree_granting"), listed("non_granting")


def most_recent_status(univ: DataFrame, degree: DataFrame) -> DataFrame:
    """Most recent enrollment per student with an active/inactive status.

    Ties on entry and exit date go to degree-granting schools (all of them), else to the greatest school code.
    """
    cols = ["usi", "lea_code", "school_code", "stage5_entry_date", "stage5_exit_date", "stage5_exit_code"]
    rows = distinct_of(univ, cols)
    rows = mark(rows, degree, ["school_code"], "_degree")
    kept = resolve_ties(rows, ["usi"], [order_date("stage5_entry_date"), order_date("stage5_exit_date")],
                        F.col("_degree"), ["school_code"]).drop("_degree").distinct()
    ended = not_blank("stage5_exit_date") & not_blank("stage5_exit_code")
    return kept.withColumn("current_status", F.when(ended, INACTIVE).otherwise(ACTIVE))


def attach_current_school(univ: DataFrame, status: DataFrame) -> DataFrame:
    """Add the most recent school, LEA and entry date to rows that are not 'Enrolled'.

    Distinct rows stay distinct: an enrolled row looks up nothing, and the lookup holds no two equal rows. The
    test is a join condition and not a nulled key, which would send all enrolled rows to one partition.
    """
    gone = none_of("enrollment_status", ["Enrolled"])
    cols = {"current_school_code": "school_code", "current_lea_code": "lea_code",
            "current_entry_date": "stage5_entry_date"}
    side = status.select(F.col("usi").alias("_usi"), *[F.col(c).alias(n) for n, c in cols.items()]).distinct()
    return univ.join(side, (F.col("usi") == F.col("_usi")) & gone, "left").drop("_usi")


def cohort_universe(univ: DataFrame, degree: DataFrame, grade: str = "grade", unique: bool = False) -> DataFrame:
    """Grades 9-12 and C*, or a degree-granting school (school and LEA) above grade 8. Equal rows once, which
    costs nothing where the input is known to be ``unique``."""
    rows = mark(univ, degree, ["school_code", "lea_code"], "_degree")
    high = one_of(grade, HIGH_GRADES) | like_ci(grade, "C%")
    rows = rows.where(high | (F.col("_degree") & none_of(grade, LOW_GRADES))).drop("_degree")
    return rows if unique else rows.distinct()


def exit_records(exits: DataFrame, exit_status: DataFrame, workflow: DataFrame, school_year: str) -> DataFrame:
    """Exit-management rows of one school year with their status texts; LEA '001' written as '1'."""
    rows = exits.where(F.col("school_year") == school_year).withColumn("leaid", recode("leaid", {"001": "1"}))
    return enrich(rows, [(exit_status, ["exitstatusid"], {"display_status": "display_status"}),
                         (workflow, {"workflowid": "statusid"}, {"status": "status"})])


def apply_exits(df: DataFrame, exits: DataFrame, shift_leas: DataFrame) -> DataFrame:
    """Move exit dates of listed LEAs on by one day, then attach the matching exit record.

    A record matches on student, LEA, school, exit code and exit day; of several the least status text wins.
    """
    rows = mark(df, shift_leas, ["lea_code"], "_shift")
    day = as_date("stage5_exit_date")
    rows = rows.withColumn("stage5_exit_date", F.when(F.col("_shift"), shift_days(day, 1)).otherwise(day))
    keys = {"usi": "usi", "lea_code": "leaid", "school_code": "schoolid",
            "stage5_exit_code": "enrollment_exit_code", "stage5_exit_date": "_day"}
    dated = exits.withColumn("_day", as_date("enrollment_exit_date"))
    found = dated.groupBy(*keys.values()).agg(F.min("display_status").alias("display_status"))
    rows = enrich(rows.drop("_shift"), [(found, keys, {
        "ex_mn_exit_code": "enrollment_exit_code", "ex_mn_exit_date": F.col("_day").cast("string"),
        "ex_mn_display_status": "display_status"})])
    matched = F.col("ex_mn_exit_date").isNotNull()
    return rows.withColumns({c: F.when(matched, F.col(c)).otherwise("") for c in (
        "ex_mn_exit_code", "ex_mn_exit_date", "ex_mn_display_status")})


def exit_indicators(df: DataFrame, status: str = "enrollment_status_final", exit_date: str = "stage5_exit_date",
                    exit_code: str = "stage5_exit_code", display: str = "ex_mn_display_status") -> DataFrame:
    """Enrollment indicator (Enrolled/Exited) and exit indicator (NA/Complete/Incomplete).

    An unset status is derived from the exit. Of the exit rules the strongest comes first here.
    """
    indicator = label([(is_blank(status) & not_blank(exit_date) & not_blank(exit_code), "Exited"),
                       (is_blank(status), "Enrolled"),
                       (equals(status, "Withdrawn"), "Exited")], F.col(status))
    df = df.withColumn("enrollment_indicator", indicator)
    exited = equals("enrollment_indicator", "Exited")
    return df.withColumn("exit_indicator", label([
        (exited & like_ci(display, EXIT_ACCEPTED), "Complete"),
        (exited & is_blank(exit_code), "Incomplete"),
        (exited & (like_ci(display, EXIT_PENDING) | equals(display, EXIT_REFUSED)), "Incomplete"),
        (exited, "Complete"),
        (equals("enrollment_indicator", "Enrolled"), "NA")], ""))


def responsibility_flags(df: DataFrame, degree: DataFrame, non_degree: DataFrame,
                         nonpublic: DataFrame) -> DataFrame:
    """Add the eight responsibility flags as booleans, and whether the row's own school grants degrees.

    The three school lists become one lookup, so each of the two school columns is joined once.
    """
    lists = {"degree": degree.select("school_code"), "non_degree": non_degree.select("school_code"),
             "nonpublic": nonpublic.select(F.col("school_id").alias("school_code"))}
    kinds = None
    for kind, schools in lists.items():
        part = schools.select("school_code", F.lit(kind).alias("kind"))
        kinds = part if kinds is None else kinds.unionByName(part)
    lookup = kinds.groupBy("school_code").agg(*[F.max(F.col("kind") == k).alias(k) for k in lists])
    # rows without a current school, as all enrolled ones, are dealt out by a hash: a NULL key would bring them together
    nowhere = F.concat(F.lit("none "), F.xxhash64(*df.columns).cast("string"))
    placed = df.withColumn("_current", F.coalesce("current_school_code", nowhere))
    rows = enrich(placed, [(lookup, ["school_code"], {"at_degree_school": "degree"}),
                           (lookup, {"_current": "school_code"}, {f"_{k}": k for k in lists})]).drop("_current")
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in (
        "at_degree_school", *[f"_{k}" for k in lists])})

    exited = equals("enrollment_indicator", "Exited")
    complete = exited & equals("exit_indicator", "Complete")
    incomplete = exited & equals("exit_indicator", "Incomplete")
    code = "stage5_exit_code"
    state = one_of("current_school_code", STATE_SCHOOLS) | one_of("current_lea_code", STATE_LEAS)
    flags = {
        "incomplete_exit": incomplete & one_of(code, OUT_OF_STATE),
        "to_state": complete & one_of(code, TRANSFER) & F.col("_non_degree") & state,
        "to_degree": complete & ((one_of(code, TRANSFER) & F.col("_degree")) | F.col("_nonpublic")),
        "to_non_degree": complete & one_of(code, TRANSFER) & F.col("_non_degree"),
        "no_transfer": ((incomplete & (none_of(code, OUT_OF_STATE) | is_blank(code)))
                        | (complete & none_of(code, TRANSFER + OUT_OF_STATE))),
        "left_state": complete & one_of(code, OUT_OF_STATE),
        "enrolled": equals("enrollment_indicator", "Enrolled")}
    rows = rows.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in flags.items()})
    idea = equals("school_name", NON_PUBLIC_NAME) & (
        F.col("enrolled") | F.col("no_transfer") | F.col("incomplete_exit") | F.col("to_non_degree"))
    return rows.withColumn("idea", idea).drop(*[f"_{k}" for k in lists])


def spread_flags(df: DataFrame) -> DataFrame:
    """OR each flag over its key group: the row's exit as well, or for two of them without it."""
    loose = ("idea", "enrolled")
    return propagate_flag(df, GROUP, {f: F.col(f) for f, _, _ in DETAILS if f not in loose}, blank_safe=EXIT_KEYS,
                          over_keys={f: F.col(f) for f in loose})


def responsibility_detail(df: DataFrame, flags: Sequence[str], out_col: str) -> DataFrame:
    """Detail text: the strongest flag wins, and two school rules for enrolled students come before all flags."""
    enrolled = equals("enrollment_indicator", "Enrolled")
    rules: list[tuple[Column, str]] = [
        (enrolled & F.coalesce(one_of("school_code", ENROLLED_AT_STATE), F.lit(False)), TEXT["to_state"]),
        (enrolled & F.coalesce(one_of("school_code", ENROLLED_AT_NON_DEGREE), F.lit(False)), TEXT["to_non_degree"])]
    rules += [(F.col(f), TEXT[f]) for f in reversed(flags)]
    return df.withColumn(out_col, label(rules, ""))


def responsibility_indicator(df: DataFrame, detail_col: str, out_col: str,
                             degree: str | Column = "at_degree_school") -> DataFrame:
    """YES or NO by detail text; a currently enrolled row counts at a degree-granting or non-public school."""
    degree = F.col(degree) if isinstance(degree, str) else degree
    here = equals(detail_col, TEXT["enrolled"]) & (degree | equals("school_name", NON_PUBLIC_NAME))
    rules = [(equals(detail_col, text), verdict) for _, text, verdict in DETAILS if verdict]
    return df.withColumn(out_col, label([*rules, (here, "YES")], ""))


RECORD_COLUMNS = ["usi", "lea_code", "lea_name", "school_code", "school_name", "grade", "first_name", "last_name",
                  "date_of_birth", "student_current_status", "enrollment_status", "enrollment_status_final",
                  "stage5_entry_date", "stage5_entry_code", "stage5_exit_code", "stage5_exit_date"]


def cohort_data(records: DataFrame, degree_schools: DataFrame, leas: DataFrame, exits: DataFrame,
                exit_status: DataFrame, workflow: DataFrame, power_leas: DataFrame, school_year: str = "2017-18",
                power_year: str = "2017-2018", cut: Callable[[DataFrame], DataFrame] = stage, distinct: bool = True) -> DataFrame:
    """The cohort table. ``distinct=False`` leaves equal rows in, which saves a shuffle of whole rows where the caller takes the distinct ones of
    some columns, or looks up keys. ``cut`` ends the lineage of the distinct records, which feed the tie rules and the table itself, of the
    flagged rows, which feed two groupings and their join back, and of the finished rows, which feed one more; without it each branch would run the whole chain again."""
    univ = cut(distinct_of(records.withColumnRenamed("current_enrolled_grade", "grade"), RECORD_COLUMNS))
    degree, non_degree = degree_lists(degree_schools)
    rows = attach_current_school(univ, most_recent_status(univ, degree))
    rows = cohort_universe(rows, degree, unique=True)
    nonpublic = distinct_of(leas.where(F.col("lea_id") == NON_PUBLIC_LEA), ["school_id"])
    rows = mark(rows, nonpublic, {"school_code": "school_id"}, "_nonpublic")
    rows = rows.withColumn("school_name", F.when(F.col("_nonpublic"), NON_PUBLIC_NAME)
                           .otherwise(F.col("school_name"))).drop("_nonpublic")
    shifted = with_literal_row(power_leas.where(F.col("school_year") == power_year).select("lea_code"), lea_code="1")
    rows = apply_exits(rows, exit_records(exits, exit_status, workflow, school_year), shifted)
    rows = cut(responsibility_flags(exit_indicators(rows), degree, non_degree, nonpublic))
    rows = spread_flags(rows)
    flags = [f for f, _, _ in DETAILS]
    for unit in ("lea", "school"):
        rows = responsibility_detail(rows, flags, f"{unit}_detail")
        rows = responsibility_indicator(rows, f"{unit}_detail", f"{unit}_indicator")
    rows = cut(rows.drop(*flags, "at_degree_school").withColumn("acgr_universe", F.lit("YES")))
    rows = single_responsible(rows, "usi", "lea_indicator", equals("lea_detail", TEXT["enrolled"]),
                              demote=["lea_indicator", "school_indicator"])
    return rows.distinct() if distinct else rows


def cohort_report(cohort: DataFrame) -> DataFrame:
    """Columns of the reporting copy, equal rows once."""
    return distinct_of(cohort, ["lea_name", "lea_code", "school_name", "school_code", "usi", "first_name",
                                "last_name", "date_of_birth", "acgr_universe", "enrollment_indicator",
                                "exit_indicator", "lea_indicator", "lea_detail", "school_indicator",
                                "school_detail"])
