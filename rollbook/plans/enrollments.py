"""Enrollment universe: the certified roster, plus audit records it lacks."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import coded, col, equals, fold, is_blank, label, not_blank, recode
from rollbook.operators import anti, conform, dedupe_preferred, merge_sources, tag, update_from
from rollbook.sources.stages import Cut
from rollbook.sources.tables import stage

# Roster column of each target column, audit column of each target column.
ROSTER_COLUMNS: dict[str, str] = {
    "usi": "usi", "source_local_id": "source_local_id", "last_name": "last_name", "first_name": "first_name",
    "dob": "date_of_birth", "gender": "gender_code", "grade": "enrollment_grade_level_code",
    "race_eth": "race_ethnicity_code", "lea_code": "enrollment_responsible_lea_id",
    "lea_name": "enrollment_responsible_lea_name", "school_code": "enrollment_attending_school_id",
    "school_name": "enrollment_attending_school_name", "entry_date": "enrollment_stage5_date",
    "entry_code": "enrollment_entry_code", "exit_date": "enrollment_exit_date",
    "exit_code": "enrollment_exit_code", "enrollment_stage": "enrollment_stage",
    "enrollment_status": "enrollment_status"}
AUDIT_COLUMNS: dict[str, str] = {
    "usi": "usi", "source_local_id": "local_id", "last_name": "last_name", "first_name": "first_name",
    "dob": "date_of_birth", "gender": "gender", "grade": "enrollment_grade_level_indicator",
    "race_eth": "race_ethnicity", "lea_code": "lea_code", "lea_name": "lea_name", "school_code": "school_code",
    "school_name": "school_name", "entry_date": "enrollment_date", "entry_code": "enrollment_code",
    "exit_date": "exit_date", "exit_code": "exit_code"}
LANGUAGE_COLUMNS = ("lep_indicator", "new_to_us", "native_language_code")
# Categories of the two sources.
ROSTER_CATEGORY, AUDIT_CATEGORY = "RosterUncertifiedMaster", "AuditnotRoster"
# Statuses and stage of a certified enrollment.
CERTIFIED_STATUSES, CERTIFIED_STAGE = ("Enrolled", "Withdrawn"), "Stage 5"


def certified_roster(roster: DataFrame) -> DataFrame:
    """Enrolled or withdrawn stage-5 rows with a student id; LEA '001' written as '1'."""
    kept = roster.where(coded(roster, "status_code", "enrollment_status", CERTIFIED_STATUSES)
                        & coded(roster, "stage_code", "enrollment_stage", [CERTIFIED_STAGE]) & not_blank("usi"))
    return kept.withColumn("enrollment_responsible_lea_id",
                           recode("enrollment_responsible_lea_id", {"001": "1"}))


def build_enrollments(roster: DataFrame, audit: DataFrame, language: bool = True, cut: Cut = stage) -> DataFrame:
    """Roster rows UNION audit rows whose student, LEA and school the roster lacks.

    Audit race texts become codes by the roster's own code list (least code where a text has several). With
    ``language`` the later, wider form: LEP, new-to-US and native-language columns, and a non-blank ``custom1``
    as category. ``cut`` ends the lineage of the certified rows, which feed the union, the test for audit rows and the code list.
    """
    extra: dict[str, str | Column] = {c: c for c in LANGUAGE_COLUMNS} if language else {}
    wanted = dict.fromkeys([*ROSTER_COLUMNS.values(), "race_ethnicity_desc", *extra, *(["custom1"] if language else [])])
    certified = cut(certified_roster(roster).select(*wanted))
    custom = label([(not_blank("custom1"), col("custom1"))], ROSTER_CATEGORY)
    ours = conform(certified, {**ROSTER_COLUMNS, **extra,
                               "category": custom if language else F.lit(ROSTER_CATEGORY)})

    missing = anti(audit, certified, {"usi": "usi", "lea_code": "enrollment_responsible_lea_id",
                                      "school_code": "enrollment_attending_school_id"})
    lep = label([(equals("lep_indicator", "1"), "Y"), (equals("lep_indicator", "0"), "N")], "")
    theirs = conform(missing, {**AUDIT_COLUMNS, **({"lep_indicator": lep} if language else {})})
    theirs = update_from(theirs.withColumn("_race", fold("race_eth")),
                         certified.select(fold("race_ethnicity_desc").alias("_race"), "race_ethnicity_code"),
                         ["_race"], {"race_eth": "race_ethnicity_code"}).drop("_race")
    theirs = tag(theirs, enrollment_stage="Stage 5", enrollment_status="Enrolled", category=AUDIT_CATEGORY,
                 **({"new_to_us": "", "native_language_code": ""} if language else {}))
    return merge_sources(ours, theirs).select(*ours.columns)


def language_duplicates(history_day: DataFrame) -> DataFrame:
    """Duplicate (student, LEA) rows of one roster snapshot, resolved by new-to-US, then native language."""
    cols: Mapping[str, str] = {"usi": "usi", "lea_code": "enrollment_responsible_lea_id",
                               "new_to_us": "new_to_us", "native_language_code": "native_language_code"}
    rows = conform(history_day, cols).distinct()
    carries = equals("new_to_us", "Y") | ~is_blank("native_language_code")
    return dedupe_preferred(rows, ["usi", "lea_code"], carries, ["new_to_us", "native_language_code"])
