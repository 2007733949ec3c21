"""The refresh jobs: land the sources, run a plan, publish the target.

Each source is copied once, in tidy form, to a shared staging folder (the plans read it several times), with the filter and the columns
its plan needs, so that the source evaluates the one and leaves out the rest. The dated roster history is kept between runs and
grows by the days that are new. Frames that several jobs or branches read are staged once a run. Each target is computed in full
and published as the next version of its folder (or of its catalog table); readers see the old one or the new one.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.plans.cohort import cohort_data, cohort_report
from rollbook.plans.enrollments import (CERTIFIED_STAGE, CERTIFIED_STATUSES, LANGUAGE_COLUMNS, ROSTER_COLUMNS,
                                        build_enrollments)
from rollbook.plans.profiles import (ENVIRONMENT_LABELS, ENVIRONMENT_SCREEN, PARENT_LABELS, PARENT_SCREEN, profile_sheets,
                                     school_environment, school_profiles)
from rollbook.plans.recent import COLUMNS, degree_granting, overall, recent_universe
from rollbook.plans.risk import CUTOFFS_2017, at_risk, cutoff_dates, overage_cutoffs
from rollbook.plans.sped import (AIDE, CURRENT, ELIGIBILITY, FULL_TIME, IEP, NEGATIVE_TYPES, SpedOptions, highest_levels,
                                 plan_504, sped_current, swd_sheet)
from rollbook.sources import HEADERS, TARGETS, land, load, with_headers
from rollbook.sources.landing import land_days
from rollbook.sources.stages import Stages
from rollbook.sources.tables import Conf
from rollbook.sources.versions import publish, publish_table


def _in(column: str, values: Sequence[str]) -> str:
    """SQL test of a source column as it is: codes compare without case and trailing blanks."""
    return f"upper(rtrim({column})) IN ({', '.join(repr(v.upper()) for v in values)})"


#: What the jobs leave in the source, as SQL that it can evaluate.
CERTIFIED = f"{_in('enrollment_status', CERTIFIED_STATUSES)} AND {_in('enrollment_stage', [CERTIFIED_STAGE])} AND trim(usi) <> ''"
WHERE: dict[str, str] = {
    "sped_events": f"{_in('inactive', ['0'])} AND {_in('eventtype', [ELIGIBILITY, IEP, *NEGATIVE_TYPES])}",
    "service_history": _in("inactive", ["0"]),
    "sped_schools": _in("inactive", ["0"]),
    "primary_disabilities": f"{_in('inactive', ['0'])} AND {_in('district_code', ['1'])}",
    "student_custom_data": f"name IN ('{AIDE}', '{FULL_TIME}')",
}
#: Schemas of all targets; those of the field sheets follow from their labels.
SCHEMAS: dict[str, str] = TARGETS | {
    f"profile_{screen}": ", ".join(["district string", "building string", *[f"`{name}` string" for name in labels]])
    for screen, labels in ((PARENT_SCREEN, PARENT_LABELS), (ENVIRONMENT_SCREEN, ENVIRONMENT_LABELS))}
CODE_COLUMNS = ["status_code", "stage_code"]
ROSTER_TAKEN = list(dict.fromkeys([*ROSTER_COLUMNS.values(), "race_ethnicity_desc", "custom1", *LANGUAGE_COLUMNS, *CODE_COLUMNS]))
HISTORY_TAKEN = [*COLUMNS.values(), "enrollment_status", "enrollment_stage", "logdate", *CODE_COLUMNS]
PLAN_TAKEN = ["usi", "enrollment_responsible_lea_id", "accommodation_504"]


@dataclass(frozen=True)
class Job:
    """Where sources come from, where they are staged, and where each target goes: its folder, or with ``tables`` its catalog
    table, whose versions lie in ``table_folder``. A target ``<name>_titled`` gets a copy with the titles that readers expect."""
    spark: SparkSession
    sources: Conf
    staging: str
    targets: Mapping[str, str]
    tables: bool = False
    table_folder: str | None = None

    run: str = field(default_factory=lambda: uuid.uuid4().hex)
    landed: dict[str, DataFrame] = field(default_factory=dict)
    stages: Stages = field(default_factory=Stages)

    def source(self, name: str, where: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """A source, landed once per run in a folder of its own, so that no other run's files are replaced."""
        where = WHERE.get(name) if where is None else where
        key = ":".join([name, where or "", ",".join(columns or ())])
        if key not in self.landed:
            self.landed[key] = land(self.spark, name, self.sources, f"{self.staging}/{self.run}/{len(self.landed)}", where, columns)
        return self.landed[key]

    def history(self, name: str = "roster_history") -> DataFrame:
        """A dated history, landed by day in a folder that stays: a run lands the days that are new or have changed."""
        key = f"{name} by day"
        if key not in self.landed:
            self.landed[key] = land_days(self.spark, name, self.sources, f"{self.staging}/history/{name}", where=CERTIFIED,
                                         columns=HISTORY_TAKEN).history
        return self.landed[key]

    def read_target(self, name: str) -> DataFrame:
        where = self.targets[name]
        return load(self.spark, name, {name: {"table": where} if self.tables else {"path": where, "format": "versions"}})

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._put(df, name, SCHEMAS[name])
        rows = self.read_target(name)
        if f"{name}_titled" in self.targets:
            self._put(with_headers(rows, HEADERS[name]), f"{name}_titled")
        return rows

    def _put(self, df: DataFrame, name: str, schema: str | None = None) -> None:
        if self.tables:
            base = self.table_folder or self.spark.conf.get("spark.sql.warehouse.dir")
            publish_table(df, self.targets[name], f"{base.rstrip('/')}/versions-of-{self.targets[name]}", schema)
        else:
            publish(df, self.targets[name], schema)

    def close(self) -> None:
        """Release what was staged for this run; returned targets stay readable."""
        self.stages.release()


def refresh_enrollments(job: Job, language: bool = True) -> DataFrame:
    roster = job.source("roster", CERTIFIED, ROSTER_TAKEN)
    rows = build_enrollments(roster, job.source("audit_records"), language, cut=lambda df: df)  # what is landed is as good as staged
    if not language:
        rows = rows.withColumns({c: F.lit(None).cast("string") for c in LANGUAGE_COLUMNS})
    return job.write(rows, "enrollments")


def refresh_special_education(job: Job, as_of: dt.datetime, options: SpedOptions = CURRENT) -> DataFrame:
    """Refresh the current special-education table, then the validation sheet, which is returned."""
    enrollments = job.read_target("enrollments")
    names = ["sped_students", "sped_events", "iep_amendments", "service_history", "service_types", "sped_schools",
             "school_category", "lea_directory", "student_race", "primary_disabilities", "student_custom_data",
             "environment_map", "unified_errors"]
    current = job.write(sped_current(enrollments, *[job.source(n) for n in names], as_of=as_of, options=options),
                        "sped_current")
    plans = plan_504(job.source("roster", "trim(usi) <> ''", PLAN_TAKEN)) if options.plan_504 else None
    sheet = swd_sheet(current, enrollments, highest_levels([job.source("level_history")]), plans, options)
    if plans is None:
        sheet = sheet.withColumn("accommodation_504", F.lit(None).cast("string"))
    return job.write(sheet, "swd_sheet")


def refresh_cohort(job: Job, school_year: str = "2017-18",
                   power_year: str = "2017-2018") -> DataFrame:
    """Refresh the cohort table and its reporting copy, which is returned."""
    names = ["student_records", "degree_schools", "lea_directory", "exit_enrollments", "exit_status",
             "workflow_status", "shift_leas"]
    cohort = job.write(cohort_data(*[job.source(n) for n in names], school_year=school_year,
                                   power_year=power_year), "cohort_data")
    return job.write(cohort_report(cohort), "cohort_report")


def recent_enrollments(job: Job, after: dt.date = dt.date(2017, 8, 1)) -> tuple[DataFrame, DataFrame]:
    """Most recent enrollment of cohort students, overall and at degree-granting schools (returned, not stored)."""
    universe = job.stages.once("recent_universe", lambda: recent_universe(job.history(), job.read_target("cohort_data"), after), after=after)
    return overall(universe), degree_granting(universe, job.source("degree_schools"))


def refresh_at_risk(job: Job, as_of: dt.datetime, derived: bool = False) -> DataFrame:
    """At-risk table, with the fixed cut-offs of 2017 or with those derived from the date table (then stored)."""
    cutoffs = CUTOFFS_2017
    if derived:
        dates = job.source("date_table")
        job.write(cutoff_dates(dates, as_of), "overage_dates")
        cutoffs = overage_cutoffs(dates, as_of)
    return job.write(at_risk(job.read_target("enrollments"), job.source("indicators"), as_of, cutoffs), "at_risk")


def refresh_profiles(job: Job) -> DataFrame:
    """Refresh both field sheets, the school profiles and the published school environment, which is returned."""
    sheets = profile_sheets(job.source("building_fields"), job.source("field_dictionary"))
    parent = job.write(sheets[PARENT_SCREEN], "profile_8003")
    job.write(sheets[ENVIRONMENT_SCREEN], "profile_8004")
    profiles = job.write(school_profiles(parent, job.source("profile_master")), "school_profiles")
    return job.write(school_environment(profiles), "school_environment")
