"""Most recent enrollment of cohort students, overall and among a subset of schools."""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions import coded, order_date, recode
from rollbook.operators import conform, latest, semi
from rollbook.operators.joins import Keys
from rollbook.plans.enrollments import CERTIFIED_STAGE, CERTIFIED_STATUSES
from rollbook.sources.history import since
from rollbook.sources.stages import Cut
from rollbook.sources.tables import stage

# History column of each record column.
COLUMNS = {"usi": "usi", "lea_code": "enrollment_responsible_lea_id",
           "lea_name": "enrollment_responsible_lea_name", "school_code": "enrollment_attending_school_id",
           "stage5_date": "enrollment_stage5_date", "exit_date": "enrollment_exit_date",
           "exit_code": "enrollment_exit_code"}


def recent_universe(history: DataFrame, cohort: DataFrame, after: dt.date) -> DataFrame:
    """Distinct stage-5 enrollments of cohort students logged after a day; LEA '001' written as '1'."""
    rows = since(history, "logdate", after).where(coded(history, "status_code", "enrollment_status", CERTIFIED_STATUSES)
                                                  & coded(history, "stage_code", "enrollment_stage", [CERTIFIED_STAGE]))
    rows = conform(rows, COLUMNS).withColumn("lea_code", recode("lea_code", {"001": "1"})).distinct()
    return semi(rows, cohort, ["usi"])


def most_recent(df: DataFrame, keys: Sequence[str] = ("usi",),
                order: Sequence[str] = ("stage5_date", "exit_date"),
                subset: tuple[DataFrame, Keys] | None = None) -> DataFrame:
    """Latest rows per key, ties kept, equal rows once; ``subset`` = (frame, keys) keeps listed rows first."""
    if subset is not None:
        df = semi(df, *subset)
    return latest(df.distinct(), list(keys), [order_date(c) for c in order], ties=True)


def most_recent_enrollment(history: DataFrame, cohort: DataFrame, after: dt.date, cut: Cut = stage) -> DataFrame:
    """``cut`` ends the lineage of the universe, whose greatest dates are found and joined back."""
    return overall(cut(recent_universe(history, cohort, after)))


def most_recent_degree_granting(history: DataFrame, cohort: DataFrame, degree_schools: DataFrame,
                                after: dt.date, cut: Cut = stage) -> DataFrame:
    """As above among schools on the degree list, matched on school and LEA; without the LEA name."""
    return degree_granting(cut(recent_universe(history, cohort, after)), degree_schools)


def overall(universe: DataFrame) -> DataFrame:
    """Most recent enrollment of each student of a ``recent_universe``."""
    rows = most_recent(universe)
    return rows.select("usi", *[F.col(c).alias(f"most_recent_{c}") for c in rows.columns if c != "usi"])


def degree_granting(universe: DataFrame, degree_schools: DataFrame) -> DataFrame:
    rows = most_recent(universe.drop("lea_name"), subset=(degree_schools, {"school_code": "school_id", "lea_code": "lea_id"}))
    return rows.select("usi", *[F.col(c).alias(f"most_recent_degree_{c}") for c in rows.columns if c != "usi"])
