"""At-risk indicator and overage cut-offs."""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions import any_flag, fold, is_blank, label, moment, one_of, yes_no, years_before
from rollbook.operators import distinct_of, enrich, overage, override
from rollbook.sources.history import with_snapshot

# Age limit per grade, the cut-offs of school year 2017-18, and the adult grades.
AGE_LIMITS = {"09": 15, "10": 16, "11": 17, "12": 18}
CUTOFFS_2017 = {"09": dt.date(2002, 9, 30), "10": dt.date(2001, 9, 30), "11": dt.date(2000, 9, 30),
                "12": dt.date(1999, 9, 30)}
ADULT_GRADES = ("AW", "AT", "AL", "ADULT", "AN", "AB", "AG")


def year_as_written(as_of: dt.datetime) -> int:
    """October to December give the next year, other months the previous one."""
    return as_of.year + 1 if as_of.month > 9 else as_of.year - 1


def year_of_last_cutoff(as_of: dt.datetime) -> int:
    """Year of the last 30 September before or on the day."""
    return as_of.year if (as_of.month, as_of.day) >= (9, 30) else as_of.year - 1


def cutoff_dates(dates: DataFrame, as_of: dt.datetime, date_col: str = "date") -> DataFrame:
    """Each 30 September of the date table from one year before ``as_of`` on, with the birth-date limit per grade."""
    day = F.to_date(date_col)
    since = moment(as_of) - F.make_ym_interval(F.lit(1), F.lit(0))
    kept = dates.where((F.month(day) == 9) & (F.dayofmonth(day) == 30)
                       & (day.cast("timestamp_ntz") >= since)).select(day.alias("date")).distinct()
    return kept.select("date", *[F.make_date(F.year(years_before("date", age)), F.lit(9), F.lit(30)).alias(f"g{int(g)}")
                                 for g, age in AGE_LIMITS.items()])


def overage_cutoffs(dates: DataFrame, as_of: dt.datetime,
                    year_rule: Callable[[dt.datetime], int] = year_as_written, date_col: str = "date") -> DataFrame:
    """(grade, cutoff) of the 30 September that ``year_rule`` selects: at most one row per grade."""
    row = cutoff_dates(dates, as_of, date_col).where(F.year("date") == year_rule(as_of))
    pairs = F.array(*[F.struct(F.lit(g).alias("grade"), F.col(f"g{int(g)}").alias("cutoff")) for g in AGE_LIMITS])
    return row.select(F.inline(pairs))


def at_risk(universe: DataFrame, indicators: DataFrame, as_of: dt.datetime,
            cutoffs: Mapping[str, dt.date] | DataFrame = CUTOFFS_2017) -> DataFrame:
    """At-risk flag from overage, three benefit flags and housing; adult grades are never at risk."""
    rows = distinct_of(universe, ["usi", "lea_code", "school_code", "grade", "dob"])
    rows = overage(rows, "grade", "dob", cutoffs, out="_over")
    rows = rows.withColumn("overage", F.when(F.col("_over"), "YES").otherwise(" ")).drop("_over")
    flags = ["tanf", "snap", "cfsa"]
    known = distinct_of(indicators, ["usi", *flags, "housing_status"])
    rows = enrich(rows, [(known, ["usi"], {c: c for c in [*flags, "housing_status"]})])
    rows = rows.withColumns({f: yes_no(f) for f in flags})
    rows = rows.withColumn("housing_status", label([(is_blank("housing_status"), " ")], "YES"))
    rows = rows.withColumn("at_risk", any_flag(["overage", *flags, "housing_status"]))
    rows = override(rows, one_of(fold("grade"), ADULT_GRADES), {"at_risk": "NO"})
    return with_snapshot(rows, as_of, "last_refreshed")
