"""Special education: current events, service minutes, hours report, support level, validation sheet.

The event log and the service log are the large inputs. Each is reduced by one aggregate on its own key before it
meets anything else, so what is joined afterwards has one row per student and district.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import (as_date, as_moment, band, clamp_min, coded, dec, equals, fill_blank, fold, is_blank,
                                is_false, label, midnight, moment, not_blank, precedes, recode,
                                safe_div, text_us, to_scale, trunc_int, yes_no)
from rollbook.operators import (anti, delete_not_in, eav_columns, enrich, join_blank_safe, latest, max_level,
                                override, propagate_flag, tag)
from rollbook.operators.aggregates import from_36ths, minutes_36ths
from rollbook.sources.history import union_years, with_snapshot
from rollbook.sources.tables import stage, stage_bucketed

# Event types, service codes and bands of the special-education feed.
ELIGIBILITY, IEP = "1", "2"
NEGATIVE_TYPES = ("7", "54", "55", "110", "147")
OUTSIDE_CLASS, INSIDE_CLASS, AIDE_SERVICE = "86", "83", "584"
AIDE, FULL_TIME = "AideRequired", "LREFullTime"
LRE_BANDS = [(0, 20, "A: 0-20%"), (21, 60, "B: 21-60%"), (60, None, "C: 60+ %")]
LEVEL_BANDS = [("0", "8.00", "Level 1"), ("8.01", "16", "Level 2"), ("16.01", "24", "Level 3"),
               ("24", None, "Level 4")]
UDE_ERRORS = ("Special Education (SPED)", "Special Education (SPED) Anomaly")
NOT_SERVED = "Not Recv Services under IDEA"

EVENT_ORDER = ("eventdate", "datecreated", "id")
STUDENT = ("studentcode", "district_code")


@dataclass(frozen=True)
class SpedOptions:
    """Behaviour that differs between the versions of the refresh; the defaults are those of the newest one."""
    eligibility_events: bool = True   # fill in the current eligibility event
    include_expired: bool = False     # count services of IEPs that have ended
    eligible_only: bool = True        # keep only students eligible today
    final_lea_code: str = "1"         # code of the LEA '001' / '1' in the published table
    plan_504: bool = True             # add the 504-plan column to the sheet
    enrollment_join: str = "left"     # 'inner' drops sheet rows without an enrollment


FIRST = SpedOptions(eligibility_events=False, include_expired=True, eligible_only=False,
                    final_lea_code="001", plan_504=False)
WITH_504 = SpedOptions(eligibility_events=False, include_expired=True, eligible_only=False,
                       final_lea_code="001", enrollment_join="inner")
TRIAL = SpedOptions(include_expired=True)
CURRENT = SpedOptions()


# ---------------------------------------------------------------- events

def current_event(events: DataFrame, keys: Sequence[str], is_current: Column, order: Sequence[str],
                  exclude: tuple[DataFrame, dict[str, str]] | None = None) -> DataFrame:
    """Latest qualifying event per key, after removing the excluded ones (frame, {event column: its column})."""
    chosen = events.where(is_current)
    if exclude is not None:
        chosen = anti(chosen, *exclude)
    return latest(chosen, keys, order)


def sped_students(enrollments: DataFrame, students: DataFrame) -> DataFrame:
    """Enrolled students known to the special-education system, one row per student, LEA and school."""
    enrolled = enrollments.select(F.col("usi").alias("studentcode"),
                                  recode("lea_code", {"001": "1"}).alias("district_code"),
                                  "school_code").distinct()
    known = students.select(F.col("id").alias("studentid"), *STUDENT)
    return enrolled.join(known, list(STUDENT)).distinct()


def _event(*extra: str) -> Column:
    return F.struct(*EVENT_ORDER, "begindate", "enddate", *extra)


def event_summary(events: DataFrame, amendments: DataFrame) -> DataFrame:
    """Per student id and district, as structs: last IEP, eligibility and negative event, last unamended IEP.

    The first three come from one grouping of the log; a struct starts with its order columns, so the greatest
    struct is the last event.
    """
    log = events.where((F.col("inactive") == "0")
                       & F.col("eventtype").isin(ELIGIBILITY, IEP, *NEGATIVE_TYPES))

    def last(of_type: Column, *extra: str) -> Column:
        return F.max(F.when(of_type, _event(*extra)))
    keys = ["studentid", "district_code"]
    kind = F.col("eventtype")
    main = log.groupBy(*keys).agg(last(kind == IEP, "primary_disability").alias("iep"),
                                  last(kind == ELIGIBILITY).alias("elig"),
                                  last(kind.isin(*NEGATIVE_TYPES)).alias("neg"))
    amended = amendments.select("studentid", F.col("lea").alias("district_code"), F.col("eventid").alias("id"))
    dated = anti(log.where(kind == IEP), amended, [*keys, "id"]).groupBy(*keys).agg(F.max(_event()).alias("dated"))
    return main.join(dated, keys, "left")


def current_events(universe: DataFrame, summary: DataFrame) -> DataFrame:
    """Last events per student code and district; a student may have several ids there."""
    ids = universe.select(*STUDENT, "studentid").distinct()
    return (ids.join(summary, ["studentid", "district_code"]).groupBy(*STUDENT)
            .agg(*[F.max(c).alias(c) for c in ("iep", "elig", "neg", "dated")]))


def _follows(begin: str, event: str, begin_field: str = "eventdate") -> Column:
    return precedes([F.col(f"{begin}.{begin_field}"), F.col(f"{begin}.datecreated"), F.col(f"{begin}.id")],
                    [F.col(f"{event}.{f}") for f in EVENT_ORDER])


def cancel_events(current: DataFrame, options: SpedOptions = CURRENT) -> DataFrame:
    """Drop events that a later negative event cancels.

    An IEP is compared by event date and cancelled per student and district; an eligibility is compared by begin
    date and cancelled for the student in every district (its event date stays).
    """
    if not options.eligibility_events:
        current = current.withColumn("elig", F.when(F.lit(False), F.col("elig")))
    flagged = current.withColumn("lost_elig", _follows("elig", "neg", "begindate"))
    flagged = propagate_flag(flagged, ["studentcode"], {"lost_elig": F.col("lost_elig")})
    lost_iep, lost_dated = _follows("iep", "neg"), _follows("dated", "neg")

    def of(struct: str, field: str, lost: Column) -> Column:
        return F.when(~lost, F.col(f"{struct}.{field}"))
    lost_elig = F.col("lost_elig")
    return flagged.select(
        *STUDENT,
        of("iep", "id", lost_iep).alias("iep_id"),
        of("iep", "datecreated", lost_iep).alias("iep_created"),
        of("iep", "eventdate", lost_iep).alias("iep_event_date"),
        of("iep", "begindate", lost_iep).alias("iep_begin_date"),
        of("iep", "enddate", lost_iep).alias("iep_end_date"),
        of("iep", "primary_disability", lost_iep).alias("primary_disability"),
        of("elig", "id", lost_elig).alias("elig_id"),
        of("elig", "datecreated", lost_elig).alias("elig_created"),
        F.col("elig.eventdate").alias("elig_event_date"),
        of("elig", "begindate", lost_elig).alias("elig_begin_date"),
        of("elig", "enddate", lost_elig).alias("elig_end_date"),
        of("dated", "id", lost_dated).alias("dated_id"),
        of("dated", "datecreated", lost_dated).alias("dated_created"),
        of("dated", "eventdate", lost_dated).alias("dated_event_date"),
        of("dated", "begindate", lost_dated).alias("dated_begin_date"),
        of("dated", "enddate", lost_dated).alias("dated_end_date"))


# ---------------------------------------------------------------- universe and status

def sped_universe(students: DataFrame, cur: DataFrame, schools: DataFrame, categories: DataFrame,
                  leas: DataFrame) -> DataFrame:
    """Students with a current IEP or eligibility, with school and LEA attributes. Dates lose their time of day.

    A student's row appears once per school (and per listing, where a school is listed twice); LEA '001' and '1' are one code on
    both sides of the name lookup. The report's part of the school list comes along: units per day, and whether it has the school.
    """
    held = cur.where(F.col("iep_id").isNotNull() | F.col("elig_id").isNotNull())
    rows = students.join(held, list(STUDENT))
    units = label([(equals("units_per_day", "0"), F.lit("1"))], F.col("units_per_day"))
    active = schools.where(F.col("inactive") == "0").withColumn("_units", dec(units, 10, 2))
    names = leas.select(recode("lea_id", {"001": "1"}).alias("lea_id"), "lea_name").distinct()
    rows = enrich(rows, [
        (active, {"district_code": "district_code", "school_code": "schoolcode"},
         {"school_name": "name", "_category": "category", "units_per_day": "_units", "_at_school": F.lit(True)}),
        (categories, {"_category": "id"}, {"lea_type": "school_type", "school_type": "description"}),
        (names, {"district_code": "lea_id"}, {"lea_name": "lea_name"})])
    days = [c for c in cur.columns if c.endswith("_date")]
    rows = rows.withColumns({c: as_date(c) for c in days}).drop("_category")
    return tag(rows.withColumn("iep_disability", F.col("primary_disability")), stars_id=None, referral_date=None)


def eligibility_status(df: DataFrame, as_of: dt.datetime, out: str = "eligibility_status") -> DataFrame:
    """YES while the IEP runs, or while the eligibility runs and the IEP has ended; else NULL.

    Compared with the time of day: an IEP that ends today has ended once the day has begun.
    """
    now = moment(as_of)

    def running(kind: str) -> Column:
        return (as_moment(f"{kind}_event_date") <= now) & (as_moment(f"{kind}_end_date") >= now)
    return df.withColumn(out, label([(running("iep"), "YES"),
                                     (running("elig") & (as_moment("iep_end_date") < now), "YES")]))


# ---------------------------------------------------------------- service minutes

def service_minutes(services: DataFrame, types: DataFrame, iep: DataFrame, as_of: dt.datetime,
                    include_expired: bool = False) -> DataFrame:
    """Weekly minutes outside class, inside class and of the dedicated aide, per student and district.

    A running IEP counts services active today (start of day); with ``include_expired`` an ended IEP counts all of
    its services. The log is summed per student id, district and event before the IEP is joined.
    """
    today = midnight(as_of)
    place = label([(F.col("location") == OUTSIDE_CLASS, "outside"), (F.col("location") == INSIDE_CLASS, "inside")])
    in_class = (F.col("location").isin(OUTSIDE_CLASS, INSIDE_CLASS)
                & (is_blank("consultation") | equals("consultation", "0")) & is_false("extended_school_year"))
    aide = F.col("serviceid") == AIDE_SERVICE
    counted = types.where(is_blank("exclude_from_618")).groupBy("serviceid").agg(F.count(F.lit(1)).alias("types"))
    log = services.where((F.col("inactive") == "0") & (in_class | aide))
    active = (as_moment("begin_date") <= today) & (as_moment("end_date") >= today)
    if not include_expired:
        log = log.where(active)
    in_class = in_class & F.col("types").isNotNull()
    log = enrich(log, [(counted, ["serviceid"], {"types": "types"})]).where(in_class | aide)
    minutes = minutes_36ths()
    parts = {"outside": F.when(in_class & (place == "outside"), minutes * F.col("types").cast("decimal(6,0)")),
             "inside": F.when(in_class & (place == "inside"), minutes * F.col("types").cast("decimal(6,0)")),
             "aide": F.when(aide, minutes)}
    sums = [F.count_if(active).alias("active")] + [F.sum(F.when(active, p)).alias(f"{n}_active")
                                                   for n, p in parts.items()]
    if include_expired:
        sums += [F.sum(p).alias(f"{n}_all") for n, p in parts.items()]
    per_event = log.groupBy("studentid", "district_code", F.col("eventid").alias("iep_id")).agg(*sums)

    held = iep.select(*STUDENT, "studentid", "iep_id", "iep_end_date").distinct()
    joined = held.join(per_event, ["studentid", "district_code", "iep_id"])
    ends = as_moment("iep_end_date")
    running = (ends >= today) & (F.col("active") > 0)
    joined = joined.where(running | (ends < today) if include_expired else running)

    def chosen(part: str) -> Column:
        now = F.col(f"{part}_active")
        return F.when(ends < today, F.col(f"{part}_all")).otherwise(now) if include_expired else now
    return joined.groupBy(*STUDENT).agg(*[from_36ths(F.sum(chosen(p))).alias(f"{p}_minutes") for p in parts])


# ---------------------------------------------------------------- report

def lre_report(univ: DataFrame, race: DataFrame, disabilities: DataFrame, minutes: DataFrame,
               custom: DataFrame) -> DataFrame:
    """Hours, percentages and placement band. Students at a school missing from the school list drop out.

    Both attributes of the key/value table come by one join: the aide, and the environment that ``publish_sped`` maps.
    """
    named = disabilities.where((F.col("inactive") == "0") & (F.col("district_code") == "1"))
    rows = enrich(univ, [(minutes, list(STUDENT), {m: m for m in ("outside_minutes", "inside_minutes", "aide_minutes")})], colocated=True)
    rows = rows.where(F.col("_at_school")).drop("_at_school")
    rows = enrich(rows.withColumn("_disability", fold("iep_disability")), [
        (race, {"studentcode": "usi"}, {"race_code": "raceethnicity", "race_description": "race_fin"}),
        (named.withColumn("_id", fold("id")), {"_disability": "_id"},
         {"primary_disability_name": "name", "code_618": "code_618"})]).drop("_disability")
    rows = eav_columns(rows, custom, {"dedicated_aide": AIDE, "_env": FULL_TIME},
                       {"studentid": "studentid", "district_code": "district_code", "iep_id": "eventid"})
    return hours_columns(rows)


def hours_columns(rows: DataFrame) -> DataFrame:
    """Hours, percentages and placement band from outside, inside and aide minutes and units per day."""
    zero = F.lit(0).cast("decimal(18,6)")
    outside = F.coalesce(F.col("outside_minutes"), zero)
    inside = F.coalesce(F.col("inside_minutes"), zero)
    week = F.col("units_per_day") * F.lit(300)

    def hours(minutes: Column) -> Column:
        return to_scale(minutes / F.lit(60), 18, 2)

    def percent(share: Column, scale: int) -> Column:
        return F.round(to_scale(share * F.lit(100), 18, scale), 0)
    rows = rows.withColumns({
        "aide_total_minutes": to_scale(F.coalesce(F.col("aide_minutes"), zero), 18, 4),
        "aide_hours": hours(F.col("aide_minutes")),
        "school_hours_per_week": F.col("units_per_day") * F.lit(5),
        "total_minutes": to_scale(outside, 18, 4) + to_scale(inside, 18, 4),
        "outside_hours": hours(outside), "inside_hours": hours(inside), "total_hours": hours(outside + inside),
        "outside_percent": clamp_min(percent(safe_div(outside, week), 2)),
        "inside_percent": clamp_min(percent(safe_div(week - to_scale(outside, 18, 2), week), 2)),
        "lre": band(F.coalesce(percent(safe_div(F.col("outside_minutes"), week), 0), F.lit(0)), LRE_BANDS)})
    for name in ("outside_percent", "inside_percent"):
        rows = rows.withColumn(name, to_scale(name, 18, 0))
    rows = rows.withColumn("school_hours_per_week", to_scale("school_hours_per_week", 12, 2))
    return override(rows, equals("dedicated_aide", "no"), {"aide_total_minutes": 0, "aide_hours": None})


def sped_level(report: DataFrame) -> DataFrame:
    """Total hours with the aide, and the support level by bands of it."""
    hours = (F.coalesce("aide_hours", F.lit(0).cast("decimal(18,2)"))
             + F.coalesce("total_hours", F.lit(0).cast("decimal(18,2)")))
    return (report.withColumn("total_hours_with_aide", to_scale(hours, 18, 2))
            .withColumn("sped_level", band("total_hours_with_aide", [
                (dec(F.lit(low), 12, 2), None if high is None else dec(F.lit(high), 12, 2), name)
                for low, high, name in LEVEL_BANDS])))


# ---------------------------------------------------------------- publishing

def publish_sped(report: DataFrame, env_map: DataFrame, errors: DataFrame, leas: DataFrame,
                 as_of: dt.datetime, options: SpedOptions = CURRENT) -> DataFrame:
    """Child-count environment, error flag, removal of inactive LEAs, final codes and texts."""
    if options.eligible_only:
        report = report.where(equals("eligibility_status", "YES"))
    rows = enrich(report.withColumn("_env", fold("_env")), [
        (env_map.withColumn("_key", fold("seds_environment")), {"_env": "_key"},
         {"seds_environment": "childcount_environment"})]).drop("_env")
    rows = rows.withColumns({
        "user_updated_environment": F.lit(None).cast("int"),
        "user_updated_environment_date": F.lit(None).cast("int"),
        "child_count_environment": F.col("seds_environment"), "child_count_environment_source": F.lit("SEDS"),
        "flag": F.when(is_blank("eligibility_status"), NOT_SERVED).otherwise("")})
    excluded = (errors.where(coded(errors, "error_code", "error_type", UDE_ERRORS) & coded(errors, "exclusion_code", "cc_exclusion", ["yes"]))
                .select(*STUDENT).distinct())
    rows = join_blank_safe(rows, excluded, list(STUDENT), {"ude": F.lit("Yes")})
    valid = leas.where(F.col("valid_for_enrollment") == "1").select(recode("lea_id", {"001": "1"}).alias("lea_id"))
    rows = delete_not_in(rows, valid, "district_code", "lea_id")
    aide = fill_blank(yes_no("dedicated_aide", ["yes"], ["no"]), F.lit("NO"))
    rows = rows.withColumns({"dedicated_aide": aide,
                             "district_code": recode("district_code", {"1": options.final_lea_code,
                                                                       "001": options.final_lea_code})})
    return with_snapshot(rows, as_of)


def sped_current(enrollments: DataFrame, students: DataFrame, events: DataFrame, amendments: DataFrame,
                 services: DataFrame, service_types: DataFrame, schools: DataFrame, categories: DataFrame,
                 leas: DataFrame, race: DataFrame, disabilities: DataFrame, custom: DataFrame,
                 env_map: DataFrame, errors: DataFrame, as_of: dt.datetime,
                 options: SpedOptions = CURRENT, cut: Callable[[DataFrame], DataFrame] = stage,
                 deal: Callable[[DataFrame, Sequence[str]], DataFrame] = stage_bucketed) -> DataFrame:
    """The current special-education table. ``cut`` ends the lineage of the last events, which are grouped by
    student and joined back. ``deal`` ends that of the students and of the universe with its events, each of which feeds two branches,
    and leaves them dealt out by student and district: what groups by these or joins on them takes them as they lie."""
    universe = deal(sped_students(enrollments, students), STUDENT)
    current = cancel_events(cut(current_events(universe, event_summary(events, amendments))), options)
    univ = deal(eligibility_status(sped_universe(universe, current, schools, categories, leas), as_of), STUDENT)
    minutes = service_minutes(services, service_types, univ, as_of, options.include_expired)
    univ = univ.withColumn("iep_disability", fill_blank("iep_disability", "primary_disability"))
    report = sped_level(lre_report(univ, race, disabilities, minutes, custom))
    return publish_sped(report, env_map, errors, leas, as_of, options)


def highest_levels(extracts: Sequence[DataFrame]) -> DataFrame:
    """Highest level text a student ever had, over the yearly extracts."""
    years = union_years([e.where(not_blank("special_education_level")) for e in extracts],
                        ["usi", "special_education_level"])
    return max_level(years)


def plan_504(roster: DataFrame) -> DataFrame:
    """Greatest 504-plan flag per student and LEA, Y/N spelled out."""
    rows = (roster.where(not_blank("usi"))
            .groupBy("usi", trunc_int("enrollment_responsible_lea_id").alias("lea_code"))
            .agg(F.max(F.struct(fold("accommodation_504"), F.col("accommodation_504").alias("text")))["text"].alias("accommodation_504")))
    return rows.withColumn("accommodation_504", yes_no("accommodation_504"))


def swd_sheet(sped: DataFrame, enrollments: DataFrame, levels: DataFrame, plans: DataFrame | None = None,
              options: SpedOptions = CURRENT) -> DataFrame:
    """One row per student, LEA and enrolled name: IEP dates, disability, hours, levels, 504 plan."""
    rows = sped.select("studentcode", F.col("district_code").alias("lea_code"), "iep_begin_date", "iep_end_date",
                       "iep_created", "dated_id", "primary_disability_name", "total_hours_with_aide",
                       "sped_level", trunc_int("district_code").alias("_lea"))
    people = (enrollments.select("usi", trunc_int("lea_code").alias("_lea"), "first_name", "last_name",
                                 "dob").distinct())
    rows = enrich(rows, [(people, {"studentcode": "usi", "_lea": "_lea"},
                          {"first_name": "first_name", "last_name": "last_name", "date_of_birth": "dob"})],
                  how=options.enrollment_join)
    rows = enrich(rows, [(levels, {"studentcode": "usi"}, {"highest_swd_level": "max_sped_level"})])
    if options.plan_504 and plans is not None:
        rows = enrich(rows, [(plans, {"studentcode": "usi", "_lea": "lea_code"},
                              {"accommodation_504": "accommodation_504"})])
    columns = ["studentcode", "first_name", "last_name", "date_of_birth",
               text_us("iep_begin_date").alias("current_iep_start_date"),
               text_us("iep_end_date").alias("current_iep_end_date"),
               F.when(F.col("dated_id").isNull(), text_us("iep_created")).otherwise("null")
               .alias("current_iep_amendment_date"),
               F.col("primary_disability_name").alias("current_primary_disability"),
               F.col("total_hours_with_aide").alias("current_hours"),
               F.col("sped_level").alias("current_swd_level"), "highest_swd_level"]
    if "accommodation_504" in rows.columns:
        columns.append("accommodation_504")
    return rows.select(*columns, "lea_code").distinct()
