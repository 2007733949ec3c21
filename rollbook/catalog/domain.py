"""Domain operators and whole plans on feeds derived from the given tables."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook import functions as fn
from rollbook import operators as op
from rollbook.catalog.feeds import FEEDS, with_feeds
from rollbook.catalog.registry import Tables, query
from rollbook.plans import cohort as co
from rollbook.plans import enrollments as en
from rollbook.plans import profiles as pr
from rollbook.plans import recent as rc
from rollbook.plans import risk as rk
from rollbook.plans import sped as sp
from rollbook.sources import stage

AS_OF = dt.datetime(2024, 1, 31, 12)


def feed(t: Tables, name: str) -> DataFrame:
    return t.sql(FEEDS[name])


# ---------------------------------------------------------------- current events

@query("W1,J8,J9,D3,D4", """
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events
               WHERE event_type = 'purchase'),
         e AS (SELECT user_id, max(ts) AS ts FROM events WHERE event_type = 'error' GROUP BY user_id)
    SELECT u.user_id, CASE WHEN e.ts > p.ts THEN NULL ELSE p.event_id END AS event_id,
           CASE WHEN e.ts > p.ts THEN NULL ELSE p.ts END AS ts, CASE WHEN e.ts > p.ts THEN NULL ELSE p.value END AS value
    FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN p ON p.user_id = u.user_id AND p.r = 1
    LEFT JOIN e ON e.user_id = u.user_id""")
def current_event_not_cancelled(t: Tables) -> DataFrame:
    log = t.events.select("user_id", "event_type", "event_id", "ts", "value")
    current = sp.current_event(log, ["user_id"], F.col("event_type") == "purchase", ["ts", "event_id"])
    taken = ("event_id", "ts", "value")
    rows = op.update_from(log.select("user_id").distinct(), current, ["user_id"], {c: c for c in taken})
    negative = log.where(F.col("event_type") == "error")
    return op.apply_negations(rows, negative, ["user_id"], [("ts", "ts"), ("event_id", "event_id")], taken)


@query("J7,D5,W1", """
    SELECT user_id, event_id, ts FROM
      (SELECT c.*, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events c
       WHERE event_type = 'click' AND NOT EXISTS
         (SELECT 1 FROM events v WHERE v.event_type = 'view' AND v.user_id = c.user_id
          AND CAST(v.ts AS DATE) = CAST(c.ts AS DATE))) x WHERE r = 1""")
def event_without_amendments(t: Tables) -> DataFrame:
    log = t.events.select("user_id", "event_type", "event_id", "ts", fn.as_date("ts").alias("day"))
    views = log.where(F.col("event_type") == "view").select("user_id", "day").distinct()
    last = sp.current_event(log, ["user_id"], F.col("event_type") == "click", ["ts", "event_id"],
                            exclude=(views, {"user_id": "user_id", "day": "day"}))
    return last.select("user_id", "event_id", "ts")


# ---------------------------------------------------------------- enrollment

_CERTIFIED = """,
    certified AS (
      SELECT *, CASE WHEN enrollment_responsible_lea_id = '001' THEN '1' ELSE enrollment_responsible_lea_id END AS lea
      FROM roster WHERE lower(rtrim(enrollment_status)) IN ('enrolled', 'withdrawn')
        AND lower(rtrim(enrollment_stage)) = 'stage 5' AND trim(coalesce(usi, '')) <> '')"""


@query("D1,S1,S2,P1,P2,P4,J4,J8,U1", with_feeds(["roster", "audit"], _CERTIFIED + """,
    race AS (SELECT lower(race_ethnicity_desc) AS text, min(race_ethnicity_code) AS code FROM certified GROUP BY 1)
    SELECT usi, source_local_id, last_name, first_name, date_of_birth AS dob, gender_code AS gender,
           enrollment_grade_level_code AS grade, race_ethnicity_code AS race_eth, lea AS lea_code,
           enrollment_responsible_lea_name AS lea_name, enrollment_attending_school_id AS school_code,
           enrollment_attending_school_name AS school_name, enrollment_stage5_date AS entry_date,
           enrollment_entry_code AS entry_code, enrollment_exit_date AS exit_date, enrollment_exit_code AS exit_code,
           enrollment_stage, enrollment_status, lep_indicator, new_to_us, native_language_code,
           CASE WHEN trim(coalesce(custom1, '')) = '' THEN 'RosterUncertifiedMaster' ELSE custom1 END AS category
    FROM certified
    UNION
    SELECT usi, local_id, last_name, first_name, date_of_birth, gender, enrollment_grade_level_indicator,
           coalesce(code, race_ethnicity), lea_code, lea_name, school_code, school_name, enrollment_date,
           enrollment_code, exit_date, exit_code, 'Stage 5', 'Enrolled',
           CASE lep_indicator WHEN '1' THEN 'Y' WHEN '0' THEN 'N' ELSE '' END, '', '', 'AuditnotRoster'
    FROM audit a LEFT JOIN race ON lower(race_ethnicity) = race.text
    WHERE NOT EXISTS (SELECT 1 FROM certified c WHERE c.usi = a.usi AND c.lea = a.lea_code
                      AND c.enrollment_attending_school_id = a.school_code)"""))
def enrollment_universe(t: Tables) -> DataFrame:
    return en.build_enrollments(feed(t, "roster"), feed(t, "audit"))


@query("D1", with_feeds(["roster", "audit"], _CERTIFIED + """,
    keys AS (SELECT DISTINCT usi, lea, enrollment_attending_school_id AS school FROM certified),
    spells AS (
      SELECT DISTINCT usi, source_local_id, enrollment_grade_level_code, lea, enrollment_attending_school_id,
             enrollment_stage5_date, enrollment_exit_date, enrollment_exit_code, enrollment_stage, enrollment_status,
             race_ethnicity_code FROM certified)
    SELECT 'RosterUncertifiedMaster' AS category, lea AS lea_code, CAST(count(*) AS BIGINT) AS n FROM spells GROUP BY lea
    UNION ALL
    SELECT 'AuditnotRoster', lea_code, CAST(count(*) AS BIGINT) FROM audit LEFT JOIN keys
      ON keys.usi = audit.usi AND lea = lea_code AND school = school_code WHERE lea IS NULL GROUP BY lea_code"""))
def enrollment_universe_short_form(t: Tables) -> DataFrame:
    rows = en.build_enrollments(feed(t, "roster"), feed(t, "audit"), language=False)
    return rows.groupBy("category", "lea_code").agg(F.count(F.lit(1)).alias("n"))


@query("D2,A2,W3", with_feeds(["roster"], """,
    day AS (SELECT DISTINCT usi, enrollment_responsible_lea_id AS lea_code, new_to_us, native_language_code FROM roster),
    many AS (SELECT usi, lea_code FROM day GROUP BY usi, lea_code HAVING count(*) > 1),
    wanted AS (SELECT day.* FROM day JOIN many USING (usi, lea_code)
               WHERE upper(trim(new_to_us)) = 'Y' OR trim(coalesce(native_language_code, '')) <> '')
    SELECT usi, lea_code, new_to_us, native_language_code FROM
      (SELECT *, rank() OVER (PARTITION BY usi, lea_code ORDER BY upper(rtrim(new_to_us)) DESC NULLS LAST,
                              upper(rtrim(native_language_code)) DESC NULLS LAST) AS r FROM wanted) x WHERE r = 1"""))
def language_duplicates(t: Tables) -> DataFrame:
    return en.language_duplicates(feed(t, "roster"))


# ---------------------------------------------------------------- special education

_SPED_FEEDS = ["sped_enrollments", "sped_students", "sped_events", "amendments"]
_LATER = "({a} < n.eventdate OR ({a} = n.eventdate AND (i.datecreated < n.datecreated OR " \
         "(i.datecreated = n.datecreated AND i.id < n.id))))"
_SPED_EVENTS = """,
    uni AS (SELECT DISTINCT s.id AS studentid, e.studentcode, e.district_code, e.school_code FROM
              (SELECT usi AS studentcode, CASE WHEN lea_code = '001' THEN '1' ELSE lea_code END AS district_code,
                      school_code FROM sped_enrollments) e
            JOIN sped_students s ON s.studentcode = e.studentcode AND s.district_code = e.district_code),
    log AS (SELECT DISTINCT u.studentcode, v.*, CASE WHEN eventtype IN ('1', '2') THEN eventtype ELSE 'n' END AS kind
            FROM sped_events v JOIN (SELECT DISTINCT studentcode, studentid, district_code FROM uni) u
              ON u.studentid = v.studentid AND u.district_code = v.district_code
            WHERE inactive = '0' AND eventtype IN ('1', '2', '7', '54', '55', '110', '147')),
    plain AS (SELECT log.* FROM log LEFT JOIN amendments a ON a.studentid = log.studentid
                AND a.lea = log.district_code AND a.eventid = log.id WHERE kind = '2' AND a.eventid IS NULL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY studentcode, district_code, kind
                 ORDER BY eventdate DESC, datecreated DESC, id DESC) AS r FROM
                 (SELECT * FROM log UNION ALL SELECT * REPLACE ('d' AS kind) FROM plain) x),
    n AS (SELECT * FROM ranked WHERE r = 1 AND kind = 'n'),
    iep AS (SELECT i.* FROM ranked i LEFT JOIN n USING (studentcode, district_code)
            WHERE i.r = 1 AND i.kind = '2' AND NOT coalesce(""" + _LATER.format(a="i.eventdate") + """, FALSE)),
    dated AS (SELECT i.* FROM ranked i LEFT JOIN n USING (studentcode, district_code)
            WHERE i.r = 1 AND i.kind = 'd' AND NOT coalesce(""" + _LATER.format(a="i.eventdate") + """, FALSE)),
    lost AS (SELECT DISTINCT i.studentcode FROM ranked i JOIN n USING (studentcode, district_code)
            WHERE i.r = 1 AND i.kind = '1' AND """ + _LATER.format(a="i.begindate") + """),
    elig AS (SELECT * FROM ranked WHERE r = 1 AND kind = '1'),
    cur AS (SELECT k.studentcode, k.district_code, iep.id AS iep_id, iep.eventdate AS iep_event,
                   iep.begindate AS iep_begin, iep.enddate AS iep_end, iep.datecreated AS iep_created,
                   iep.primary_disability AS pd, CASE WHEN lost.studentcode IS NULL THEN elig.id END AS elig_id,
                   elig.eventdate AS elig_event, CASE WHEN lost.studentcode IS NULL THEN elig.enddate END AS elig_end,
                   dated.id AS dated_id, dated.eventdate AS dated_event
            FROM (SELECT DISTINCT studentcode, district_code FROM log) k
            LEFT JOIN iep USING (studentcode, district_code) LEFT JOIN elig USING (studentcode, district_code)
            LEFT JOIN dated USING (studentcode, district_code) LEFT JOIN lost ON lost.studentcode = k.studentcode)"""


def _current(t: Tables) -> tuple[DataFrame, DataFrame]:
    universe = sp.sped_students(feed(t, "sped_enrollments"), feed(t, "sped_students"))
    summary = sp.event_summary(feed(t, "sped_events"), feed(t, "amendments"))
    return universe, sp.cancel_events(stage(sp.current_events(universe, summary)))


@query("D3,D4,D5,J7,W1,T8,T9", with_feeds(_SPED_FEEDS, _SPED_EVENTS + """
    SELECT studentcode, district_code, iep_id, iep_event AS iep_event_date, iep_end AS iep_end_date, iep_created,
           pd AS primary_disability, elig_id, elig_event AS elig_event_date, elig_end AS elig_end_date, dated_id,
           dated_event AS dated_event_date FROM cur"""))
def sped_current_events(t: Tables) -> DataFrame:
    _, current = _current(t)
    return current.select("studentcode", "district_code", "iep_id", "iep_event_date", "iep_end_date", "iep_created",
                          "primary_disability", "elig_id", "elig_event_date", "elig_end_date", "dated_id",
                          "dated_event_date")


_SPED_UNIVERSE = """,
    univ AS (SELECT u.studentid, u.school_code, cur.*, s.name AS school_name, c.school_type AS lea_type,
                    c.description AS school_type, l.lea_name,
                    CASE WHEN iep_event <= TIMESTAMP '2024-01-31 12:00:00' AND iep_end >= TIMESTAMP '2024-01-31 12:00:00'
                           OR elig_event <= TIMESTAMP '2024-01-31 12:00:00' AND elig_end >= TIMESTAMP '2024-01-31 12:00:00'
                              AND iep_end < TIMESTAMP '2024-01-31 12:00:00' THEN 'YES' END AS status
             FROM uni u JOIN cur ON cur.studentcode = u.studentcode AND cur.district_code = u.district_code
             LEFT JOIN sped_schools s ON s.district_code = u.district_code AND s.schoolcode = u.school_code
                  AND s.inactive = '0'
             LEFT JOIN categories c ON c.id = s.category
             LEFT JOIN (SELECT DISTINCT lea_id, lea_name FROM leas) l ON l.lea_id = u.district_code
             WHERE iep_id IS NOT NULL OR elig_id IS NOT NULL)"""


def _univ(t: Tables) -> DataFrame:
    universe, current = _current(t)
    univ = sp.sped_universe(universe, current, feed(t, "sped_schools"), feed(t, "categories"), feed(t, "leas"))
    return sp.eligibility_status(univ, AS_OF)


@query("D6,D7,J2,P12,T4", with_feeds([*_SPED_FEEDS, "sped_schools", "categories", "leas"],
                                     _SPED_EVENTS + _SPED_UNIVERSE + """
    SELECT studentid, studentcode, district_code, school_code, school_name, lea_type, school_type, lea_name, iep_id,
           elig_id, dated_id, strftime(iep_end, '%m/%d/%Y') AS iep_end_text, status AS eligibility_status FROM univ"""))
def sped_universe_status(t: Tables) -> DataFrame:
    return _univ(t).select("studentid", "studentcode", "district_code", "school_code", "school_name", "lea_type",
                           "school_type", "lea_name", "iep_id", "elig_id", "dated_id",
                           fn.text_us("iep_end_date").alias("iep_end_text"), "eligibility_status")


def _minutes_sql(expired: str) -> str:
    """Sums in 36ths of a hundredth minute (whole numbers); m_* are millionths of a minute."""
    class_rule = ("trim(coalesce(consultation, '')) IN ('', '0') AND lower(trim(coalesce(extended_school_year, ''))) "
                  "IN ('', '0', 'false') AND serviceid IN (SELECT serviceid FROM service_types "
                  "WHERE coalesce(exclude_from_618, '') = '')")
    return f""",
    w AS (SELECT s.*, CASE WHEN location IN ('86', '83') AND {class_rule} THEN location END AS place,
                 (SELECT count(*) FROM service_types y WHERE y.serviceid = s.serviceid
                  AND coalesce(exclude_from_618, '') = '') AS copies,
                 CASE WHEN trim(time_spent) = '' THEN 0 ELSE CAST(CAST(time_spent AS DECIMAL(10,2)) * 100 AS BIGINT) END
                 * CASE WHEN time_units = '1' THEN 1 ELSE 60 END
                 * CASE time_period WHEN '1' THEN 180 WHEN '2' THEN 36 WHEN '3' THEN 9 WHEN '6' THEN 1 END
                 * CASE WHEN trim(coalesce(num_sessions, '')) = '' THEN 1 ELSE CAST(num_sessions AS BIGINT) END AS v
          FROM services s WHERE inactive = '0'),
    picked AS (SELECT DISTINCT studentcode, district_code, studentid, iep_id, iep_end FROM univ),
    sums AS (SELECT p.studentcode, p.district_code,
                    CAST(sum(CASE WHEN place = '86' THEN v * copies END) AS HUGEINT) AS o36,
                    CAST(sum(CASE WHEN place = '83' THEN v * copies END) AS HUGEINT) AS i36,
                    CAST(sum(CASE WHEN w.serviceid = '584' THEN v END) AS HUGEINT) AS a36
             FROM picked p JOIN w ON w.studentid = p.studentid AND w.district_code = p.district_code
                  AND w.eventid = p.iep_id
             WHERE (iep_end >= DATE '2024-01-31' AND begin_date <= DATE '2024-01-31' AND end_date >= DATE '2024-01-31'
                    {expired}) AND (place IS NOT NULL OR w.serviceid = '584')
             GROUP BY p.studentcode, p.district_code),
    mins AS (SELECT studentcode, district_code, (o36 * 20000 + 36) // 72 AS m_o, (i36 * 20000 + 36) // 72 AS m_i,
                    (a36 * 20000 + 36) // 72 AS m_a FROM sums)"""


_MINUTE_FEEDS = [*_SPED_FEEDS, "sped_schools", "categories", "leas", "services", "service_types"]
_MINUTE_SELECT = """
    SELECT studentcode, district_code, CAST(CAST(m_o AS DECIMAL(24,0)) / 1000000 AS DECIMAL(18,6)) AS outside_minutes,
           CAST(CAST(m_i AS DECIMAL(24,0)) / 1000000 AS DECIMAL(18,6)) AS inside_minutes,
           CAST(CAST(m_a AS DECIMAL(24,0)) / 1000000 AS DECIMAL(18,6)) AS aide_minutes FROM mins"""


@query("D8,A1,P12,P20", with_feeds(_MINUTE_FEEDS, _SPED_EVENTS + _SPED_UNIVERSE + _minutes_sql("") + _MINUTE_SELECT))
def sped_service_minutes(t: Tables) -> DataFrame:
    return sp.service_minutes(feed(t, "services"), feed(t, "service_types"), _univ(t), AS_OF)


@query("D8,U3,P13", with_feeds(_MINUTE_FEEDS, _SPED_EVENTS + _SPED_UNIVERSE
                               + _minutes_sql("OR iep_end < DATE '2024-01-31'") + _MINUTE_SELECT))
def sped_service_minutes_with_expired(t: Tables) -> DataFrame:
    return sp.service_minutes(feed(t, "services"), feed(t, "service_types"), _univ(t), AS_OF, include_expired=True)


_REPORT_FEEDS = [*_MINUTE_FEEDS, "race", "disabilities", "custom", "env_map", "errors", "roster", "levels"]
_REPORT = """,
    sch AS (SELECT schoolcode, district_code, CAST(CASE WHEN units_per_day = '0' THEN '1' ELSE units_per_day END
                   AS DECIMAL(10,2)) AS units FROM sped_schools WHERE inactive = '0'),
    base AS (SELECT u.*, sch.units, CAST(sch.units * 100 * 300 AS BIGINT) AS w, m_o, m_i, coalesce(m_o, 0) AS o,
                    coalesce(m_i, 0) AS i, r.raceethnicity, d.name AS pd_name, lower(trim(coalesce(da.value, ''))) AS aide,
                    CASE WHEN lower(trim(coalesce(da.value, ''))) = 'no' THEN NULL ELSE m_a END AS m_a
             FROM univ u JOIN sch ON sch.schoolcode = u.school_code AND sch.district_code = u.district_code
             LEFT JOIN race r ON r.usi = u.studentcode
             LEFT JOIN disabilities d ON d.id = u.pd AND d.inactive = '0' AND d.district_code = '1'
             LEFT JOIN mins ON mins.studentcode = u.studentcode AND mins.district_code = u.district_code
             LEFT JOIN custom da ON da.name = 'AideRequired' AND da.studentid = u.studentid
                  AND da.district_code = u.district_code AND da.eventid = u.iep_id),
    hours AS (SELECT *, (2 * m_a + 600000) // 1200000 AS h_a, (2 * o + 600000) // 1200000 AS h_o,
                     (2 * i + 600000) // 1200000 AS h_i, (2 * (o + i) + 600000) // 1200000 AS h_t,
                     ((2 * o + w) // (2 * w) * 2 + 100) // 200 AS p_o,
                     CASE WHEN w > 0 THEN greatest((((w - (2 * o + 10000) // 20000) * 20000 + w) // (2 * w) * 2 + 100) // 200, 0) END AS p_i,
                     coalesce((2 * m_o + w * 100) // (200 * w), 0) AS p_l FROM base),
    report AS (SELECT *, coalesce(h_a, 0) + h_t AS h_all,
                      CASE WHEN p_l BETWEEN 0 AND 20 THEN 'A: 0-20%' WHEN p_l BETWEEN 21 AND 60 THEN 'B: 21-60%'
                           WHEN p_l > 60 THEN 'C: 60+ %' END AS lre,
                      CASE WHEN coalesce(h_a, 0) + h_t <= 800 THEN 'Level 1' WHEN coalesce(h_a, 0) + h_t <= 1600 THEN 'Level 2'
                           WHEN coalesce(h_a, 0) + h_t <= 2400 THEN 'Level 3' ELSE 'Level 4' END AS level FROM hours),
    published AS (SELECT p.*, m.childcount_environment AS env, CASE WHEN e.studentcode IS NOT NULL THEN 'Yes' END AS ude
             FROM report p
             LEFT JOIN custom x ON x.name = 'LREFullTime' AND x.eventid = p.iep_id AND x.studentid = p.studentid
                  AND x.district_code = p.district_code
             LEFT JOIN env_map m ON lower(m.seds_environment) = lower(x.value)
             LEFT JOIN (SELECT DISTINCT studentcode, district_code FROM errors WHERE error_type LIKE 'Special%'
                        AND cc_exclusion = 'Yes') e
                  ON e.studentcode = p.studentcode AND coalesce(e.district_code, '') = p.district_code
             WHERE {eligible} p.district_code IN (SELECT lea_id FROM leas WHERE valid_for_enrollment = '1'))"""
_REPORT_SELECT = """
    SELECT studentid, studentcode, {lea} AS district_code, school_code, iep_id, status AS eligibility_status,
           raceethnicity AS race_code, pd_name AS primary_disability_name, CASE aide WHEN 'yes' THEN 'YES' ELSE 'NO' END
             AS dedicated_aide, CAST(CAST(h_a AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS aide_hours,
           CAST(units * 5 AS DECIMAL(12,2)) AS school_hours_per_week,
           CAST(CAST(h_o AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS outside_hours,
           CAST(CAST(h_i AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS inside_hours,
           CAST(CAST(h_t AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS total_hours,
           CAST(p_o AS DECIMAL(18,0)) AS outside_percent, CAST(p_i AS DECIMAL(18,0)) AS inside_percent, lre,
           CAST(CAST(h_all AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS total_hours_with_aide, level AS sped_level,
           env AS seds_environment, ude, CASE WHEN status IS NULL THEN 'Not Recv Services under IDEA' ELSE '' END AS flag,
           TIMESTAMP '2024-01-31 12:00:00' AS snapshot_date FROM published"""
_REPORT_COLUMNS = ["studentid", "studentcode", "district_code", "school_code", "iep_id", "eligibility_status",
                   "race_code", "primary_disability_name", "dedicated_aide", "aide_hours", "school_hours_per_week",
                   "outside_hours", "inside_hours", "total_hours", "outside_percent", "inside_percent", "lre",
                   "total_hours_with_aide", "sped_level", "seds_environment", "ude", "flag", "snapshot_date"]


def _sped(t: Tables, options: sp.SpedOptions) -> DataFrame:
    names = ["sped_enrollments", "sped_students", "sped_events", "amendments", "services", "service_types",
             "sped_schools", "categories", "leas", "race", "disabilities", "custom", "env_map", "errors"]
    return sp.sped_current(*[feed(t, n) for n in names], as_of=AS_OF, options=options)


@query("D9,D10,D11,J6,J10,J11,P11,P17,P18,S9,F13,F14", with_feeds(
    _REPORT_FEEDS, _SPED_EVENTS + _SPED_UNIVERSE + _minutes_sql("")
    + _REPORT.format(eligible="status = 'YES' AND") + _REPORT_SELECT.format(lea="district_code")))
def sped_current(t: Tables) -> DataFrame:
    return _sped(t, sp.CURRENT).select(*_REPORT_COLUMNS)


_NO_ELIGIBILITY = _SPED_EVENTS.replace("FROM ranked WHERE r = 1 AND kind = '1'", "FROM ranked WHERE FALSE")


@query("D9,D10,D11,U3", with_feeds(
    _REPORT_FEEDS, _NO_ELIGIBILITY + _SPED_UNIVERSE + _minutes_sql("OR iep_end < DATE '2024-01-31'")
    + _REPORT.format(eligible="") + _REPORT_SELECT.format(
        lea="CASE WHEN district_code = '1' THEN '001' ELSE district_code END")))
def sped_current_first_version(t: Tables) -> DataFrame:
    return _sped(t, sp.FIRST).select(*_REPORT_COLUMNS)


_SHEET = """,
    top AS (SELECT usi, max_by(special_education_level, (upper(special_education_level), special_education_level)) AS level
            FROM levels WHERE special_education_level <> '' GROUP BY usi),
    plan AS (SELECT usi, CAST(enrollment_responsible_lea_id AS BIGINT) AS lea, max(upper(accommodation_504)) AS a
             FROM roster WHERE trim(coalesce(usi, '')) <> '' GROUP BY 1, 2)
    SELECT DISTINCT p.studentcode, e.first_name, e.last_name, e.dob AS date_of_birth,
           strftime(iep_begin, '%m/%d/%Y') AS current_iep_start_date, strftime(iep_end, '%m/%d/%Y') AS current_iep_end_date,
           CASE WHEN dated_id IS NULL THEN strftime(iep_created, '%m/%d/%Y') ELSE 'null' END AS current_iep_amendment_date,
           pd_name AS current_primary_disability,
           CAST(CAST(h_all AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2)) AS current_hours, p.level AS current_swd_level,
           top.level AS highest_swd_level, CASE a WHEN 'Y' THEN 'YES' WHEN 'N' THEN 'NO' ELSE a END AS accommodation_504,
           {lea} AS lea_code
    FROM published p
    {join} sped_enrollments e ON e.usi = p.studentcode AND CAST(e.lea_code AS INTEGER) = CAST(p.district_code AS INTEGER)
    LEFT JOIN top ON top.usi = p.studentcode
    LEFT JOIN plan ON plan.usi = p.studentcode AND plan.lea = CAST(p.district_code AS INTEGER)"""


@query("D12,D13,D14,J12,F5", with_feeds(
    _REPORT_FEEDS, _SPED_EVENTS + _SPED_UNIVERSE + _minutes_sql("") + _REPORT.format(eligible="status = 'YES' AND")
    + _SHEET.format(join="LEFT JOIN", lea="p.district_code")))
def swd_sheet(t: Tables) -> DataFrame:
    return _sheet(t, sp.CURRENT)


def _sheet(t: Tables, options: sp.SpedOptions) -> DataFrame:
    levels = feed(t, "levels")
    years = [levels.where(F.col("school_year") < 1998), levels.where(F.col("school_year") >= 1998)]
    return sp.swd_sheet(_sped(t, options), feed(t, "sped_enrollments"), sp.highest_levels(years), sp.plan_504(feed(t, "roster")), options)


@query("D12,D14", with_feeds(
    _REPORT_FEEDS, _NO_ELIGIBILITY + _SPED_UNIVERSE + _minutes_sql("OR iep_end < DATE '2024-01-31'") + _REPORT.format(eligible="")
    + _SHEET.format(join="JOIN", lea="CASE WHEN p.district_code = '1' THEN '001' ELSE p.district_code END")))
def swd_sheet_with_504(t: Tables) -> DataFrame:
    return _sheet(t, sp.WITH_504)


@query("D9,D10,D11,U3", with_feeds(
    _REPORT_FEEDS, _SPED_EVENTS + _SPED_UNIVERSE + _minutes_sql("OR iep_end < DATE '2024-01-31'")
    + _REPORT.format(eligible="status = 'YES' AND") + _REPORT_SELECT.format(lea="district_code")))
def sped_current_trial(t: Tables) -> DataFrame:
    return _sped(t, sp.TRIAL).select(*_REPORT_COLUMNS)


@query("D13,W3,P5", with_feeds(["roster"], """
    SELECT usi, lea_code, CASE a WHEN 'Y' THEN 'YES' WHEN 'N' THEN 'NO' ELSE a END AS accommodation_504 FROM
      (SELECT usi, CAST(enrollment_responsible_lea_id AS BIGINT) AS lea_code, max(upper(accommodation_504)) AS a FROM roster
       WHERE trim(coalesce(usi, '')) <> '' GROUP BY 1, 2) x"""))
def plan_504(t: Tables) -> DataFrame:
    return sp.plan_504(feed(t, "roster"))


@query("D9,F13,F14,P11,P17", """
    WITH q AS (SELECT l_orderkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS BIGINT) AS o,
                      CAST(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0 END) AS BIGINT) AS i
               FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, CAST(CAST((coalesce(o, 0) + i) * 100 * 2 + 60 AS BIGINT) // 120 / CAST(100 AS DECIMAL(5,0))
                            AS DECIMAL(18,2)) AS total_hours,
           CAST((((coalesce(o, 0) * 10000 * 2 + 150) // 300) * 2 + 100) // 200 AS DECIMAL(18,0)) AS outside_percent,
           CAST(greatest((((150 - coalesce(o, 0)) * 10000 * 2 + 150) // 300 * 2 + 100) // 200, 0) AS DECIMAL(18,0))
             AS inside_percent,
           CASE WHEN (coalesce(o, 0) * 200 + 150) // 300 <= 20 THEN 'A: 0-20%'
                WHEN (coalesce(o, 0) * 200 + 150) // 300 <= 60 THEN 'B: 21-60%' ELSE 'C: 60+ %' END AS lre FROM q""")
def lre_band(t: Tables) -> DataFrame:
    quantity = F.col("l_quantity").cast("decimal(18,6)")
    rows = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", quantity)).cast("decimal(18,6)").alias("outside_minutes"),
        F.sum(F.when(F.col("l_returnflag") != "R", quantity)).cast("decimal(18,6)").alias("inside_minutes"))
    rows = rows.withColumns({"aide_minutes": F.lit(None).cast("decimal(18,6)"), "dedicated_aide": F.lit(""),
                             "units_per_day": F.lit("0.5").cast("decimal(10,2)")})
    return sp.hours_columns(rows).select("l_orderkey", "total_hours", "outside_percent", "inside_percent", "lre")


# ---------------------------------------------------------------- cohort

_RECORDS = """,
    ini AS (SELECT DISTINCT * FROM records),
    degree AS (SELECT school_id, lea_id FROM degree_schools WHERE degree_granting = 'Y'),
    non_degree AS (SELECT school_id FROM degree_schools WHERE trim(lower(non_granting)) = 'y'),
    non_public AS (SELECT DISTINCT school_id FROM leas WHERE lea_id = '5000'),
    recent AS (SELECT DISTINCT usi, lea_code, school_code, stage5_entry_date, stage5_exit_date, stage5_exit_code FROM
                 (SELECT *, rank() OVER (PARTITION BY usi ORDER BY stage5_entry_date DESC NULLS LAST,
                                         stage5_exit_date DESC NULLS LAST) AS r FROM ini) x WHERE r = 1),
    seen AS (SELECT *, school_code IN (SELECT school_id FROM degree) AS pref FROM recent),
    chosen AS (SELECT * FROM (SELECT *, bool_or(pref) OVER (PARTITION BY usi) AS any_pref,
                 row_number() OVER (PARTITION BY usi ORDER BY school_code DESC, lea_code DESC, stage5_entry_date DESC,
                   stage5_exit_date DESC NULLS LAST, stage5_exit_code DESC NULLS LAST) AS rn FROM seen) x
               WHERE pref OR (NOT any_pref AND rn = 1))"""


@query("D15,W2,W4,W5,T2", with_feeds(["records", "degree_schools", "leas"], _RECORDS + """
    SELECT usi, lea_code, school_code, stage5_entry_date, stage5_exit_date, stage5_exit_code,
           CASE WHEN stage5_exit_date IS NULL OR coalesce(stage5_exit_code, '') = '' THEN 'Currently Active'
                ELSE 'Currently Completely Inactive' END AS current_status FROM chosen"""))
def cohort_current_status(t: Tables) -> DataFrame:
    degree, _ = co.degree_lists(feed(t, "degree_schools"))
    return co.most_recent_status(feed(t, "records"), degree)


@query("D17,P9,P10,J5,U2", with_feeds(["records", "degree_schools"], """
    SELECT DISTINCT usi, lea_code, school_code, current_enrolled_grade FROM records r
    WHERE current_enrolled_grade IN ('09', '9', '10', '11', '12') OR current_enrolled_grade LIKE 'C%'
       OR (current_enrolled_grade NOT IN ('P3', 'PK3', 'PK4', 'KG', 'P4', '01', '1', '02', '2',
         '03', '3', '04', '4', '05', '5', '06', '6', '07', '7', '08', '8') AND EXISTS
           (SELECT 1 FROM degree_schools d WHERE degree_granting = 'Y' AND school_id = school_code AND lea_id = lea_code))"""))
def cohort_members(t: Tables) -> DataFrame:
    degree, _ = co.degree_lists(feed(t, "degree_schools"))
    rows = feed(t, "records").select("usi", "lea_code", "school_code", "current_enrolled_grade")
    return co.cohort_universe(rows, degree, "current_enrolled_grade")


@query("D19,D22,P10,T6", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Enrolled' WHEN 'F' THEN 'Exited' ELSE
             CASE WHEN o_orderpriority = '5-LOW' THEN 'Enrolled' ELSE 'Exited' END END AS enrollment_indicator,
           CASE WHEN o_orderstatus = 'O' OR (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') THEN 'NA'
                WHEN o_orderpriority = '2-HIGH' THEN 'Complete' WHEN o_orderpriority IN ('5-LOW', '1-URGENT')
                THEN 'Incomplete' ELSE 'Complete' END AS exit_indicator FROM orders""")
def exit_indicator_chain(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", "o_orderdate", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("code"),
        F.when(F.col("o_orderstatus") == "O", "enrolled").when(F.col("o_orderstatus") == "F", "Withdrawn ").alias("s"),
        fn.label([(F.col("o_orderpriority") == "1-URGENT", "Still PENDING review"),
                  (F.col("o_orderpriority") == "2-HIGH", "OSSE Accepted Exits")]).alias("display"))
    rows = co.exit_indicators(rows, "s", "o_orderdate", "code", "display")
    return rows.select("o_orderkey", F.initcap("enrollment_indicator").alias("enrollment_indicator"), "exit_indicator")


_COHORT_FEEDS = ["records", "degree_schools", "leas", "exits", "exit_status", "workflow", "power_leas"]
_COHORT = _RECORDS + """,
    with_cur AS (SELECT DISTINCT i.*, CASE WHEN enrollment_status <> 'Enrolled' THEN c.school_code END AS cur_school,
                        CASE WHEN enrollment_status <> 'Enrolled' THEN c.lea_code END AS cur_lea,
                        CASE WHEN enrollment_status <> 'Enrolled' THEN c.stage5_entry_date END AS cur_entry
                 FROM ini i LEFT JOIN chosen c ON c.usi = i.usi),
    member AS (SELECT * FROM with_cur w WHERE current_enrolled_grade IN ('09', '9', '10', '11', '12')
                 OR current_enrolled_grade LIKE 'C%' OR (current_enrolled_grade NOT IN ('P3', 'PK3', 'PK4', 'KG', 'P4', '01', '1', '02', '2',
         '03', '3', '04', '4', '05', '5', '06', '6', '07', '7', '08', '8') AND EXISTS
                   (SELECT 1 FROM degree d WHERE d.school_id = w.school_code AND d.lea_id = w.lea_code))),
    shifted AS (SELECT m.* REPLACE (
                  CASE WHEN school_code IN (SELECT school_id FROM non_public) THEN 'Non-Public School'
                       ELSE school_name END AS school_name,
                  CASE WHEN lea_code = '1' OR lea_code IN (SELECT lea_code FROM power_leas WHERE school_year = '2017-2018')
                       THEN stage5_exit_date + 1 ELSE stage5_exit_date END AS stage5_exit_date) FROM member m),
    found AS (SELECT usi, CASE leaid WHEN '001' THEN '1' ELSE leaid END AS lea, schoolid, enrollment_exit_code AS code,
                     enrollment_exit_date AS d, min(s.display_status) AS display
              FROM exits e LEFT JOIN exit_status s ON s.exitstatusid = e.exitstatusid
              WHERE school_year = '2017-18' GROUP BY ALL),
    ind AS (SELECT s.*, f.d AS ex_date, f.code AS ex_code, f.display,
                   CASE WHEN lower(trim(coalesce(enrollment_status_final, ''))) = 'withdrawn' THEN 'Exited'
                        WHEN trim(coalesce(enrollment_status_final, '')) <> '' THEN enrollment_status_final
                        WHEN stage5_exit_date IS NULL OR coalesce(stage5_exit_code, '') = '' THEN 'Enrolled'
                        ELSE 'Exited' END AS ei
            FROM shifted s LEFT JOIN found f ON f.usi = s.usi AND f.lea = s.lea_code AND f.schoolid = s.school_code
              AND f.code = s.stage5_exit_code AND f.d = s.stage5_exit_date),
    xi AS (SELECT *, coalesce(stage5_exit_code, '') AS xc,
                  CASE WHEN ei = 'Enrolled' THEN 'NA' WHEN display ILIKE '%OSSE Accepted%' THEN 'Complete'
                       WHEN coalesce(stage5_exit_code, '') = '' OR display ILIKE '%pending%'
                         OR display = 'OSSE NOt Accepted Exits' THEN 'Incomplete' ELSE 'Complete' END AS x FROM ind),
    flags AS (SELECT *,
                ei = 'Exited' AND x = 'Incomplete' AND xc IN ('1940', '1941', '1942', '1943', '1944') AS f_inc,
                ei = 'Exited' AND x = 'Complete' AND xc IN ('2002', '2040', '2041', '2042', '2043') AND cur_school IN (SELECT school_id FROM non_degree)
                  AND (cur_school IN ('860', '861', '480', '948', '958', '7000', '8100') OR cur_lea = '4002') AS f_state,
                ei = 'Exited' AND x = 'Complete' AND (xc IN ('2002', '2040', '2041', '2042', '2043') AND cur_school IN (SELECT school_id FROM degree)
                  OR cur_school IN (SELECT school_id FROM non_public)) AS f_deg,
                ei = 'Exited' AND x = 'Complete' AND xc IN ('2002', '2040', '2041', '2042', '2043') AND cur_school IN (SELECT school_id FROM non_degree)
                  AS f_non,
                ei = 'Exited' AND (x = 'Incomplete' AND xc NOT IN ('1940', '1941', '1942', '1943', '1944')
                  OR x = 'Complete' AND xc NOT IN ('1940', '1941', '1942', '1943', '1944') AND xc NOT IN ('2002', '2040', '2041', '2042', '2043')) AS f_no,
                ei = 'Exited' AND x = 'Complete' AND xc IN ('1940', '1941', '1942', '1943', '1944') AS f_out, ei = 'Enrolled' AS f_cur,
                lower(rtrim(school_name)) = 'non-public school' AS np FROM xi),
    spread AS (SELECT *, bool_or(np AND (f_cur OR f_no OR f_inc OR f_non)) OVER short AS g_idea,
                 bool_or(f_inc) OVER full_key AS g_inc, bool_or(f_state) OVER full_key AS g_state,
                 bool_or(f_deg) OVER full_key AS g_deg, bool_or(f_non) OVER full_key AS g_non,
                 bool_or(f_no) OVER full_key AS g_no, bool_or(f_out) OVER full_key AS g_out FROM flags
               WINDOW short AS (PARTITION BY usi, lea_code, school_code, ei),
                      full_key AS (PARTITION BY usi, lea_code, school_code, ei, xc, stage5_exit_date)),
    detail AS (SELECT *, CASE WHEN f_cur AND school_code IN ('861', '480') THEN 'Transfer to State'
                 WHEN f_cur AND school_code = '947' THEN 'Transfer to NOn-Degree-Granting'
                 WHEN f_cur THEN 'Currently Enrolled' WHEN g_out THEN 'Exited the State'
                 WHEN g_no THEN 'Recently Enrolled, NO Transfer' WHEN g_non THEN 'Transfer to NOn-Degree-Granting'
                 WHEN g_deg THEN 'Transfer to Degree-Granting' WHEN g_state THEN 'Transfer to State'
                 WHEN g_inc THEN 'Recently Enrolled, Incomplete Exit' WHEN g_idea THEN 'Responsible for IDEA Services'
                 ELSE '' END AS det FROM spread),
    judged AS (SELECT *, CASE WHEN det IN ('Transfer to State', 'Transfer to Degree-Granting', 'Exited the State') THEN 'NO'
                 WHEN det IN ('', 'Currently Enrolled') AND NOT (det = 'Currently Enrolled' AND
                   (np OR school_code IN (SELECT school_id FROM degree))) THEN '' ELSE 'YES' END AS verdict FROM detail),
    final AS (SELECT *, CASE WHEN det <> 'Currently Enrolled'
                        AND sum(CASE WHEN verdict = 'YES' THEN 1 ELSE 0 END) OVER (PARTITION BY usi) > 1
                        AND bool_or(det = 'Currently Enrolled') OVER (PARTITION BY usi) THEN 'NO' ELSE verdict END AS v
              FROM judged)"""


def _cohort(t: Tables) -> DataFrame:
    """The cohort table with equal rows left in: each query below takes distinct rows of its own columns, or looks up students."""
    return co.cohort_data(*[feed(t, n) for n in _COHORT_FEEDS], distinct=False)


@query("D18,D19,D20,D21,D22,D23,J8,J10,J13,J14,A3,P6,P7,P15,T6,T7,T16,T17,T18,T19", with_feeds(_COHORT_FEEDS, _COHORT + """
    SELECT DISTINCT usi, lea_code, school_code, school_name, current_enrolled_grade AS grade, stage5_entry_date,
           stage5_exit_date, stage5_exit_code, enrollment_status, enrollment_status_final,
           cur_school AS current_school_code, cur_lea AS current_lea_code, cur_entry AS current_entry_date,
           CASE WHEN ex_date IS NULL THEN '' ELSE ex_code END AS ex_mn_exit_code,
           CASE WHEN ex_date IS NULL THEN '' ELSE CAST(ex_date AS VARCHAR) END AS ex_mn_exit_date,
           CASE WHEN ex_date IS NULL THEN '' ELSE display END AS ex_mn_display_status,
           ei AS enrollment_indicator, x AS exit_indicator, det AS lea_detail, v AS lea_indicator, det AS school_detail,
           v AS school_indicator FROM final"""))
def cohort_responsibility(t: Tables) -> DataFrame:
    return _cohort(t).select(
        "usi", "lea_code", "school_code", "school_name", "grade", "stage5_entry_date", "stage5_exit_date",
        "stage5_exit_code", "enrollment_status", "enrollment_status_final", "current_school_code", "current_lea_code",
        "current_entry_date", "ex_mn_exit_code", "ex_mn_exit_date", "ex_mn_display_status", "enrollment_indicator",
        "exit_indicator", "lea_detail", "lea_indicator", "school_detail", "school_indicator").distinct()


@query("S10,U1", with_feeds(_COHORT_FEEDS, _COHORT + """
    SELECT DISTINCT lea_name, lea_code, school_name, school_code, usi, first_name, last_name, date_of_birth,
           'YES' AS acgr_universe, ei AS enrollment_indicator, x AS exit_indicator, v AS lea_indicator, det AS lea_detail,
           v AS school_indicator, det AS school_detail FROM final"""))
def cohort_report(t: Tables) -> DataFrame:
    return co.cohort_report(_cohort(t))


# ---------------------------------------------------------------- most recent enrollment

_RECENT = """,
    uni AS (SELECT DISTINCT usi, CASE enrollment_responsible_lea_id WHEN '001' THEN '1'
              ELSE enrollment_responsible_lea_id END AS lea_code, enrollment_responsible_lea_name AS lea_name,
              enrollment_attending_school_id AS school_code, enrollment_stage5_date AS stage5_date,
              enrollment_exit_date AS exit_date, enrollment_exit_code AS exit_code FROM roster
            WHERE CAST(logdate AS DATE) > DATE '1996-08-01' AND lower(trim(enrollment_status)) IN ('enrolled', 'withdrawn')
              AND lower(trim(enrollment_stage)) = 'stage 5' AND usi IN (SELECT usi FROM records r
              WHERE current_enrolled_grade IN ('09', '9', '10', '11', '12') OR current_enrolled_grade LIKE 'C%'
                OR (current_enrolled_grade NOT IN ('P3', 'PK3', 'PK4', 'KG', 'P4', '01', '1', '02', '2',
                  '03', '3', '04', '4', '05', '5', '06', '6', '07', '7', '08', '8') AND EXISTS
                    (SELECT 1 FROM degree_schools d WHERE degree_granting = 'Y' AND school_id = school_code AND lea_id = lea_code))))"""
_AFTER = dt.date(1996, 8, 1)


def _cohort_keys(t: Tables) -> DataFrame:
    """Students of the cohort by its own rule, without the rest of the cohort table."""
    rows = feed(t, "records").select("usi", "lea_code", "school_code", "current_enrolled_grade")
    return co.cohort_universe(rows, co.degree_lists(feed(t, "degree_schools"))[0], "current_enrolled_grade").select("usi")


@query("D16,S4,J1,W2", with_feeds(["roster", "records", "degree_schools"], _RECENT + """
    SELECT usi, lea_code AS most_recent_lea_code, lea_name AS most_recent_lea_name, school_code AS most_recent_school_code,
           stage5_date AS most_recent_stage5_date, exit_date AS most_recent_exit_date, exit_code AS most_recent_exit_code
    FROM (SELECT *, rank() OVER (PARTITION BY usi ORDER BY stage5_date DESC NULLS LAST, exit_date DESC NULLS LAST) AS r
          FROM uni) x WHERE r = 1"""))
def most_recent_enrollment(t: Tables) -> DataFrame:
    return rc.most_recent_enrollment(feed(t, "roster"), _cohort_keys(t), _AFTER)


@query("D16,J5,T20", with_feeds(["roster", "records", "degree_schools"], _RECENT + """,
    sub AS (SELECT DISTINCT usi, lea_code, school_code, stage5_date, exit_date, exit_code FROM uni
            WHERE EXISTS (SELECT 1 FROM degree_schools WHERE school_id = school_code AND lea_id = lea_code))
    SELECT usi, lea_code AS most_recent_degree_lea_code, school_code AS most_recent_degree_school_code,
           stage5_date AS most_recent_degree_stage5_date, exit_date AS most_recent_degree_exit_date,
           exit_code AS most_recent_degree_exit_code
    FROM (SELECT *, rank() OVER (PARTITION BY usi ORDER BY stage5_date DESC NULLS LAST, exit_date DESC NULLS LAST) AS r
          FROM sub) x WHERE r = 1"""))
def most_recent_degree_granting(t: Tables) -> DataFrame:
    return rc.most_recent_degree_granting(feed(t, "roster"), _cohort_keys(t), feed(t, "degree_schools"), _AFTER)


_OF_COHORT = _RECENT[:_RECENT.index("usi IN (SELECT")] + "usi IN (SELECT usi FROM final))"


@query("D16,S4,J1,W2", with_feeds(["roster", *_COHORT_FEEDS], _COHORT + _OF_COHORT + """
    SELECT usi, lea_code AS most_recent_lea_code, lea_name AS most_recent_lea_name, school_code AS most_recent_school_code,
           stage5_date AS most_recent_stage5_date, exit_date AS most_recent_exit_date, exit_code AS most_recent_exit_code
    FROM (SELECT *, rank() OVER (PARTITION BY usi ORDER BY stage5_date DESC NULLS LAST, exit_date DESC NULLS LAST) AS r
          FROM uni) x WHERE r = 1"""))
def most_recent_enrollment_of_cohort(t: Tables) -> DataFrame:
    return rc.most_recent_enrollment(feed(t, "roster"), _cohort(t).select("usi"), _AFTER)


@query("D16,J5,T20", with_feeds(["roster", *_COHORT_FEEDS], _COHORT + _OF_COHORT + """,
    sub AS (SELECT DISTINCT usi, lea_code, school_code, stage5_date, exit_date, exit_code FROM uni
            WHERE EXISTS (SELECT 1 FROM degree_schools WHERE school_id = school_code AND lea_id = lea_code))
    SELECT usi, lea_code AS most_recent_degree_lea_code, school_code AS most_recent_degree_school_code,
           stage5_date AS most_recent_degree_stage5_date, exit_date AS most_recent_degree_exit_date,
           exit_code AS most_recent_degree_exit_code
    FROM (SELECT *, rank() OVER (PARTITION BY usi ORDER BY stage5_date DESC NULLS LAST, exit_date DESC NULLS LAST) AS r
          FROM sub) x WHERE r = 1"""))
def most_recent_degree_granting_of_cohort(t: Tables) -> DataFrame:
    return rc.most_recent_degree_granting(feed(t, "roster"), _cohort(t).select("usi"), feed(t, "degree_schools"), _AFTER)


# ---------------------------------------------------------------- at risk

_PEOPLE = """,
    people AS (SELECT DISTINCT usi, lea_code, school_code, current_enrolled_grade AS grade, date_of_birth AS dob FROM records),
    known AS (SELECT DISTINCT usi, tanf, snap, cfsa, housing_status FROM indicators)"""
_CUTOFFS = {"09": dt.date(1982, 9, 30), "10": dt.date(1981, 9, 30), "11": dt.date(1980, 9, 30), "12": dt.date(1979, 9, 30)}


def _people(t: Tables) -> DataFrame:
    return feed(t, "records").select("usi", "lea_code", "school_code",
                                     F.col("current_enrolled_grade").alias("grade"),
                                     F.col("date_of_birth").alias("dob"))


@query("D24,P5,P14,P15,J2", with_feeds(["records", "indicators"], _PEOPLE + """,
    staged AS (SELECT p.*, CASE WHEN (grade = '09' AND dob <= DATE '1982-09-30') OR (grade = '10' AND dob <= DATE '1981-09-30')
                 OR (grade = '11' AND dob <= DATE '1980-09-30') OR (grade = '12' AND dob <= DATE '1979-09-30')
                 THEN 'YES' ELSE ' ' END AS overage,
                 CASE lower(trim(tanf)) WHEN 'y' THEN 'YES' WHEN 'n' THEN 'NO' ELSE tanf END AS tanf,
                 CASE lower(trim(snap)) WHEN 'y' THEN 'YES' WHEN 'n' THEN 'NO' ELSE snap END AS snap,
                 CASE lower(trim(cfsa)) WHEN 'y' THEN 'YES' WHEN 'n' THEN 'NO' ELSE cfsa END AS cfsa,
                 CASE WHEN trim(coalesce(housing_status, '')) <> '' THEN 'YES' ELSE ' ' END AS housing_status
               FROM people p LEFT JOIN known ON known.usi = p.usi)
    SELECT *, CASE WHEN grade IN ('AW', 'AT') THEN 'NO' WHEN overage = 'YES' OR tanf = 'YES' OR snap = 'YES' OR cfsa = 'YES'
                OR housing_status = 'YES' THEN 'YES' ELSE 'NO' END AS at_risk,
           TIMESTAMP '2024-01-31 12:00:00' AS last_refreshed FROM staged"""))
def at_risk_any(t: Tables) -> DataFrame:
    return rk.at_risk(_people(t), feed(t, "indicators"), AS_OF, _CUTOFFS)


@query("D25,F8,F9,F10,F11", """
    SELECT g AS grade, make_date(CAST(y - a AS INTEGER), 9, 30) AS cutoff FROM
      (SELECT DISTINCT EXTRACT(YEAR FROM o_orderdate) AS y FROM orders WHERE o_orderdate = TIMESTAMP '1997-09-30 00:00:00') d
    CROSS JOIN (VALUES ('09', 15), ('10', 16), ('11', 17), ('12', 18)) v(g, a)""")
def overage_cutoffs(t: Tables) -> DataFrame:
    return rk.overage_cutoffs(t.orders, dt.datetime(1998, 3, 4, 12), date_col="o_orderdate")


@query("P14,D25", with_feeds(["records"], """,
    day AS (SELECT count(*) AS n FROM orders WHERE o_orderdate = TIMESTAMP '1997-09-30 00:00:00')
    SELECT usi, grade, dob, n > 0 AND dob <= CASE grade WHEN '09' THEN DATE '1982-09-30' WHEN '10' THEN DATE '1981-09-30'
             WHEN '11' THEN DATE '1980-09-30' WHEN '12' THEN DATE '1979-09-30' ELSE DATE '0001-01-01' END AS overage
    FROM (SELECT DISTINCT usi, current_enrolled_grade AS grade, date_of_birth AS dob FROM records) r CROSS JOIN day"""))
def overage_flag(t: Tables) -> DataFrame:
    cutoffs = rk.overage_cutoffs(t.orders, dt.datetime(1998, 3, 4, 12), date_col="o_orderdate")
    return op.overage(_people(t).select("usi", "grade", "dob").distinct(), "grade", "dob", cutoffs)


# ---------------------------------------------------------------- profiles

_PIVOT_FEEDS = ["building_fields", "dictionary"]


def _pivot_sql(screen: str, labels: list[str]) -> str:
    cells = ", ".join("""min(CASE WHEN field_label = '{0}' THEN field_value END) AS "{1}\"""".format(
        name.replace("'", "''"), name) for name in labels)
    return f"""SELECT b.district, building, {cells} FROM building_fields b LEFT JOIN dictionary d
        ON d.district = b.district AND d.screen_number = b.screen_number AND d.field_number = b.field_number
        WHERE b.screen_number = '{screen}' GROUP BY b.district, building"""


@query("D26,A5,A6", with_feeds(_PIVOT_FEEDS, " " + _pivot_sql("8003", pr.PARENT_LABELS)))
def parent_profile(t: Tables) -> DataFrame:
    return pr.profile_sheets(feed(t, "building_fields"), feed(t, "dictionary"))[pr.PARENT_SCREEN]


@query("D26,A5,A6", with_feeds(_PIVOT_FEEDS, " " + _pivot_sql("8004", pr.ENVIRONMENT_LABELS)))
def environment_profile(t: Tables) -> DataFrame:
    return pr.profile_sheets(feed(t, "building_fields"), feed(t, "dictionary"))[pr.ENVIRONMENT_SCREEN]


_SHEET_NAMES = {"social": "School Social Media Presence?", "twitter": "Twitter Link", "facebook": "Facebook Link",
                "org": "Parent Organization?", "org_link": "Parent Org Link", "org_poc": "Parent Org - POC?",
                "first": "POC First Name", "last": "POC Last Name", "email": "POC Email Address",
                "phone": "POC Phone Number xxx-xxx-xxxx", "policy": "Parent Communication Policy?",
                "policy_link": "Communication Policy Link", "charter": "FOR CHARTER SCHOOLS ONLY",
                "dcps": "FOR DCPS SCHOOLS ONLY", "rep": "Parent Representative POC?", "team": "School Advisory Team?",
                "team_link": "School Advisory Team Link", "team_poc": "School Advisory Team POC?"}


def _yes(c: str) -> str:
    return f"upper(trim(coalesce({c}, ''))) IN ('Y', 'YES', '1')"


def _only(flag: str, value: str, otherwise: str = "''") -> str:
    return f"CASE WHEN {_yes(flag)} THEN {value} ELSE {otherwise} END"


@query("D27,J3,P7,P10,F12,T12", with_feeds([*_PIVOT_FEEDS, "master"], f""",
    sheet AS ({_pivot_sql("8003", pr.PARENT_LABELS)}),
    short AS (SELECT district, building, {", ".join(f'"{long}" AS {name}' for name, long in _SHEET_NAMES.items())} FROM sheet),
    prof AS (SELECT DISTINCT CASE m.school_code WHEN '141' THEN '9000' ELSE m.school_code END AS school, p.*, m.* EXCLUDE (school_code),
               {_only("charter", "rep")} AS c_rep, {_only("charter", "first")} AS c_first,
               {_only("charter", "last")} AS c_last, {_only("charter", "phone")} AS c_phone,
               {_only("dcps", "team")} AS d_team, {_only("dcps", "team_link")} AS d_link,
               {_only("dcps", "team_poc")} AS d_poc, {_only("dcps", "first")} AS d_first, {_only("dcps", "last")} AS d_last,
               {_only("dcps", "email")} AS d_email, {_only("dcps", "phone")} AS d_phone,
               CASE WHEN upper(trim(after_care_available)) = 'X' THEN 'Y' ELSE 'N' END AS care
             FROM master m LEFT JOIN short p
               ON p.building = CASE m.school_code WHEN '141' THEN '9000' ELSE m.school_code END)
    SELECT DISTINCT school AS school_code, district AS lea_code, {_only("social", "'Y'", "'N'")} AS social_media,
           {_only("social", "twitter")} AS twitter_link,
           {_only("social", "facebook")} AS facebook_link, {_only("org", "'Y'", "'N'")} AS parent_org,
           {_only("org", "org_link")} AS parent_org_link, {_only("org_poc", "org_poc", "'N'")} AS parent_org_poc,
           {_only("org_poc", "first || last", "NULL")} AS poc_first_name,
           {_only("org_poc", "first || last", "NULL")} AS poc_last_name, {_only("org_poc", "email")} AS poc_email,
           {_only("org_poc", "phone")} AS poc_phone, {_only("policy", "policy", "'N'")} AS communication_policy,
           {_only("policy", "policy_link")} AS communication_policy_link, {_only("c_rep", "c_rep")} AS charter_representative,
           {_only("c_rep", "c_first || c_last")} AS charter_first_name,
           {_only("c_rep", "c_first || c_last")} AS charter_last_name, {_only("c_rep", "c_phone")} AS charter_phone,
           {_only("d_team", "d_team")} AS advisory_team, {_only("d_link", "d_link")} AS advisory_link,
           {_only("d_poc", "d_poc", "'N'")} AS advisory_poc, {_only("d_poc", "d_first || d_last", "NULL")} AS dcps_first_name,
           {_only("d_poc", "d_first || d_last", "NULL")} AS dcps_last_name, {_only("d_poc", "d_email")} AS dcps_email,
           {_only("d_poc", "d_phone")} AS dcps_phone, school_hours AS operating_hours, point_of_pride_1, point_of_pride_2,
           point_of_pride_3, '' AS feeder_schools, care AS care_available, {_only("care", "before_after_hours")} AS care_hours,
           {_only("care", "care_is_free")} AS care_paid,
           {_only("care", "CASE WHEN care_scale_or_voucher ILIKE '%sliding%' THEN 'Y' ELSE 'N' END")} AS care_sliding,
           {_only("care", "CASE WHEN care_scale_or_voucher ILIKE '%voucher%' THEN 'Y' ELSE 'N' END")} AS care_voucher,
           '' AS care_free, metro_bus AS bus_line, metro_rail AS metro_line, grades_served AS school_programs,
           additional_enrichments AS extra_curricular FROM prof"""))
def school_environment(t: Tables) -> DataFrame:
    parent = pr.profile_sheets(feed(t, "building_fields"), feed(t, "dictionary"))[pr.PARENT_SCREEN]
    return pr.school_environment(pr.school_profiles(parent, feed(t, "master")))
