"""School feeds derived from the given tables, as SQL that Spark and DuckDB both run.

A customer is a student, a nation a school, an order an enrollment spell, an event an entry of the
special-education log, a line item a service. Every feed grows with its tables. Blanks, NULLs, code variants and
ties are put in on purpose.
"""
from __future__ import annotations

from rollbook.plans.profiles import ENVIRONMENT_LABELS, PARENT_LABELS


def _case(expr: str, values: list[str | None], otherwise: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values))
    return f"CASE {expr} {whens} ELSE {otherwise} END"


def _school(n: str) -> str:
    return _case(n, ["947", "861", "480", "860", "7000", "948", "958", "8100", "862"], f"CAST(300 + {n} AS STRING)")


def _lea(n: str) -> str:
    return (f"CASE {n} % 6 WHEN 0 THEN '1' WHEN 3 THEN '4002' WHEN 4 THEN '5000' "
            f"ELSE CAST(100 + {n} % 6 AS STRING) END")


def _label(n: str, labels: list[str]) -> str:
    whens = " ".join("WHEN {} THEN '{}'".format(i, name.replace("'", "''")) for i, name in enumerate(labels))
    return f"CASE {n} {whens} ELSE 'Unlisted field' END"


_SPELL = "o_orderkey % 25"                      # school of an order
# Every listed grade, exit code and school, and others just beside them.
_GRADE = _case("o_orderkey % 37", ["09", "10", "11", "12", "C1", "P3", "08", "AW", "9", "05", "PK3", "PK4", "KG", "P4", "01", "1", "02", "2",
                                   "03", "3", "04", "4", "5", "06", "6", "07", "7", "8", "09", "10", "11", "12", "13", "9", "C2"], "'AT'")
_DAY = "CAST(o_orderdate AS DATE)"
_TERM = "CAST(CAST(EXTRACT(YEAR FROM o_orderdate) AS STRING) || '-09-01' AS DATE)"
# Orders with the school, LEA, exit code and exit day of the spell, each computed once.
_EXIT_CODE = _case("(o_custkey * 7 + o_orderkey) % 19",
                   ["1940", "1941", "1942", "1943", "1944", "1945", "2002", "2040", "2041", "2042", "2043", "2044", "1999", "", None, "1939"],
                   "'2002'")
_EXIT_DAY = f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_DAY} + CAST(o_orderkey % 300 AS INT) END"
_SPELLS = f"""(SELECT *, {_school(f'({_SPELL})')} AS school, {_EXIT_CODE} AS exit_code, {_EXIT_DAY} AS exit_day,
                 CASE WHEN o_orderkey % 17 = 0 THEN '104' ELSE {_lea(f'({_SPELL})')} END AS lea
                 FROM {{orders}}) spells"""
_BORN = "DATE '1979-06-01' + CAST(o_custkey % 2200 AS INT)"
_ID = "CAST(c_custkey AS STRING)"
_HOME = "c_nationkey"
_LOG_STUDENT = "CASE WHEN event_id % 11 = 0 AND user_id % 15 = 0 THEN user_id + 500000 ELSE user_id + 1000 END"

FEEDS: dict[str, str] = {
    # ------------------------------------------------------------ enrollment
    "roster": f"""
        SELECT CASE WHEN o_orderkey % 97 = 0 THEN ' ' WHEN o_orderkey % 89 = 0 THEN NULL
                    ELSE CAST(o_custkey AS STRING) END AS usi,
               'L' || CAST(o_custkey % 10 AS STRING) AS source_local_id,
               'Last' || CAST(o_custkey AS STRING) AS last_name, 'First' || CAST(o_custkey AS STRING) AS first_name,
               {_BORN} AS date_of_birth, CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender_code,
               {_GRADE} AS enrollment_grade_level_code, CAST(o_custkey % 7 AS STRING) AS race_ethnicity_code,
               'Race ' || CAST(o_custkey % 5 AS STRING) AS race_ethnicity_desc,
               CASE WHEN o_orderkey % 2 = 0 AND lea = '1' THEN '001' ELSE lea END
                   AS enrollment_responsible_lea_id,
               'LEA ' || lea AS enrollment_responsible_lea_name,
               school AS enrollment_attending_school_id,
               'School ' || school AS enrollment_attending_school_name,
               {_TERM} AS enrollment_stage5_date, '1800' AS enrollment_entry_code,
               exit_day AS enrollment_exit_date, exit_code AS enrollment_exit_code,
               CASE o_orderkey % 9 WHEN 0 THEN 'Stage 4' WHEN 1 THEN 'stage 5 ' ELSE 'Stage 5' END AS enrollment_stage,
               CASE o_orderstatus WHEN 'O' THEN 'Enrolled' WHEN 'F' THEN 'WITHDRAWN ' ELSE
                   CASE WHEN o_orderkey % 2 = 0 THEN 'Pending' ELSE 'enrolled' END END AS enrollment_status,
               CASE o_orderkey % 8 WHEN 0 THEN 'Custom' WHEN 1 THEN '' WHEN 2 THEN ' ' ELSE NULL END AS custom1,
               CASE WHEN o_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS lep_indicator,
               CASE WHEN o_orderkey % 8 = 0 THEN 'Y' WHEN o_orderkey % 8 = 4 THEN 'y ' WHEN o_orderkey % 4 = 1 THEN '' ELSE NULL END AS new_to_us,
               CASE WHEN o_orderkey % 6 = 0 THEN 'SPA' WHEN o_orderkey % 3 = 0 THEN 'spa' WHEN o_orderkey % 3 = 1 THEN 'amh' ELSE '' END
                   AS native_language_code,
               CASE WHEN o_orderkey % 6 = 0 THEN 'Y' WHEN o_orderkey % 6 = 1 THEN 'n' WHEN o_orderkey % 6 = 2 THEN ''
                    ELSE NULL END AS accommodation_504,
               o_orderdate AS logdate
        FROM {_SPELLS}""",
    "audit": f"""
        SELECT {_ID} AS usi, 'A' || CAST(c_custkey % 10 AS STRING) AS local_id, c_name AS last_name,
               c_mktsegment AS first_name, DATE '1979-06-01' + CAST(c_custkey % 2200 AS INT) AS date_of_birth,
               'F' AS gender, '09' AS enrollment_grade_level_indicator,
               CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'race ' || CAST(c_custkey % 6 AS STRING) END
                   AS race_ethnicity,
               {_lea(_HOME)} AS lea_code, 'LEA ' || {_lea(_HOME)} AS lea_name, {_school(_HOME)} AS school_code,
               'School ' || {_school(_HOME)} AS school_name, DATE '1999-09-01' AS enrollment_date,
               '1800' AS enrollment_code, CAST(NULL AS DATE) AS exit_date, '' AS exit_code,
               CASE c_custkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '' ELSE NULL END AS lep_indicator
        FROM {{customer}}""",
    # ------------------------------------------------------------ cohort
    "records": f"""
        SELECT CAST(o_custkey AS STRING) AS usi, lea AS lea_code, 'LEA ' || lea AS lea_name,
               school AS school_code,
               CASE WHEN o_orderkey % 29 = 0 THEN 'non-public school ' ELSE 'School ' || school END
                   AS school_name,
               {_GRADE} AS current_enrolled_grade, 'First' || CAST(o_custkey AS STRING) AS first_name,
               'Last' || CAST(o_custkey AS STRING) AS last_name, {_BORN} AS date_of_birth,
               o_orderstatus AS student_current_status,
               CASE o_orderstatus WHEN 'O' THEN 'Enrolled' WHEN 'F' THEN 'Withdrawn' ELSE
                   CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE NULL END END AS enrollment_status,
               CASE o_orderstatus WHEN 'O' THEN 'Enrolled' WHEN 'F' THEN 'withdrawn' ELSE
                   CASE WHEN o_orderkey % 4 < 2 THEN ' ' ELSE NULL END END AS enrollment_status_final,
               {_TERM} AS stage5_entry_date, '1800' AS stage5_entry_code, exit_code AS stage5_exit_code,
               exit_day AS stage5_exit_date
        FROM {_SPELLS}""",
    "degree_schools": f"""
        SELECT {_school('n_nationkey')} AS school_id, {_lea('n_nationkey')} AS lea_id,
               CASE WHEN n_nationkey % 3 = 0 THEN 'Y' ELSE 'N' END AS degree_granting,
               CASE WHEN n_nationkey % 3 = 1 THEN 'y ' ELSE '' END AS non_granting
        FROM {{nation}}""",
    "leas": f"""
        SELECT {_lea('n_nationkey')} AS lea_id, 'LEA ' || {_lea('n_nationkey')} AS lea_name,
               {_school('n_nationkey')} AS school_id, n_name AS school_name,
               CASE WHEN n_nationkey % 6 = 5 THEN '0' ELSE '1' END AS valid_for_enrollment
        FROM {{nation}}""",
    "exits": f"""
        SELECT CASE WHEN copy = 0 AND o_orderkey % 3 = 0 THEN 'none ' ELSE '' END || CAST(o_custkey AS STRING) AS usi,
               CASE WHEN lea = '1' THEN '001' ELSE lea END AS leaid,
               school AS schoolid, exit_code AS enrollment_exit_code,
               exit_day + CASE WHEN lea IN ('1', '101') THEN 1 ELSE 0 END AS enrollment_exit_date,
               CAST((o_orderkey + copy) % 6 AS BIGINT) AS exitstatusid, CAST(o_orderkey % 4 AS BIGINT) AS workflowid,
               CASE WHEN o_orderkey % 19 = 0 THEN '2016-17' ELSE '2017-18' END AS school_year
        FROM (SELECT *, 0 AS copy FROM {_SPELLS}
              UNION ALL SELECT *, 3 AS copy FROM {_SPELLS} WHERE o_orderkey % 7 = 0) copies""",
    "exit_status": """
        SELECT r_regionkey AS exitstatusid, CASE r_regionkey WHEN 0 THEN 'Pending Review' WHEN 1 THEN
               'OSSE Accepted Exits' WHEN 2 THEN 'OSSE NOt Accepted Exits' WHEN 3 THEN 'Closed' ELSE NULL END
               AS display_status FROM {region}""",
    "workflow": "SELECT r_regionkey AS statusid, r_name AS status FROM {region}",
    "power_leas": f"""
        SELECT DISTINCT {_lea('n_nationkey')} AS lea_code, '2017-2018' AS school_year FROM {{nation}}
        WHERE n_nationkey % 6 = 1""",
    # ------------------------------------------------------------ special education
    "sped_enrollments": f"""
        SELECT {_ID} AS usi, CASE WHEN c_custkey % 2 = 0 AND {_lea(_HOME)} = '1' THEN '001' ELSE {_lea(_HOME)} END
                   AS lea_code,
               {_school(_HOME)} AS school_code, c_mktsegment AS first_name, c_name AS last_name,
               DATE '2005-01-01' + CAST(c_custkey % 3000 AS INT) AS dob
        FROM {{customer}}
        UNION ALL
        SELECT {_ID}, {_lea(_HOME)}, {_school(f'(({_HOME} + 6) % 25)')}, c_mktsegment, c_name,
               DATE '2005-01-01' + CAST(c_custkey % 3000 AS INT)
        FROM {{customer}} WHERE c_custkey % 10 = 0""",
    "sped_students": f"""
        SELECT CAST(c_custkey + 1000 AS BIGINT) AS id, {_ID} AS studentcode, {_lea(_HOME)} AS district_code
        FROM {{customer}}
        UNION ALL
        SELECT CAST(c_custkey + 500000 AS BIGINT), {_ID}, {_lea(_HOME)} FROM {{customer}} WHERE c_custkey % 15 = 0""",
    "sped_events": f"""
        SELECT CAST(event_id AS BIGINT) AS id, CAST({_LOG_STUDENT} AS BIGINT) AS studentid, {_lea(_HOME)} AS district_code,
               CASE event_type WHEN 'purchase' THEN '2' WHEN 'signup' THEN '1'
                    WHEN 'error' THEN CASE WHEN event_id % 12 = 0 THEN '110' ELSE '9' END
                    WHEN 'click' THEN CASE WHEN event_id % 16 = 0 THEN '55' ELSE '9' END ELSE '3' END AS eventtype,
               CAST(ts AS DATE) AS eventdate, CAST(ts AS DATE) + CAST(event_id % 3 AS INT) AS begindate,
               CAST(ts AS DATE) + CAST(event_id % 40 AS INT) AS enddate, ts AS datecreated,
               CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(event_id % 6 AS STRING) END AS primary_disability,
               CASE WHEN event_id % 13 = 0 THEN '1' ELSE '0' END AS inactive
        FROM {{events}} JOIN {{customer}} ON user_id = c_custkey""",
    "amendments": f"""
        SELECT CAST({_LOG_STUDENT} AS BIGINT) AS studentid, {_lea(_HOME)} AS lea, CASE WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN CAST(event_id AS BIGINT) END AS eventid
        FROM {{events}} JOIN {{customer}} ON user_id = c_custkey""",
    "services": f"""
        SELECT CAST({_LOG_STUDENT} AS BIGINT) AS studentid, {_lea(_HOME)} AS district_code,
               CAST(event_id AS BIGINT) AS eventid,
               CASE WHEN l_partkey % 5 = 0 THEN '584' ELSE CAST(l_suppkey % 8 AS STRING) END AS serviceid,
               CASE WHEN l_partkey % 20 = 0 THEN ' ' ELSE CAST(l_quantity AS STRING) END AS time_spent,
               CASE WHEN l_suppkey % 3 = 0 THEN '2' ELSE '1' END AS time_units,
               CAST(l_linenumber AS STRING) AS time_period,
               CASE WHEN l_partkey % 4 = 0 THEN '2' WHEN l_partkey % 4 = 1 THEN '' ELSE NULL END AS num_sessions,
               CASE l_partkey % 3 WHEN 0 THEN '86' WHEN 1 THEN '83' ELSE '99' END AS location,
               CASE WHEN l_partkey % 31 = 0 THEN '1' ELSE '0' END AS inactive,
               DATE '2024-01-01' + l_linenumber AS begin_date,
               DATE '2024-01-22' + CAST(l_partkey % 15 AS INT) AS end_date,
               CASE l_suppkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '' ELSE NULL END AS consultation,
               CASE l_orderkey % 6 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN '0' WHEN 3 THEN ' ' ELSE NULL END
                   AS extended_school_year
        FROM {{lineitem}} JOIN {{events}} ON event_id = l_orderkey % (SELECT count(*) FROM {{events}})
             JOIN {{customer}} ON user_id = c_custkey""",
    "service_types": """
        SELECT CAST(n_nationkey AS STRING) AS serviceid, CASE WHEN n_nationkey = 3 THEN '1' ELSE '' END
               AS exclude_from_618 FROM {nation}
        UNION ALL SELECT CAST(n_nationkey AS STRING), NULL FROM {nation} WHERE n_nationkey = 5""",
    "sped_schools": f"""
        SELECT {_school('n_nationkey')} AS schoolcode, {_lea('n_nationkey')} AS district_code, n_name AS name,
               n_regionkey AS category,
               CASE n_nationkey % 4 WHEN 0 THEN '6.5' WHEN 1 THEN '7' WHEN 2 THEN '0' ELSE
                   CASE WHEN n_nationkey = 7 THEN NULL ELSE '2' END END AS units_per_day,
               CASE WHEN n_nationkey = 11 THEN '1' ELSE '0' END AS inactive
        FROM {{nation}}""",
    "categories": """
        SELECT r_regionkey AS id, 'Type ' || r_name AS school_type, r_name AS description FROM {region}
        WHERE r_regionkey <> 4""",
    "race": f"""
        SELECT CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE {_ID} END AS usi, CAST(c_custkey % 7 AS STRING) AS raceethnicity,
               c_mktsegment AS race_fin FROM {{customer}}""",
    "disabilities": """
        SELECT CAST(r_regionkey AS STRING) AS id, 'Disability ' || r_name AS name, 'C' || CAST(r_regionkey AS STRING)
               AS code_618, '1' AS district_code, CASE WHEN r_regionkey = 3 THEN '1' ELSE '0' END AS inactive
        FROM {region}""",
    "custom": f"""
        SELECT CAST({_LOG_STUDENT} AS BIGINT) AS studentid, {_lea(_HOME)} AS district_code,
               CAST(event_id AS BIGINT) AS eventid, CASE WHEN event_id % 5 = 0 THEN 'Other' ELSE 'AideRequired' END AS name,
               CASE event_id % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' WHEN 2 THEN '' ELSE NULL END AS value
        FROM {{events}} JOIN {{customer}} ON user_id = c_custkey 
        UNION ALL
        SELECT CAST({_LOG_STUDENT} AS BIGINT), {_lea(_HOME)}, CAST(event_id AS BIGINT), 'LREFullTime',
               'env ' || CAST(event_id % 6 AS STRING)
        FROM {{events}} JOIN {{customer}} ON user_id = c_custkey""",
    "env_map": """
        SELECT 'Env ' || CAST(r_regionkey AS STRING) AS seds_environment, 'Count ' || r_name
               AS childcount_environment FROM {region}""",
    "errors": f"""
        SELECT {_ID} AS studentcode, CASE WHEN c_custkey % 2 = 0 THEN {_lea(_HOME)} ELSE NULL END AS district_code,
               CASE WHEN c_custkey % 3 = 0 THEN 'Special Education (SPED)' ELSE 'Other' END AS error_type,
               CASE WHEN c_custkey % 5 = 0 THEN 'No' ELSE 'Yes' END AS cc_exclusion
        FROM {{customer}}""",
    "levels": """
        SELECT CAST(o_custkey AS STRING) AS usi,
               CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Level ' ELSE 'level ' END || CAST(o_orderkey % 5 AS STRING) END
               AS special_education_level, EXTRACT(YEAR FROM o_orderdate) AS school_year FROM {orders}""",
    # ------------------------------------------------------------ risk and profiles
    "indicators": f"""
        SELECT CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE {_ID} END AS usi, CASE c_custkey % 5 WHEN 0 THEN 'Y' WHEN 1 THEN 'n' WHEN 2 THEN NULL ELSE '' END AS tanf,
               CASE WHEN c_custkey % 7 = 0 THEN 'y ' ELSE 'N' END AS snap, 'N' AS cfsa,
               CASE c_custkey % 11 WHEN 0 THEN 'Shelter' WHEN 1 THEN ' ' ELSE NULL END AS housing_status
        FROM {{customer}}
        UNION ALL
        SELECT {_ID}, 'N', 'N', 'Y', NULL FROM {{customer}} WHERE c_custkey % 17 = 0""",
    "building_fields": """
        SELECT CAST(user_id % 3 AS STRING) AS district, CAST(user_id AS STRING) AS building,
               CASE event_id % 3 WHEN 0 THEN '8003' WHEN 1 THEN '8004' ELSE '9000' END AS screen_number,
               CAST(event_id % 23 AS STRING) AS field_number,
               CASE event_id % 7 WHEN 0 THEN 'Y' WHEN 1 THEN 'yes' WHEN 2 THEN '1' WHEN 3 THEN 'N' WHEN 4 THEN NULL
                    ELSE props END AS field_value
        FROM {events}""",
    "dictionary": " UNION ALL ".join(f"""
        SELECT '{district}' AS district, '{screen}' AS screen_number, CAST(n_nationkey AS STRING) AS field_number,
               {_label('n_nationkey', labels)} AS field_label FROM {{nation}} WHERE n_nationkey <> 22"""
        for district in (0, 1, 2) for screen, labels in (("8003", PARENT_LABELS), ("8004", ENVIRONMENT_LABELS))),
    "master": """
        SELECT CAST(c_custkey AS STRING) AS school_code, c_name AS school_hours, c_mktsegment AS point_of_pride_1,
               '' AS point_of_pride_2, CAST(NULL AS STRING) AS point_of_pride_3,
               CASE c_custkey % 3 WHEN 0 THEN 'x' WHEN 1 THEN '' ELSE NULL END AS after_care_available,
               '7-' || CAST(c_custkey % 12 AS STRING) AS before_after_hours,
               CASE WHEN c_custkey % 2 = 0 THEN 'Paid' ELSE '' END AS care_is_free,
               CASE c_custkey % 4 WHEN 0 THEN 'On a Sliding scale' WHEN 1 THEN 'VOUCHER, sliding' WHEN 2 THEN 'none'
                    ELSE NULL END AS care_scale_or_voucher,
               'Bus ' || CAST(c_nationkey AS STRING) AS metro_bus, 'Rail' AS metro_rail, '9-12' AS grades_served,
               c_mktsegment AS additional_enrichments
        FROM {customer}""",
}

_TABLES = {n: n for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")}


def with_feeds(names: list[str], steps: str) -> str:
    """DuckDB text: the feeds as common table expressions, then ``steps`` (more of them and the final select)."""
    feeds = ",\n".join(f"{n} AS ({FEEDS[n].format(**_TABLES)})" for n in names)
    return f"WITH {feeds}{steps}"
