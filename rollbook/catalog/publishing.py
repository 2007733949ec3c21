"""Sources landed, targets published, replaced and read back, in folders of the run's own that go when the driver ends."""
from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook import functions as fn
from rollbook.catalog.domain import _CERTIFIED, enrollment_universe, feed, sped_current
from rollbook.catalog.feeds import with_feeds
from rollbook.catalog.registry import QUERIES, Tables, query
from rollbook.operators.audit import Missing, RuleSet, dq_report
from rollbook.operators.ordering import numbered
from rollbook.plans.enrollments import build_enrollments, certified_roster
from rollbook.plans.refresh import CERTIFIED
from rollbook.sources import land_days, publish, publish_table, scratch, stage
from rollbook.sources.landing import check
from rollbook.sources.schemas import DAY
from rollbook.sources.state import levels_with_state
from rollbook.sources.versions import read


def _published(t: Tables, rows: DataFrame, name: str) -> DataFrame:
    """A first version, and the full one in its place."""
    target = f"{scratch(t.spark, 'published')}/{name}"
    publish(rows.limit(0), target)
    publish(rows, target)
    return read(t.spark, target)


@query("S6,D1", QUERIES["enrollment_universe"].sql)
def published_enrollments(t: Tables) -> DataFrame:
    return _published(t, enrollment_universe(t), "enrollments")


@query("S6,S9,D9", QUERIES["sped_current"].sql)
def published_sped_current(t: Tables) -> DataFrame:
    return _published(t, sped_current(t), "sped_current")


_SHORT = """usi, source_local_id, last_name, first_name, date_of_birth AS dob, gender_code AS gender,
           enrollment_grade_level_code AS grade, race_ethnicity_code AS race_eth, lea AS lea_code,
           enrollment_responsible_lea_name AS lea_name, enrollment_attending_school_id AS school_code,
           enrollment_attending_school_name AS school_name, enrollment_stage5_date AS entry_date,
           enrollment_entry_code AS entry_code, enrollment_exit_date AS exit_date, enrollment_exit_code AS exit_code,
           enrollment_stage, enrollment_status"""


@query("S6,D1,D2", with_feeds(["roster", "audit"], _CERTIFIED + f""",
    certain AS (SELECT * FROM certified),
    race AS (SELECT lower(race_ethnicity_desc) AS text, min(race_ethnicity_code) AS code FROM certified GROUP BY 1),
    lacking AS (SELECT a.*, coalesce(code, race_ethnicity) AS race FROM audit a LEFT JOIN race ON lower(race_ethnicity) = race.text
                WHERE NOT EXISTS (SELECT 1 FROM certified c WHERE c.usi = a.usi AND c.lea = a.lea_code
                                  AND c.enrollment_attending_school_id = a.school_code))
    SELECT DISTINCT CAST(1 AS INTEGER) AS version, {_SHORT}, CAST(NULL AS STRING) AS lep_indicator, CAST(NULL AS STRING) AS new_to_us,
           CAST(NULL AS STRING) AS native_language_code, 'RosterUncertifiedMaster' AS category FROM certain
    UNION ALL
    SELECT DISTINCT 1, usi, local_id, last_name, first_name, date_of_birth, gender, enrollment_grade_level_indicator, race, lea_code, lea_name,
           school_code, school_name, enrollment_date, enrollment_code, exit_date, exit_code, 'Stage 5', 'Enrolled', NULL, NULL, NULL, 'AuditnotRoster'
    FROM lacking
    UNION ALL
    SELECT DISTINCT 2, {_SHORT}, lep_indicator, new_to_us, native_language_code,
           CASE WHEN trim(coalesce(custom1, '')) = '' THEN 'RosterUncertifiedMaster' ELSE custom1 END FROM certain
    UNION ALL
    SELECT DISTINCT 2, usi, local_id, last_name, first_name, date_of_birth, gender, enrollment_grade_level_indicator, race, lea_code, lea_name,
           school_code, school_name, enrollment_date, enrollment_code, exit_date, exit_code, 'Stage 5', 'Enrolled',
           CASE lep_indicator WHEN '1' THEN 'Y' WHEN '0' THEN 'N' ELSE '' END, '', '', 'AuditnotRoster' FROM lacking"""))
def published_enrollment_versions(t: Tables) -> DataFrame:
    """The short form is published and resolved by a reader; the wide form is published; the reader reads the first, a new one the second."""
    target = f"{scratch(t.spark, 'published')}/enrollments"
    roster = stage(certified_roster(feed(t, "roster")))
    publish(build_enrollments(roster, feed(t, "audit"), language=False, cut=lambda df: df), target)
    reader = read(t.spark, target)
    publish(build_enrollments(roster, feed(t, "audit"), cut=lambda df: df), target)
    first, second = reader.withColumn("version", F.lit(1)), read(t.spark, target).withColumn("version", F.lit(2))
    return second.unionByName(first, allowMissingColumns=True)


@query("S7,D26", QUERIES["parent_profile"].sql)
def published_profile_table(t: Tables) -> DataFrame:
    """The parent profile as a catalog table: made from a query, then replaced by another that reads it. The table is gone from the
    catalog afterwards, its files when the driver ends."""
    table, folder = f"profile_{uuid.uuid4().hex}", f"{scratch(t.spark, 'tables')}/profile"
    rows = QUERIES["parent_profile"].run(t)
    publish_table(rows, table, folder)
    publish_table(t.spark.table(table).where("district = '0'").unionByName(rows.where("district <> '0' OR district IS NULL")), table, folder)
    found = t.spark.table(table)
    found.schema  # resolved here, while the table is in the catalog
    t.spark.sql(f"DROP TABLE `{table}`")
    return found


# ---------------------------------------------------------------- landing

_CHANGE = dt.date(2000, 1, 1)


@query("S2,S3,S4", with_feeds(["roster"], """,
    months AS (SELECT *, CAST(date_trunc('month', logdate) AS DATE) AS logday FROM roster)
    SELECT usi, enrollment_responsible_lea_id AS lea_code, enrollment_attending_school_id AS school_code, enrollment_status,
           upper(rtrim(enrollment_status)) AS status_code, logday,
           CAST(CASE WHEN logday >= DATE '2000-01-01' OR logday = DATE '1995-01-01' THEN 2 ELSE 1 END AS INTEGER) AS run
    FROM months WHERE lower(rtrim(enrollment_status)) IN ('enrolled', 'withdrawn') AND lower(rtrim(enrollment_stage)) = 'stage 5'
      AND trim(coalesce(usi, '')) <> ''"""))
def landed_history(t: Tables) -> DataFrame:
    """A history of monthly snapshots landed in two runs: between them the source gets new months, and more rows of a month landed before."""
    source, folder = scratch(t.spark, "source"), scratch(t.spark, "history")
    rows = feed(t, "roster").withColumn("logdate", F.date_trunc("month", "logdate").cast("timestamp_ntz"))
    rows = stage(rows.withColumn("late", (F.col("logdate") >= F.lit(_CHANGE)) | ((F.col("logdate") == F.lit(dt.date(1995, 1, 1)))
                                                                                 & (fn.norm("enrollment_status") == "withdrawn"))))
    conf = {"roster_history": {"path": source}}
    columns = ["usi", "enrollment_responsible_lea_id", "enrollment_attending_school_id", "enrollment_status", "logdate", "status_code"]
    rows.where("NOT late").drop("late").write.parquet(source)
    land_days(t.spark, "roster_history", conf, folder, where=CERTIFIED, columns=columns)
    rows.where("late").drop("late").write.mode("append").parquet(source)
    second = land_days(t.spark, "roster_history", conf, folder, where=CERTIFIED, columns=columns)
    return second.history.select("usi", F.col("enrollment_responsible_lea_id").alias("lea_code"), F.col("enrollment_attending_school_id").alias("school_code"),
                                 "enrollment_status", "status_code", DAY, F.when(F.col(DAY).isin(second.days), 2).otherwise(1).alias("run"))


# Order lines as a feed of texts: some are no numbers of the size, no days, or blank.
_TEXTS = """SELECT CAST(o_orderkey AS STRING) AS line, CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 17 = 0 THEN '99999999999999999999'
                   ELSE CAST(o_custkey AS STRING) END AS id,
               CASE WHEN o_orderkey % 7 = 0 THEN ' ' WHEN o_orderkey % 19 = 0 THEN 'soon' WHEN o_orderkey % 23 = 0 THEN '2017-13-45' WHEN o_orderkey % 5 = 0 THEN '9/30/2002'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS born,
               CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderstatus END AS status FROM {orders}"""


@query("S1,F4,F5", f"""
    WITH x AS ({_TEXTS.format(orders='orders')})
    SELECT line, 'id' AS "column", id AS text, 'not an integer of this size' AS reason FROM x WHERE trim(id) <> '' AND TRY_CAST(id AS BIGINT) IS NULL
    UNION ALL SELECT line, 'born', born, 'not a date' FROM x WHERE trim(born) <> '' AND TRY_CAST(born AS DATE) IS NULL AND try_strptime(born, '%m/%d/%Y') IS NULL
    UNION ALL SELECT line, 'status', status, 'missing' FROM x WHERE status IS NULL
    UNION ALL SELECT NULL, 'good rows', CAST(count(*) AS STRING), '' FROM x WHERE status IS NOT NULL AND (trim(id) = '' OR TRY_CAST(id AS BIGINT) IS NOT NULL)
        AND (trim(born) = '' OR TRY_CAST(born AS DATE) IS NOT NULL OR try_strptime(born, '%m/%d/%Y') IS NOT NULL)""")
def rejected_cells(t: Tables) -> DataFrame:
    """The rejected cells of a feed of texts, and the number of good rows."""
    found = check(t.sql(_TEXTS), "line string, id bigint, born date, status string", required=["status"], most_rejected=0.5)
    cells = found.rejected.select(F.col("row.line").alias("line"), "column", "text", "reason")
    good = found.good.agg(F.count(F.lit(1)).cast("string").alias("text"))
    return cells.unionByName(good.select(F.lit(None).cast("string").alias("line"), F.lit("good rows").alias("column"), "text", F.lit("").alias("reason")))


# ---------------------------------------------------------------- reports

@query("Q1,Q2,Q3,Q4", """
    WITH l AS (SELECT l_orderkey, l_linestatus, l_returnflag, CASE WHEN l_returnflag = 'R' THEN l_returnflag END AS returned, l_discount, l_tax FROM lineitem),
    j AS (SELECT * FROM l JOIN orders ON l_orderkey = o_orderkey)
    SELECT 'repeated' AS rule, l_orderkey, count(*) AS n FROM l GROUP BY l_orderkey HAVING count(*) > 1
    UNION ALL SELECT 'status differs', l_orderkey, count(*) FROM j WHERE l_linestatus <> o_orderstatus GROUP BY l_orderkey
    UNION ALL SELECT 'flag or status differs', l_orderkey, count(*) FROM j WHERE l_linestatus <> o_orderstatus OR l_returnflag <> substr(o_orderpriority, 1, 1) GROUP BY l_orderkey
    UNION ALL SELECT 'no return', o_orderkey, count(*) FROM orders LEFT JOIN l ON l_orderkey = o_orderkey
              WHERE o_orderstatus = 'F' AND trim(coalesce(returned, '')) = '' GROUP BY o_orderkey
    UNION ALL SELECT 'discount over tax', l_orderkey, count(*) FROM l WHERE l_discount > l_tax AND l_returnflag = 'N' GROUP BY l_orderkey""")
def quality_report(t: Tables) -> DataFrame:
    """Five rules over lines and orders, each table read once."""
    lines = t.lineitem.select("l_orderkey", "l_linestatus", "l_returnflag", F.when(F.col("l_returnflag") == "R", F.col("l_returnflag")).alias("returned"), "l_discount", "l_tax")
    orders = t.orders.withColumn("first", F.substring("o_orderpriority", 1, 1))
    return dq_report(lines, orders, RuleSet(
        {"l_orderkey": "o_orderkey"}, "repeated",
        mismatch={"status differs": {"l_linestatus": "o_orderstatus"}, "flag or status differs": {"l_linestatus": "o_orderstatus", "l_returnflag": "first"}},
        missing={"no return": Missing("returned", "o_orderpriority", fn.equals("o_orderstatus", "f"))},
        violated={"discount over tax": (F.col("l_discount") > F.col("l_tax")) & fn.equals("l_returnflag", "N")}))


@query("O1,S10", with_feeds(["records"], """
    SELECT school_code, usi, stage5_entry_date, stage5_exit_date, CAST(row_number() OVER (ORDER BY school_code NULLS FIRST, usi NULLS FIRST,
           stage5_entry_date NULLS FIRST, stage5_exit_date NULLS FIRST) AS BIGINT) AS row_no FROM records"""))
def ordered_records(t: Tables) -> DataFrame:
    rows = feed(t, "records").select("school_code", "usi", "stage5_entry_date", "stage5_exit_date")
    return numbered(rows, ["school_code", "usi"])


@query("S5,D12,A2", with_feeds(["levels"], """
    SELECT usi, special_education_level AS max_sped_level FROM
      (SELECT *, row_number() OVER (PARTITION BY usi ORDER BY upper(rtrim(special_education_level)) DESC, special_education_level DESC) AS r
       FROM levels WHERE trim(coalesce(special_education_level, '')) <> '') x WHERE r = 1"""))
def levels_from_state(t: Tables) -> DataFrame:
    """Highest levels from yearly extracts: the closed years' state is made by a first run, the second reads it and the live year."""
    folder = scratch(t.spark, "levels")
    rows = stage(feed(t, "levels"), partition_by="school_year")
    years = sorted(r[0] for r in rows.select("school_year").distinct().collect())
    closed = {}
    for year in years[:-1]:
        closed[str(year)] = f"{folder}/extract-{year}"
        rows.where(F.col("school_year") == year).write.parquet(closed[str(year)])
    live = rows.where(F.col("school_year") == years[-1])
    levels_with_state(t.spark, closed, live, f"{folder}/state")
    return levels_with_state(t.spark, closed, live, f"{folder}/state")
