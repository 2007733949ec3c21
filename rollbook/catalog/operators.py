"""Generic operators on the given tables."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook import functions as fn
from rollbook import operators as op
from rollbook.catalog.registry import Tables, query
from rollbook.plans.recent import most_recent
from rollbook.sources import since, snapshot, union_years

MONEY = "decimal(12,2)"


# ---------------------------------------------------------------- scans and projections

@query("S1,S2,P1,P2,P9,P10", """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority AS priority, 'Stage 5' AS stage,
           CAST(NULL AS INTEGER) AS placeholder
    FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority ILIKE '%urgent%'""")
def conform_tagged(t: Tables) -> DataFrame:
    rows = t.orders.where(F.col("o_orderstatus").isin("F", "O") & fn.like_ci("o_orderpriority", "%URGENT%"))
    rows = op.conform(rows, {"order_id": "o_orderkey", "customer_id": "o_custkey", "priority": "o_orderpriority"})
    return op.tag(rows, stage="Stage 5", placeholder=None)


@query("S3", """
    SELECT event_id, user_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'""")
def snapshot_day(t: Tables) -> DataFrame:
    return snapshot(t.events, "ts", dt.date(2024, 1, 10), whole_day=True).select("event_id", "user_id", "event_type")


@query("S3", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = TIMESTAMP '1998-10-03 00:00:00'""")
def snapshot_midnight(t: Tables) -> DataFrame:
    return snapshot(t.orders, "o_orderdate", dt.date(1998, 10, 3)).select("o_orderkey", "o_custkey")


@query("S4", "SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-20'")
def since_day(t: Tables) -> DataFrame:
    return since(t.events, "ts", dt.date(2024, 1, 20)).select("event_id", "user_id")


@query("P3", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_universe(t: Tables) -> DataFrame:
    return op.distinct_of(t.lineitem, ["l_suppkey", "l_returnflag"])


@query("P4,F1,F2", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1' WHEN '5-LOW' THEN '9000'
           ELSE o_orderpriority END AS priority FROM orders""")
def recode_codes(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", fn.recode("o_orderpriority", {"1-URGENT": "1", "5-LOW": "9000"})
                           .alias("priority"))


@query("P5,P20,F3", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'YES' WHEN 'O' THEN 'NO' ELSE '' END AS flag,
           o_orderstatus = 'O' AS is_open FROM orders""")
def yes_no_flags(t: Tables) -> DataFrame:
    as_text = F.when(F.col("o_orderstatus") == "O", "false ").when(F.col("o_orderstatus") == "F", "True").otherwise("1")
    return t.orders.select("o_orderkey", fn.yes_no("o_orderstatus", ["f"], ["o "], other="").alias("flag"),
                           fn.is_false(as_text).alias("is_open"))


@query("P6,P11", """
    SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS hours,
           CASE WHEN sum(l_quantity) <= 40 THEN 'Level 1' WHEN sum(l_quantity) <= 90 THEN 'Level 2'
                WHEN sum(l_quantity) <= 150 THEN 'Level 3' ELSE 'Level 4' END AS level
    FROM lineitem GROUP BY l_orderkey""")
def hours_bands(t: Tables) -> DataFrame:
    total = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast(MONEY)).cast("decimal(18,2)").alias("hours"))
    return total.withColumn("level", fn.band("hours", [
        (0, 40, "Level 1"), (41, 90, "Level 2"), (91, 150, "Level 3"), (150, None, "Level 4")]))


@query("P12,P13", """
    SELECT l_orderkey, l_linenumber, l_partkey, 'active' AS state FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderdate <= TIMESTAMP '1998-06-15 12:00:00' AND l_shipdate >= TIMESTAMP '1998-06-15 12:00:00'
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, 'expired' FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_shipdate < TIMESTAMP '1995-06-15 00:00:00'""")
def active_and_expired(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    cols = ["l_orderkey", "l_linenumber", "l_partkey"]
    active = op.active_as_of(lines, "o_orderdate", "l_shipdate", fn.moment(dt.datetime(1998, 6, 15, 12)))
    expired = op.expired_as_of(lines, "l_shipdate", dt.datetime(1995, 6, 15, 12))
    return op.tag(active.select(*cols), state="active").unionByName(op.tag(expired.select(*cols), state="expired"))


@query("P7,P16,P17,P18,F13,F14", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_returnflag = 'R' THEN l_linestatus ELSE l_returnflag END AS filled,
           CAST(CASE WHEN trunc(net) < 0 THEN 0 ELSE net END AS DECIMAL(12,2)) AS net,
           CASE WHEN l_returnflag = 'N' THEN CAST(0 AS DECIMAL(12,2)) ELSE qty END AS qty,
           CASE WHEN l_returnflag = 'A' THEN l_linestatus ELSE '' END AS carried
    FROM (SELECT *, CAST(l_quantity AS DECIMAL(12,2)) AS qty,
                 CAST(CAST(l_quantity AS DECIMAL(12,2)) - CAST(l_linenumber * 5 AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS net
          FROM lineitem) x""")
def fill_and_clamp(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        F.when(F.col("l_returnflag") == "R", " ").otherwise(F.col("l_returnflag")).alias("gap"), "l_linestatus",
        F.col("l_quantity").cast(MONEY).alias("qty"),
        (F.col("l_quantity").cast(MONEY) - F.col("l_linenumber") * 5).cast(MONEY).alias("net"))
    rows = op.override(rows, fn.equals("l_returnflag", "n"), {"qty": 0})
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", fn.fill_blank("gap", "l_linestatus").alias("filled"),
                       fn.clamp_min("net").cast(MONEY).alias("net"), "qty",
                       fn.when_flag(fn.equals("l_returnflag", "A"), "l_linestatus").alias("carried"))


@query("F4,F5,F6,F8,F9,F10,F11,F12", """
    SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS us_text,
           CAST(o_orderdate + INTERVAL 1 DAY AS DATE) AS next_day,
           CAST(o_orderdate - INTERVAL 15 YEAR AS DATE) AS years_back,
           make_date(CAST(year(o_orderdate) AS INTEGER), 9, 30) AS cutoff,
           CAST(date_diff('year', o_orderdate, DATE '2002-01-01') AS INTEGER) AS year_steps,
           o_orderstatus || '-' || o_orderpriority AS joined, CAST(o_orderdate AS DATE) AS from_timed_text,
           CAST(o_orderdate AS DATE) AS from_digits
    FROM orders""")
def format_dates(t: Tables) -> DataFrame:
    day = fn.as_date("o_orderdate")
    text = fn.text_us("o_orderdate")
    return t.orders.select("o_orderkey", text.alias("us_text"), fn.shift_days(text, 1).alias("next_day"),
                           fn.years_before(day, 15).alias("years_back"),
                           F.make_date(F.year(day), F.lit(9), F.lit(30)).alias("cutoff"),
                           fn.year_diff(day, F.lit(dt.date(2002, 1, 1))).alias("year_steps"),
                           F.concat("o_orderstatus", F.lit("-"), "o_orderpriority").alias("joined"),
                           fn.as_date(F.concat(text, F.lit(" 00:00:00"))).alias("from_timed_text"),
                           fn.as_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("from_digits"))


# ---------------------------------------------------------------- joins

@query("J1,J2,J11", """
    SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus AS order_status, c_name AS customer, n_name AS nation,
           r_name AS region
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def star_enrich(t: Tables) -> DataFrame:
    nations = op.enrich(t.nation, [(t.region, {"n_regionkey": "r_regionkey"}, {"region": "r_name"})])
    people = op.enrich(t.customer, [(nations, {"c_nationkey": "n_nationkey"},
                                     {"nation": "n_name", "region": "region"})])
    orders = op.enrich(t.orders, [(people, {"o_custkey": "c_custkey"},
                                   {"customer": "c_name", "nation": "nation", "region": "region"})])
    rows = op.enrich(t.lineitem, [(orders, {"l_orderkey": "o_orderkey"},
                                   {"order_status": "o_orderstatus", "customer": "customer", "nation": "nation",
                                    "region": "region"})])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "order_status", "customer", "nation", "region")


@query("J11", """
    SELECT c_custkey, e.props AS value FROM customer LEFT JOIN
      (SELECT user_id, props FROM events WHERE event_type = 'signup') e ON user_id = c_custkey""")
def eav_lookup_enrich(t: Tables) -> DataFrame:
    return op.eav_lookup(t.customer.select("c_custkey"), t.events, "signup", {"c_custkey": "user_id"}, "value",
                         name_col="event_type", value_col="props")


@query("J3,P7,F12", """
    SELECT c_custkey, o_orderkey,
           CASE WHEN o_orderstatus = 'F' THEN o_orderstatus || o_orderpriority END AS shown,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END AS guarded
    FROM (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o RIGHT JOIN customer ON o_custkey = c_custkey""")
def profile_right_join(t: Tables) -> DataFrame:
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    rows = op.right_master(urgent, t.customer, {"c_custkey": "o_custkey"},
                           {c: c for c in ("o_orderkey", "o_orderstatus", "o_orderpriority")})
    flag = fn.equals("o_orderstatus", "F")
    return rows.select("c_custkey", "o_orderkey",
                       fn.when_flag(flag, F.concat("o_orderstatus", "o_orderpriority"), None).alias("shown"),
                       fn.when_flag(flag, "o_orderpriority").alias("guarded"))


@query("J4,J5", """
    SELECT c_custkey, 'without' AS kind FROM customer WHERE NOT EXISTS
      (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01 00:00:00')
    UNION ALL
    SELECT c_custkey, 'with' FROM customer WHERE c_custkey IN
      (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00')""")
def semi_and_anti(t: Tables) -> DataFrame:
    recent = t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    people = t.customer.select("c_custkey")
    keys = {"c_custkey": "o_custkey"}
    return op.tag(op.anti(people, recent, keys), kind="without").unionByName(
        op.tag(op.semi(people, recent, keys), kind="with"))


@query("J6", """
    SELECT n_nationkey, 'plain' AS list FROM nation WHERE n_nationkey NOT IN
      (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000)
    UNION ALL
    SELECT n_nationkey, 'with null' FROM nation WHERE n_nationkey NOT IN
      (SELECT CASE WHEN c_acctbal > 9500 THEN NULL ELSE c_nationkey END FROM customer WHERE c_acctbal > 9000)
    UNION ALL
    SELECT c_custkey, 'kept' FROM customer WHERE NOT (c_nationkey NOT IN
      (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000))""")
def null_aware_delete(t: Tables) -> DataFrame:
    rich = t.customer.where(F.col("c_acctbal") > 9000).select("c_nationkey", "c_acctbal")
    gaps = rich.select(F.when(F.col("c_acctbal") > 9500, None).otherwise(F.col("c_nationkey")).alias("c_nationkey"))
    nations = t.nation.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"))

    def missing(listed: DataFrame) -> DataFrame:
        return op.anti_null_aware(nations, listed, "n_nationkey", "c_nationkey")
    suppliers = t.supplier.where(F.col("s_acctbal") > 8000)
    kept = op.delete_not_in(t.customer, suppliers, "c_nationkey", "s_nationkey")
    return (op.tag(missing(rich), list="plain").unionByName(op.tag(missing(gaps), list="with null"))
            .unionByName(op.tag(kept.select(F.col("c_custkey").alias("n_nationkey")), list="kept")))


@query("J7", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN
      (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def remove_matching(t: Tables) -> DataFrame:
    returned = t.lineitem.where(F.col("l_returnflag") == "R")
    return op.remove_matching(t.orders.select("o_orderkey", "o_custkey"), returned, {"o_orderkey": "l_orderkey"})


@query("J8,T5", """
    SELECT c_custkey, c_name, coalesce(m.name, CAST(c_nationkey AS VARCHAR)) AS nation
    FROM customer LEFT JOIN (SELECT n_regionkey, min(n_name) AS name FROM nation WHERE n_regionkey < 3
                             GROUP BY n_regionkey) m ON c_nationkey = n_regionkey""")
def update_from_lookup(t: Tables) -> DataFrame:
    people = t.customer.select("c_custkey", "c_name", "c_nationkey",
                               F.col("c_nationkey").cast("string").alias("nation"))
    listed = t.nation.where(F.col("n_regionkey") < 3)
    return op.update_from(people, listed, {"c_nationkey": "n_regionkey"}, {"nation": "n_name"}).drop("c_nationkey")


@query("J10,P8", """
    SELECT c_custkey, n_name AS matched FROM
      (SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS k
       FROM customer) c
    LEFT JOIN (SELECT n_name, CASE WHEN n_nationkey = 4 THEN NULL WHEN n_nationkey = 6 THEN ' '
                                   ELSE CAST(n_nationkey AS VARCHAR) END AS k FROM nation) n
    ON coalesce(trim(c.k), '') = coalesce(trim(n.k), '')""")
def blank_safe_join(t: Tables) -> DataFrame:
    key = F.col("c_nationkey")
    left = t.customer.select("c_custkey", F.when(key % 3 == 0, "").when(key % 3 == 2, key.cast("string")).alias("k"))
    other = F.col("n_nationkey")
    right = t.nation.select("n_name", F.when(other == 6, " ").when(other != 4, other.cast("string")).alias("k"))
    return op.join_blank_safe(left, right, ["k"], {"matched": "n_name"}).select("c_custkey", "matched")


@query("W1,J9,T7", """
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC) AS r
               FROM events WHERE event_type = 'purchase'),
         e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC) AS r
               FROM events WHERE event_type = 'error')
    SELECT p.user_id, p.event_id, coalesce(CAST(e.ts AS DATE) > CAST(p.ts AS DATE) OR
           (CAST(e.ts AS DATE) = CAST(p.ts AS DATE) AND e.event_id > p.event_id), FALSE) AS cancelled
    FROM p LEFT JOIN e ON e.user_id = p.user_id AND e.r = 1 WHERE p.r = 1""")
def cancelled_by_later(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", "event_id", fn.as_date("ts").alias("day"))
    current = op.latest(rows.where(F.col("event_type") == "purchase").drop("event_type"), ["user_id"],
                        ["day", "event_id"])
    negative = rows.where(F.col("event_type") == "error")
    return op.cancelled_by(current, negative, ["user_id"], [("day", "day"), ("event_id", "event_id")]).drop("day")


@query("J12", """
    SELECT o_orderkey, n_name AS nation FROM orders LEFT JOIN nation
    ON TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) = n_nationkey""")
def cast_key_join(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).try_cast("int").alias("k"))
    return op.enrich(rows, [(t.nation, {"k": "n_nationkey"}, {"nation": "n_name"})]).drop("k")


@query("J13,F9,D18", """
    SELECT o_orderkey, l_linenumber, l_partkey FROM
      (SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY
                                    ELSE o_orderdate END AS DATE) AS d FROM orders) o
    JOIN lineitem ON l_orderkey = o_orderkey AND CAST(l_shipdate AS DATE) = d""")
def shift_and_match_dates(t: Tables) -> DataFrame:
    moved = t.orders.select("o_orderkey", F.when(fn.equals("o_orderstatus", "f"), fn.shift_days("o_orderdate", 1))
                            .otherwise(fn.as_date("o_orderdate")).alias("day"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", fn.as_date("l_shipdate").alias("day"))
    return op.enrich(moved, [(lines, {"o_orderkey": "l_orderkey", "day": "day"},
                              {"l_linenumber": "l_linenumber", "l_partkey": "l_partkey"})], how="inner").drop("day")


@query("J14,T7", """
    SELECT l_orderkey, l_linenumber, l_partkey,
           bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS order_returned,
           bool_or(l_linestatus = 'F') OVER (PARTITION BY l_orderkey, l_returnflag) AS finished
    FROM lineitem""")
def flag_propagation(t: Tables) -> DataFrame:
    rows = op.propagate_flag(t.lineitem, ["l_orderkey"], {"finished": fn.equals("l_linestatus", "F")},
                             blank_safe=["l_returnflag"],
                             over_keys={"order_returned": fn.equals("l_returnflag", "R")})
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "order_returned", "finished")


# ---------------------------------------------------------------- aggregates and picks

@query("A1", """
    SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(10,2)) * (CASE WHEN l_returnflag = 'A' THEN 1 ELSE 60 END)
             * (CASE l_linenumber WHEN 1 THEN 180 WHEN 2 THEN 36 WHEN 3 THEN 9 WHEN 6 THEN 1 END)
             * (CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END)) / 36 AS DECIMAL(18,6)) AS minutes
    FROM lineitem GROUP BY l_orderkey""")
def weekly_minutes(t: Tables) -> DataFrame:
    rows = t.lineitem.select(
        "l_orderkey", F.col("l_quantity").cast("string").alias("time_spent"),
        F.when(F.col("l_returnflag") == "A", "1").otherwise("2").alias("time_units"),
        F.col("l_linenumber").cast("string").alias("time_period"),
        F.when(F.col("l_linestatus") == "O", " ").otherwise("2").alias("num_sessions"))
    return op.weekly_minutes(rows, ["l_orderkey"])


@query("A2", """
    SELECT o_custkey, o_orderdate, CAST(count(*) AS BIGINT) AS n FROM orders
    GROUP BY o_custkey, o_orderdate HAVING count(*) > 1""")
def duplicate_keys(t: Tables) -> DataFrame:
    return op.duplicates(t.orders, ["o_custkey", "o_orderdate"])


@query("A3", """
    SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey HAVING count(*) > 1""")
def multi_flag_keys(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.when(F.col("o_orderstatus") == "O", "Yes").otherwise("No").alias("flag"))
    return op.multi_flag_keys(rows, "o_custkey", "flag")


@query("A4,S5,A7,D12", """
    SELECT o_custkey AS usi, max_by(level, (upper(level), level)) AS max_sped_level FROM
      (SELECT o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS level FROM orders
       WHERE o_orderpriority <> '5-LOW') x GROUP BY o_custkey""")
def max_level_history(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("usi"), F.year("o_orderdate").alias("year"),
                           F.when(F.col("o_orderpriority") == "5-LOW", " ").when(F.col("o_orderkey") % 2 == 0, F.lower("o_orderpriority"))
                           .otherwise(F.col("o_orderpriority")).alias("special_education_level"))
    years = [rows.where(F.col("year") < 1996), rows.where(F.col("year") >= 1996)]  # every year in one of two extracts
    return op.max_level(union_years(years, ["usi", "special_education_level"]))


@query("A5,A6", """
    SELECT user_id, min(CASE WHEN event_type = 'purchase' THEN props END) AS purchase,
           min(CASE WHEN event_type = 'error' THEN props END) AS error,
           min(CASE WHEN event_type = 'click' THEN props END) AS click,
           min(CASE WHEN event_type = 'absent' THEN props END) AS absent
    FROM events GROUP BY user_id""")
def pivot_min(t: Tables) -> DataFrame:
    return op.pivot_fields(t.events, ["user_id"], "event_type", "props", ["purchase", "error", "click", "absent"])


@query("W2,D16,O3", """
    SELECT o_custkey, o_orderkey, o_orderdate FROM
      (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders) x WHERE r = 1""")
def latest_with_ties(t: Tables) -> DataFrame:
    return op.latest(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate"],
                     ties=True)


@query("J5,W2,D16", """
    SELECT o_custkey, o_orderdate, o_orderpriority FROM
      (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderpriority DESC) AS r
       FROM (SELECT DISTINCT o_custkey, o_orderdate, o_orderpriority FROM orders WHERE o_custkey IN
             (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) y) x WHERE r = 1""")
def latest_in_subset(t: Tables) -> DataFrame:
    rows = op.semi(t.orders, t.customer.where(F.col("c_mktsegment") == "BUILDING"), {"o_custkey": "c_custkey"})
    return op.latest(rows.select("o_custkey", "o_orderdate", "o_orderpriority").distinct(), ["o_custkey"],
                     [fn.order_date("o_orderdate"), "o_orderpriority"], ties=True)


@query("D16,W2,J5", """
    SELECT o_custkey, d AS order_day FROM
      (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY d DESC) AS r FROM
        (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE EXISTS
          (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'MACHINERY')) y) x WHERE r = 1""")
def most_recent_in_subset(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", fn.as_date("o_orderdate").alias("order_day"))
    machinery = t.customer.where(F.col("c_mktsegment") == "MACHINERY")
    return most_recent(rows, ["o_custkey"], ["order_day"], subset=(machinery, {"o_custkey": "c_custkey"}))


@query("W3,D13", """
    SELECT l_orderkey, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY l_orderkey""")
def best_flag_per_key(t: Tables) -> DataFrame:
    rows = op.distinct_of(t.lineitem, ["l_orderkey", "l_returnflag"])
    return op.preferred(rows, ["l_orderkey"], ["l_returnflag"])


@query("A2,J1,P8,W3,D2", """
    SELECT user_id, event_type, event_id, value FROM
      (SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY value DESC) AS r FROM
        (SELECT *, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events) d
       WHERE n > 1 AND (value > 20 OR event_type <> 'error')) x WHERE r = 1""")
def dedupe_preferred(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", "event_id", "value")
    return op.dedupe_preferred(rows, ["user_id", "event_type"], (F.col("value") > 20) | (F.col("event_type") != "error"), ["value"])


@query("W4,W5,D15", """
    WITH top AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY l_suppkey ORDER BY m DESC) AS r FROM
                   (SELECT DISTINCT l_suppkey, l_orderkey, l_returnflag, EXTRACT(YEAR FROM l_shipdate) AS m
                    FROM lineitem) d) x WHERE r = 1),
         seen AS (SELECT *, bool_or(l_returnflag = 'R' AND l_orderkey % 50 = 0) OVER (PARTITION BY l_suppkey) AS any_pref,
                  row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_returnflag DESC) AS rn FROM top)
    SELECT l_suppkey, l_orderkey, l_returnflag FROM seen
    WHERE (l_returnflag = 'R' AND l_orderkey % 50 = 0) OR (NOT any_pref AND rn = 1)""")
def tie_cascade(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_returnflag", F.year("l_shipdate").alias("m")).distinct()
    liked = (F.col("l_returnflag") == "R") & (F.col("l_orderkey") % 50 == 0)
    return op.resolve_ties(rows, ["l_suppkey"], ["m"], liked, ["l_orderkey"]).drop("m")


@query("A3,D23", """
    WITH k AS (SELECT o_custkey FROM orders GROUP BY o_custkey
               HAVING sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) > 1
                  AND sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) > 0)
    SELECT o_orderkey, CASE WHEN o_custkey IN (SELECT o_custkey FROM k) AND o_orderstatus <> 'P' THEN 'NO'
                            WHEN o_orderstatus = 'O' THEN 'YES' ELSE '' END AS indicator FROM orders""")
def single_responsible(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                           F.when(F.col("o_orderstatus") == "O", "YES").otherwise("").alias("indicator"))
    kept = op.single_responsible(rows, "o_custkey", "indicator", F.col("o_orderstatus") == "P")
    return kept.select("o_orderkey", "indicator")


# ---------------------------------------------------------------- sets and quality

@query("U1,U2,U3,P10,D17", """
    SELECT DISTINCT c_custkey, c_mktsegment FROM customer
    WHERE c_mktsegment LIKE 'B%' OR c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def cohort_union(t: Tables) -> DataFrame:
    people = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    first = people.where(fn.like_ci("c_mktsegment", "b%"))
    second = op.semi(people, t.nation.where(F.col("n_regionkey") == 1), {"c_nationkey": "n_nationkey"})
    return op.union_distinct(first, second).drop("c_nationkey")


@query("U4", "SELECT DISTINCT n_name FROM nation UNION SELECT 'NATION_X'")
def literal_row(t: Tables) -> DataFrame:
    return op.with_literal_row(t.nation.select("n_name"), n_name="NATION_X")


@query("Q1", """
    SELECT o_orderkey, o_custkey, o_orderdate FROM
      (SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS n FROM orders) x WHERE n > 1""")
def dq_duplicates(t: Tables) -> DataFrame:
    return op.dq_duplicates(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey", "o_orderdate"])


@query("Q2", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus, o_orderstatus AS record_l_linestatus
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus <> o_orderstatus""")
def dq_mismatch(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus")
    return op.dq_mismatch(lines, t.orders, {"l_orderkey": "o_orderkey"}, {"l_linestatus": "o_orderstatus"})


@query("Q3", """
    SELECT o_orderkey, o_orderpriority FROM orders LEFT JOIN
      (SELECT DISTINCT l_orderkey, 'x' AS mark FROM lineitem WHERE l_returnflag = 'R') l ON l_orderkey = o_orderkey
    WHERE mark IS NULL AND o_orderstatus = 'F'""")
def dq_missing(t: Tables) -> DataFrame:
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey", "l_returnflag").distinct()
    rows = op.dq_missing(returned, t.orders, {"o_orderkey": "l_orderkey"}, "l_returnflag", "o_orderpriority",
                         fn.equals("o_orderstatus", "f"))
    return rows.select("o_orderkey", "o_orderpriority")


@query("Q4", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount > l_tax AND l_returnflag = 'N'")
def dq_rule(t: Tables) -> DataFrame:
    bad = op.dq_rule(t.lineitem, (F.col("l_discount") > F.col("l_tax")) & fn.equals("l_returnflag", "N"))
    return bad.select("l_orderkey", "l_linenumber", "l_partkey")
