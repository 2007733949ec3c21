"""Rules in one pass, and plans that read and shuffle an input once."""
from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from rollbook import operators as op
from rollbook.catalog import QUERIES, Tables
from rollbook.catalog import domain as dm
from rollbook.functions import equals
from rollbook.operators.audit import Missing, RuleSet, dq_report
from rollbook.plans import enrollments as en
from rollbook.plans import recent as rc
from rollbook.plans import sped as sp
from rollbook.sources import stage
from rollbook.sources.tables import stage_bucketed

FOLDER = "/root/testdata/sf0.001"
MINE, THEIRS = "k string, d int, a string, b string, v string", "rk string, rd int, ra string, rb string, s string, rv string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def static(spark):
    """Plans as they are made, without broadcasts."""
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(3))
def test_report_counts_what_each_rule_returns(frame, seed):
    rng = random.Random(seed)
    text = lambda: rng.choice(["x", "X ", "y", "", " ", None])
    key = lambda: rng.choice(["a", "b", "c", "d", None])
    result = frame(MINE, [(key(), rng.choice([1, 2, None]), text(), text(), text()) for _ in range(60)])
    record = frame(THEIRS, [(key(), rng.choice([1, 2, 3, None]), text(), text(), rng.choice(["on", "ON ", "off", None]), text()) for _ in range(60)])
    keys = {"k": "rk", "d": "rd"}
    active, broken = equals("s", "on"), equals("b", "y") & (F.col("d") > 1)
    rules = RuleSet(keys, "twice", {"both": {"a": "ra", "b": "rb"}, "first": {"a": "ra"}}, {"gone": Missing("v", "rv", active)}, {"broken": broken})
    back = {"rk": "k", "rd": "d"}
    expected = {
        "twice": op.dq_duplicates(result, ["k", "d"]), "both": op.dq_mismatch(result, record, keys, {"a": "ra", "b": "rb"}),
        "first": op.dq_mismatch(result, record, keys, {"a": "ra"}), "broken": op.dq_rule(result, broken),
        "gone": op.dq_missing(result, record, back, "v", "rv", active).withColumnsRenamed(back)}
    wanted = sorted(((name, r["k"], r["d"], r["count"]) for name, df in expected.items() for r in df.groupBy("k", "d").count().collect()), key=str)
    assert sorted((tuple(r) for r in dq_report(result, record, rules).select("rule", "k", "d", "n").collect()), key=str) == wanted


@pytest.mark.parametrize("seed", range(2))
def test_report_on_nested_lists_of_columns_multiplies_no_rows(frame, static, seed):
    """Rules on (a, b, v), (a, b) twice and a: each grouping is of the one before. Only the finished lines are exploded."""
    rng = random.Random(seed)
    one = lambda *values: rng.choice(values)
    result = frame(MINE, [(one("a", "b", None), 1, one("x", "X ", None), one("y", "", "z"), one("u", "w")) for _ in range(50)])
    record = frame(THEIRS, [(one("a", "b", None), 1, one("x", "y", ""), one("y", " "), "on", one("u", "W")) for _ in range(50)])
    lists = {"all": {"a": "ra", "b": "rb", "v": "rv"}, "two": {"b": "rb", "a": "ra"}, "again": {"a": "ra", "b": "rb"}, "one": {"a": "ra"}}
    report = dq_report(result, record, RuleSet({"k": "rk"}, "twice", lists))
    found = {tuple(r) for r in report.where("rule <> 'twice'").select("rule", "k", "n").collect()}
    assert found == {(name, r["k"], r["count"]) for name, pairs in lists.items()
                     for r in op.dq_mismatch(result, record, {"k": "rk"}, pairs).groupBy("k").count().collect()}
    assert plan(report).count("Generate explode") == 1


def test_report_on_empty_tables(frame):
    rules = RuleSet({"k": "rk"}, "twice", {"both": {"a": "ra"}}, {"gone": Missing("v", "rv", F.lit(True))})
    none, one = frame(MINE, []), frame(THEIRS, [("a", 1, "x", "y", "on", "z")])
    assert dq_report(none, frame(THEIRS, []), rules).collect() == []
    assert values(dq_report(none, one, rules), "rule", "k", "n") == [("gone", "a", 1)]


def test_report_reads_each_table_once(spark, static):
    text = plan(QUERIES["quality_report"].run(Tables(spark, FOLDER)))
    assert text.count("/lineitem.parquet") == 1 and text.count("/orders.parquet") == 1
    assert "Join" not in text and "partial_sum" in text


def scans(df, name):
    return plan(df).count(f"/{name}.parquet")


def test_the_roster_is_read_once(spark, static):
    """``certified`` and the recent universe are staged: no branch reads their source again."""
    t, seen = Tables(spark, FOLDER), []

    def cut(df):
        seen.append(scans(df, "orders"))
        return stage(df)
    rows = en.build_enrollments(dm.feed(t, "roster"), dm.feed(t, "audit"), cut=cut)
    assert seen == [1] and scans(rows, "orders") == 0
    recent = rc.most_recent_enrollment(dm.feed(t, "roster"), dm.feed(t, "degree_schools").select(F.col("school_id").alias("usi")), dt.date(1996, 8, 1), cut=cut)
    assert seen == [1, 1] and scans(recent, "orders") == 0


def test_tie_cascade_reads_its_input_twice(spark, static):
    text = plan(QUERIES["tie_cascade"].run(Tables(spark, FOLDER)))
    assert text.count(".parquet") == 2 and "ReusedExchange" in text


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


def test_bucketed_stages_save_exchanges(spark, static):
    """Exchanges of the current special-education table, the writing of its stages included."""
    t = Tables(spark, FOLDER)
    names = ["sped_enrollments", "sped_students", "sped_events", "amendments", "services", "service_types", "sped_schools", "categories", "leas", "race",
             "disabilities", "custom", "env_map", "errors"]
    feeds = [stage(dm.feed(t, n)) for n in names]

    def run(deal):
        counts = []

        def dealt(df, keys):
            counts.append(shuffles(df.repartition(4, *keys)) if deal is stage_bucketed else shuffles(df))
            return deal(df, keys)

        def cut(df):
            counts.append(shuffles(df))
            return stage(df)
        rows = sp.sped_current(*feeds, as_of=dm.AS_OF, cut=cut, deal=dealt)
        counts.append(shuffles(rows))
        return sum(counts), rows
    plain, before = run(lambda df, keys: stage(df))
    bucketed, after = run(stage_bucketed)
    print(plain, bucketed)
    assert bucketed < plain
    assert sorted(map(str, before.collect())) == sorted(map(str, after.collect()))


def test_bucketed_stage(spark, frame, static):
    left = stage_bucketed(frame("k string, d int, v int", [("a", 1, 1), ("a", 1, 2), ("b", None, 3), (None, 1, 4)]), ["k", "d"], 4)
    assert values(left, "v") == [(1,), (2,), (3,), (4,)]
    grouped = left.groupBy("k", "d").agg(F.sum("v").alias("s"))
    joined = op.enrich(left, [(grouped, ["k", "d"], {"s": "s"})], colocated=True)
    assert shuffles(joined) == 0 and values(joined, "v", "s") == [(1, 3), (2, 3), (3, None), (4, None)]
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("stage_")]


def test_attributes_by_one_join_repeat_rows_as_one_join_each_would(frame):
    rows = frame("k string, x int", [("a", 1), ("b", 2), ("c", 3), (None, 4)])
    eav = frame("key string, name string, value string", [("a", "one", "1"), ("a", "one", "1"), ("a", "one", None), ("a", "two", "2"), ("a", "two", "3"),
                                                          ("b", "two", None), ("b", "other", "9"), (None, "one", "0"), ("c", "other", "9")])
    got = op.eav_columns(rows, eav, {"first": "one", "second": "two"}, {"k": "key"})
    each = op.eav_lookup(op.eav_lookup(rows, eav, "one", {"k": "key"}, "first"), eav, "two", {"k": "key"}, "second")
    assert values(got, "k", "x", "first", "second") == values(each, "k", "x", "first", "second") and got.count() == 9


def test_cohort_report_takes_distinct_rows_once(spark, static):
    """The report has the exchanges of the cohort table itself: equal rows are put together once, on the report's columns."""
    t = Tables(spark, FOLDER)
    table = dm.co.cohort_data(*[dm.feed(t, n) for n in dm._COHORT_FEEDS])
    assert shuffles(QUERIES["cohort_report"].run(t)) == shuffles(table)
