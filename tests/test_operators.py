import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import values
from rollbook import operators as op
from rollbook.functions import equals

ORDERED = "k string, d int, i int, v string"


def rows(seed, n=400):
    pick = random.Random(seed)
    # one key holds about a third of the rows
    keys = ["hot"] * 4 + [f"k{i}" for i in range(7)] + [None]
    return [(pick.choice(keys), pick.choice([None, 1, 2, 3]), pick.choice([None, 1, 2]), pick.choice("abc"))
            for _ in range(n)]


def low(x):
    return (x is not None, x if x is not None else 0)


def test_latest_one_winner_per_key_whatever_the_row_order(frame):
    data = rows(1)
    expected = {}
    for r in data:
        rank = (low(r[1]), low(r[2]), r[3])
        if r[0] not in expected or rank > expected[r[0]][0]:
            expected[r[0]] = (rank, r)
    for copy in (data, data[::-1]):
        got = op.latest(frame(ORDERED, copy).repartition(3), ["k"], ["d", "i"])
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(str(r) for _, r in expected.values())


def test_latest_with_ties_matches_brute_force(frame):
    data = rows(2)
    best = {}
    for r in data:
        best[r[0]] = max(best.get(r[0], (low(None), low(None))), (low(r[1]), low(r[2])))
    expected = sorted(str(r) for r in data if (low(r[1]), low(r[2])) == best[r[0]])
    got = op.latest(frame(ORDERED, data), ["k"], ["d", "i"], ties=True)
    assert sorted(str(tuple(r)) for r in got.collect()) == expected


def test_resolve_ties_cascade(frame):
    df = frame("usi string, d int, school string, pref boolean", [
        ("one", 5, "300", False), ("one", 4, "999", True),           # single top row, no tie
        ("two", 5, "300", True), ("two", 5, "301", True), ("two", 5, "900", False),  # preferred ones stay, all of them
        ("three", 5, "300", False), ("three", 5, "301", None),       # no preferred one: greatest code
        (None, None, "7", False)])
    got = op.resolve_ties(df, ["usi"], ["d"], F.col("pref"), ["school"])
    assert values(got, "usi", "school") == [(None, "7"), ("one", "300"), ("three", "301"), ("two", "300"), ("two", "301")]


def test_dedupe_preferred(frame):
    df = frame("usi string, lea string, new string, lang string", [
        ("1", "1", "Y", "spa"), ("1", "1", "Y", "amh"), ("1", "1", "", ""),
        ("2", "1", "Y", "spa"), ("3", "1", "", ""), ("3", "1", None, None), (None, "1", "Y", "x"), (None, "1", "Y", "y")])
    carries = equals("new", "y") | ~equals("lang", "")
    got = op.dedupe_preferred(df, ["usi", "lea"], carries, ["new", "lang"])
    assert values(got, "usi", "lang") == [("1", "spa")]


def test_anti_and_semi_split_the_input(frame):
    left = frame("k string, v int", [("a", 1), ("b", 2), (None, 3), ("a", 4)])
    right = frame("k string", [("a",), ("a",), (None,)])
    assert values(op.semi(left, right, ["k"]), "v") == [(1,), (4,)]
    assert values(op.anti(left, right, ["k"]), "v") == [(2,), (3,)]
    assert values(op.remove_matching(left, right, ["k"]), "v") == [(2,), (3,)]


def test_delete_not_in_follows_three_valued_logic(frame):
    df = frame("k string", [("a",), ("b",), (None,)])
    plain, gap, empty = (frame("x string", r) for r in ([("a",)], [("a",), (None,)], []))
    assert values(op.anti_null_aware(df, plain, "k", "x"), "k") == [("b",)]
    assert values(op.delete_not_in(df, plain, "k", "x"), "k") == [(None,), ("a",)]
    assert op.anti_null_aware(df, gap, "k", "x").count() == 0
    assert op.delete_not_in(df, gap, "k", "x").count() == 3
    assert op.anti_null_aware(df, empty, "k", "x").count() == 3
    assert op.delete_not_in(df, empty, "k", "x").count() == 0


def test_update_from_takes_the_least_of_several(frame):
    df = frame("k string, v string", [("a", "old"), ("b", "old"), (None, "old")])
    src = frame("s string, w string", [("a", "2"), ("a", "1"), (None, "9")])
    assert values(op.update_from(df, src, {"k": "s"}, {"v": "w"}), "k", "v") == [(None, "old"), ("a", "1"), ("b", "old")]


def test_update_from_may_set_null(frame):
    df = frame("k string, v string", [("a", "old")])
    assert values(op.update_from(df, frame("k string, w string", [("a", None)]), ["k"], {"v": "w"}), "v") == [(None,)]


def test_update_from_never_mixes_source_rows(frame):
    df = frame("k string", [("a",), ("b",), ("c",)])
    src = frame("k string, v string, w string", [("a", "2", "x"), ("a", "1", "y"), ("b", None, "x"), ("b", "5", None)])
    assert values(op.update_from(df, src, ["k"], {"v": "v", "w": "w"}), "k", "v", "w") == [
        ("a", "1", "y"), ("b", "5", None), ("c", None, None)]


def test_blank_safe_join_treats_null_as_blank(frame):
    left = frame("a string, b string, v int", [("x", None, 1), ("X ", "", 2), ("x", "q", 3)])
    right = frame("a string, b string, w string", [("x", " ", "hit")])
    got = op.join_blank_safe(left, right, ["a", "b"], {"w": "w"})
    assert values(got, "v", "w") == [(1, "hit"), (2, "hit"), (3, None)]


def test_apply_negations_and_its_reach(frame):
    current = frame("s string, d string, day int, made int, id int",
                    [("1", "A", 5, 1, 10), ("1", "B", 9, 1, 11), ("2", "A", 5, 1, 12), ("3", "A", 5, None, 13)])
    negative = frame("s string, d string, day int, made int, id int", [
        ("1", "A", 4, 9, 99), ("1", "A", 5, 1, 20), ("2", "A", 5, 1, 2), ("3", "A", 5, 7, 99)])
    order = [("day", "day"), ("made", "made"), ("id", "id")]
    got = op.apply_negations(current, negative, ["s", "d"], order, ["id", "day"])
    assert values(got, "s", "d", "id") == [("1", "A", None), ("1", "B", 11), ("2", "A", 12), ("3", "A", 13)]
    wide = op.apply_negations(current, negative, ["s", "d"], order, ["id"], cancel_keys=["s"])
    assert values(wide, "s", "d", "id") == [("1", "A", None), ("1", "B", None), ("2", "A", 12), ("3", "A", 13)]


def test_propagate_flag_keys(frame):
    df = frame("usi string, code string, v int, f boolean, g boolean", [
        ("1", None, 1, True, False), ("1", "", 2, False, True), ("1", "x", 3, False, False),
        (None, "x", 4, True, True), ("2", "x", 5, None, None)])
    got = op.propagate_flag(df, ["usi"], {"f": F.col("f")}, blank_safe=["code"], over_keys={"g": F.col("g")})
    assert values(got, "v", "f", "g") == [(1, True, True), (2, True, True), (3, False, True), (4, False, False),
                                          (5, False, False)]


def test_single_responsible(frame):
    df = frame("usi string, ind string, detail string", [
        ("1", "YES", "Currently Enrolled"), ("1", "YES", "No Transfer"), ("1", "", "x"),
        ("2", "YES", "No Transfer"), ("2", "YES", "Other"),
        ("3", "YES", "No Transfer"), ("3", "", "Currently Enrolled")])
    got = op.single_responsible(df, "usi", "ind", equals("detail", "Currently Enrolled"))
    assert values(got, "usi", "detail", "ind") == [
        ("1", "Currently Enrolled", "YES"), ("1", "No Transfer", "NO"), ("1", "x", "NO"),
        ("2", "No Transfer", "YES"), ("2", "Other", "YES"), ("3", "Currently Enrolled", ""), ("3", "No Transfer", "YES")]


def test_weekly_minutes(frame):
    ddl = "k string, time_spent string, time_units string, time_period string, num_sessions string"
    df = frame(ddl, [("a", "30", "1", "1", ""), ("a", "1", "2", "2", "2"), ("b", "10", "1", "3", None),
                     ("b", "7", "1", "6", "1"), ("c", " ", "1", "1", "1"), ("d", "5", "1", "4", "1")])
    got = {r.k: r.minutes for r in op.weekly_minutes(df, ["k"]).collect()}
    assert got == {"a": Decimal("270.000000"), "b": Decimal("2.694444"), "c": Decimal("0.000000"), "d": None}


def test_pivot_keeps_keys_without_listed_labels(frame):
    df = frame("d string, b string, l string, v string", [
        ("1", "x", "Alpha", "2"), ("1", "x", "alpha ", "1"), ("1", "x", "Beta", None), ("2", "y", "Other", "9"),
        ("3", "z", None, "9")])
    got = op.pivot_fields(df, ["d", "b"], "l", "v", ["Alpha", "Beta"])
    assert values(got, "d", "Alpha", "Beta") == [("1", "1", None), ("2", None, None), ("3", None, None)]


def test_duplicates_and_flag_counts(frame):
    df = frame("k string, f string", [("a", "YES"), ("a", "yes "), ("b", "YES"), ("b", "NO"), (None, "YES"), (None, "YES")])
    assert values(op.duplicates(df, ["k"]), "k", "n") == [(None, 2), ("a", 2), ("b", 2)]
    assert values(op.multi_flag_keys(df, "k", "f"), "k") == [(None,), ("a",)]
    assert op.dq_duplicates(df, ["k"]).count() == 4


def test_override_sees_old_values(frame):
    df = frame("a string, n int", [("no", 5), ("yes", 6)])
    got = op.override(df, equals("a", "NO"), {"a": "done", "n": F.col("n") + 1})
    assert values(got, "a", "n") == [("done", 6), ("yes", 6)]


def test_overage_by_map_and_by_frame(frame):
    df = frame("grade string, dob date", [("09", dt.date(2002, 9, 30)), ("09", dt.date(2002, 10, 1)),
                                          ("10", dt.date(2001, 1, 1)), ("08", dt.date(1990, 1, 1)), ("09", None)])
    cut = {"09": dt.date(2002, 9, 30), "10": dt.date(2001, 9, 30)}
    expected = [True, False, True, False, False]
    assert [r.overage for r in op.overage(df, "grade", "dob", cut).collect()] == expected
    table = frame("grade string, cutoff date", list(cut.items()))
    got = {(r.grade, r.dob): r.overage for r in op.overage(df, "grade", "dob", table).collect()}
    assert [got[(r.grade, r.dob)] for r in df.collect()] == expected


def test_sets(frame):
    a, b = frame("x int, y int", [(1, 2), (1, 2)]), frame("y int, x int", [(2, 1), (3, 1)])
    assert values(op.merge_sources(a, b), "x", "y") == [(1, 2), (1, 3)]
    assert values(op.with_literal_row(frame("lea_code string", [("1",), ("7",), ("7",)]), lea_code="1"), "lea_code") == [
        ("1",), ("7",)]


def test_quality_reports(frame):
    result = frame("usi string, lea string, level string", [("1", "A", "Level 1"), ("2", "A", None), ("3", "A", "")])
    record = frame("usi string, lea string, level string, active string",
                   [("1", "A", "level 1 ", "1"), ("2", "A", "Level 2", "1"), ("3", "A", None, "1"), ("4", "A", "Level 3", "1"),
                    ("5", "A", "Level 3", "0")])
    assert values(op.dq_mismatch(result, record, ["usi", "lea"], {"level": "level"}), "usi") == [("2",)]
    missing = op.dq_missing(result, record, ["usi", "lea"], "level", "level", equals("active", "1"))
    assert values(missing, "usi") == [("2",), ("4",)]
    assert values(op.dq_rule(result, equals("level", "")), "usi") == [("2",), ("3",)]


def test_right_master_and_eav(frame):
    master = frame("code string", [("a",), ("b",)])
    side = frame("building string, v string", [("a", "1"), ("c", "2")])
    assert values(op.right_master(side, master, {"code": "building"}, {"v": "v"}), "code", "v") == [("a", "1"), ("b", None)]
    eav = frame("building string, name string, value string", [("a", "Aide", "yes"), ("a", "Other", "no")])
    assert values(op.eav_lookup(master, eav, "Aide", {"code": "building"}, "aide"), "code", "aide") == [
        ("a", "yes"), ("b", None)]


def test_no_window_and_no_nested_loop_in_pick_plans(frame):
    df = frame(ORDERED, rows(3))
    for got in (op.latest(df, ["k"], ["d"]), op.latest(df, ["k"], ["d"], ties=True),
                op.propagate_flag(df, ["k"], {"f": F.col("d") == 1}),
                op.delete_not_in(df, df.select("v"), "v"), op.single_responsible(df, "k", "v", F.col("d") == 1)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
