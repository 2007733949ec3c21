import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from rollbook import functions as fn


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_blank_null_case_and_trailing_spaces_are_equal(frame):
    df = frame("c string", [("",), ("  ",), (None,), ("Yes",), ("yes ",)])
    assert one(df, fn.is_blank("c")) == [True, True, True, False, False]
    assert one(df, fn.equals("c", "YES")) == [False, False, False, True, True]
    assert one(df, fn.norm("c")) == ["", "", "", "yes", "yes"]
    assert one(df, fn.fold("c")) == ["", "", None, "YES", "YES"]


def test_in_lists_drop_null(frame):
    df = frame("c string", [("a ",), ("B",), (None,)])
    assert one(df, fn.one_of("c", ["A"])) == [True, False, None]
    assert one(df, fn.none_of("c", ["A"])) == [False, True, None]
    assert df.where(fn.none_of("c", ["A"])).count() == 1


def test_like_ignores_case_and_trailing_blanks(frame):
    df = frame("c string", [("Stage 5 ",), ("stage 5",), ("Stage 55",), (None,)])
    assert one(df, fn.like_ci("c", "Stage 5")) == [True, True, False, None]
    assert one(df, fn.like_ci("c", "%AGE%")) == [True, True, True, None]


def test_false_and_yes_spellings(frame):
    df = frame("c string", [("False",), ("0",), (" ",), (None,), ("1",), ("Y",), ("yes",)])
    assert one(df, fn.is_false("c")) == [True, True, True, True, False, False, False]
    assert one(df, fn.is_yes("c")) == [False, False, False, False, True, True, True]


def test_yes_no_keeps_other_values(frame):
    df = frame("c string", [("y",), ("N ",), ("maybe",), (None,)])
    assert one(df, fn.yes_no("c")) == ["YES", "NO", "maybe", None]
    assert one(df, fn.yes_no("c", other="")) == ["YES", "NO", "", ""]


def test_label_without_otherwise_is_null_and_band_edges(frame):
    df = frame("x double", [(0.0,), (8.0,), (8.005,), (8.01,), (24.0,), (24.01,)])
    bands = [(0, 8, "1"), (8.01, 24, "2"), (24, None, "3")]
    assert one(df, fn.band("x", bands)) == ["1", "1", None, "2", "2", "3"]


def test_clamp_looks_at_the_integer_part(frame):
    df = frame("x decimal(10,2)", [(Decimal("-0.40"),), (Decimal("-1.00"),), (Decimal("3.50"),), (None,)])
    assert one(df, fn.clamp_min("x")) == [Decimal("-0.40"), Decimal("0"), Decimal("3.50"), None]


def test_dates_from_any_form(frame):
    df = frame("c string", [("2017-10-02",), ("10/2/2017",), ("",), ("junk",), (None,), ("2017-10-02 08:30:00",)])
    day = dt.date(2017, 10, 2)
    assert one(df, fn.as_date("c")) == [day, day, None, None, None, day]
    assert one(df, fn.order_date("c")) == [day, day, dt.date(1900, 1, 1), None, None, day]
    assert one(df, fn.text_us(fn.as_date("c")))[0] == "10/02/2017"


def test_year_difference_counts_boundaries(frame):
    df = frame("a date, b date", [(dt.date(2002, 12, 31), dt.date(2003, 1, 1)),
                                  (dt.date(2002, 9, 30), dt.date(2017, 9, 30))])
    assert one(df, fn.year_diff("a", "b")) == [1, 15]


def test_precedes_is_false_on_unknown(frame):
    df = frame("a int, b int, c int, d int",
               [(1, 1, 1, 2), (1, None, 1, 5), (1, None, 2, None), (2, 1, 1, 9), (None, 1, 2, 2), (1, 1, 1, 1)])
    flag = fn.precedes([F.col("a"), F.col("b")], [F.col("c"), F.col("d")])
    assert one(df, flag) == [True, False, True, False, False, False]


def test_decimals(frame):
    df = frame("x string", [("12.345",), ("",), ("abc",)])
    assert one(df, fn.dec("x", 10, 2)) == [Decimal("12.35"), None, None]
    assert one(df, fn.safe_div(F.lit(1), F.lit(0))) == [None] * 3


def test_any_flag(frame):
    df = frame("a string, b string", [("yes ", None), ("NO", "no"), (None, None)])
    assert one(df, fn.any_flag(["a", "b"])) == ["YES", "NO", "NO"]


def test_moment_and_midnight(frame):
    df = frame("x int", [(1,)])
    as_of = dt.datetime(2018, 3, 4, 12)
    assert one(df, fn.moment(as_of)) == [as_of]
    assert one(df, fn.midnight(as_of)) == [dt.datetime(2018, 3, 4)]
