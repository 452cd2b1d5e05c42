"""Column rules: the exact tables of the blueprint (hours text, bracket codes, ...)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from effort_analytics import functions as X

NULL = None


def _eval(spark, values, fn, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


HOURS_TABLE = [
    ("7.5", "7.50"), (".5", "0.50"), ("5.", "5.00"), (".", "0.00"), ("8", "8.00"), ("", "0"),
    ("abc", "0"), ("7,5", "0"), (" 3 ", "3.00"), ("1e2", "0"), ("-1", "-1.00"), ("-.5", "-0.50"),
    ("1.2.3", "0"), ("7.555", "7.56"), (NULL, "0"), ("2000000000", "0"),
]


def test_hours_decimal_table(spark):
    got = _eval(spark, [t for t, _ in HOURS_TABLE], X.hours_decimal)
    assert got == [Decimal(h) for _, h in HOURS_TABLE]


BRACKETS = [("[AB] x", "AB"), ("pre [X] y", "pre X"), ("] y", ""), ("[[A]B]", "A"), ("[open", "[open"),
            ("no bracket", "no bracket"), (NULL, NULL)]


def test_bracket_code_table(spark):
    assert _eval(spark, [t for t, _ in BRACKETS], X.bracket_code) == [c for _, c in BRACKETS]


def test_charindex(spark):
    assert _eval(spark, ["ab]c", "abc", NULL], lambda c: X.charindex("]", c)) == [3, 0, None]


def test_split_name_id(spark):
    workers = ["Name (123)", "Name (123) (On Leave)", "Name", "Name (x1)", NULL]
    names = _eval(spark, workers, lambda c: X.split_name_id(c)[0])
    ids = _eval(spark, workers, lambda c: X.split_name_id(c)[1])
    assert names == ["Name ", "Name ", "Name", "Name ", None]
    assert ids == [123, 123, None, None, None]


def test_seconds_to_hours(spark):
    vals = ["3600", "18", "17", "5400.5", "abc", "", NULL, "-36"]
    assert _eval(spark, vals, X.seconds_to_hours) == [
        Decimal("1.00"), Decimal("0.01"), Decimal("0.00"), Decimal("1.50"), Decimal("0"), Decimal("0"),
        Decimal("0"), Decimal("-0.01")]


def test_blank_and_normalized(spark):
    assert _eval(spark, ["  ", "", "x ", NULL], X.blank_to_null) == [None, None, "x ", None]
    assert _eval(spark, [" sick day ", NULL, "Vacation"], X.normalized) == ["SICK DAY", "", "VACATION"]
    # NOT IN on the normalised text keeps NULL; NOT LIKE drops it (NULL result)
    keep = _eval(spark, [" sick day ", NULL, "Vacation"], lambda c: X.not_in_normalized(c, ["SICK DAY"]))
    assert keep == [False, True, True]
    like = _eval(spark, ["Business Unit Holiday - X", NULL, "Vacation"],
                 lambda c: X.not_like_prefix(c, "Business Unit Holiday"))
    assert like == [False, None, True]


def test_planner_status_and_dates(spark):
    df = spark.createDataFrame(
        [("100", "2021-03-04", "2021-03-01", "2021-03-09"), ("100", None, "2021-03-01", "2021-03-09"),
         ("100", "bad", "2021-03-01", "2021-03-09"), ("50", "2021-03-04", None, "2021-03-09"),
         ("0", None, None, ""), ("7", None, None, None)],
        "p string, due string, start string, done string")
    out = df.select(X.planner_status("p").alias("s"), X.planner_progress("p").alias("n"),
                    X.planner_productive_date("p", "due", "start", "done").alias("d")).collect()
    assert [r.s for r in out] == ["COMPLETED", "COMPLETED", "COMPLETED", "In Progress", "Not Started",
                                  "NOT RECOGNIZED PLEASE CONTACT ADMIN"]
    assert [r.n for r in out] == [100, 100, 100, 50, 0, 7]
    assert [r.d for r in out] == [dt.date(2021, 3, 4), dt.date(2021, 3, 1), None, dt.date(2021, 3, 9), None, None]


def test_issue_vocabulary(spark):
    df = spark.createDataFrame(
        [("", "To Do", None, "2021-01-01"), ("", "In Review", None, "2021-01-01"),
         ("", "Done", " ", "2021-01-02"), ("", "Done", "2021-01-05", "2021-01-02"), ("", "Blocked", None, None),
         ("1", "Blocked", None, None), ("0", "Blocked", None, None)],
        "p string, s string, done string, created string")
    out = df.select(X.issue_status("p", "s").alias("st"), X.issue_progress("p", "s").alias("n"),
                    X.issue_productive_date("s", "done", "created").alias("d")).collect()
    assert [r.st for r in out] == ["Not Started", "In Progress", "COMPLETED", "COMPLETED",
                                   "NOT RECOGNIZED PLEASE CONTACT ADMIN", "COMPLETED", "Not Started"]
    assert [r.n for r in out] == [0, 0, 100, 100, 0, 100, 0]
    assert [r.d for r in out] == [None, None, dt.date(2021, 1, 2), dt.date(2021, 1, 5), None, None, None]


def test_productivity_class(spark):
    df = spark.createDataFrame([("Admin", "LEADS", "T"), ("Admin", "X", "T"), ("Admin", None, "T"),
                                ("Dev", "LEADS", "T")], "c string, k string, t string")
    got = [r[0] for r in df.select(X.productivity_class("c", "k", "t")).collect()]
    assert got == ["Productive", "Nonproductive", "T", "T"]


def test_date_helpers(spark):
    days = [dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8)]
    assert _eval(spark, days, X.is_weekend, "date") == [1, 1, 0]
    assert _eval(spark, days, X.date_key, "date") == [20240106, 20240107, 20240108]
    assert _eval(spark, days, X.quarter_name, "date") == ["Q1-2024"] * 3
    assert _eval(spark, days, X.day_name, "date") == ["Saturday", "Sunday", "Monday"]
    assert _eval(spark, days, X.year_month_text, "date") == ["202401"] * 3


def test_whole_number_cuts_fractions_off(spark):
    cases = [("50", 50), ("50.0", 50), ("1.5", 1), ("-1.9", -1), (".5", 0), (" 3 ", 3), ("5.", 5), ("", None),
             ("abc", None), ("1e2", None), ("1.2.3", None), ("99999999999999999999", None), (None, None)]
    df = spark.createDataFrame(cases, "t string, want bigint")
    assert all(r.got == r.want for r in df.withColumn("got", X.whole_number("t")).collect())
    out = df.where("t = '1.5'").select(X.issue_progress("t", F.lit("To Do")).alias("n"), X.issue_status("t", F.lit("x")).alias("s"))
    assert tuple(out.first()) == (100, "COMPLETED")
