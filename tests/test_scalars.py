"""C1-C23 on the docstring examples and edge cases (ANSI-safe parsing)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skein.functions import scalars as S


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("o")).first()["o"]


def test_location_per_row_and_dataset(spark):
    df = spark.createDataFrame([("Sydney, New South Wales, Australia",), ("Macau, China",), ("Paris",), (None,)], "loc string")
    per_row = [tuple(r["o"]) if r["o"] else None for r in df.select(S.location_parts("loc").alias("o")).collect()]
    assert per_row[:3] == [("Sydney", "New South Wales", "Australia"), ("Macau", None, "China"), ("Paris", None, None)]
    ds = [tuple(r["o"]) for r in df.select(S.location_parts("loc", 3).alias("o")).collect()]
    assert ds[1] == ("Macau", "China", None)  # column-wide rule: a 2-part row loses its country


def test_height_reach(spark):
    assert one(spark, S.height_to_cm("v"), "5' 10\"") == pytest.approx(177.8)
    assert one(spark, S.height_to_cm("v"), "--") is None
    assert one(spark, S.reach_to_cm("v"), '71"') == pytest.approx(180.34)
    assert one(spark, S.reach_to_cm("v"), "--") is None


@pytest.mark.parametrize("text,secs", [("5:00", 300.0), ("0:30", 30.0), ("1:02:03", 3723.0), ("", None), ("5", None),
                                       ("1:2:3:4", None), ("a:b", None), (None, None)])
def test_time_to_seconds(spark, text, secs):
    assert one(spark, S.time_to_seconds("v"), text) == secs


def test_split_method(spark):
    got = one(spark, S.split_method("v"), "SUB\n\n      \n\n        Guillotine Choke")
    assert (got["short"], got["detail"]) == ("SUB", "Guillotine Choke")
    got = one(spark, S.split_method("v"), "U-DEC")
    assert (got["short"], got["detail"]) == ("U-DEC", None)
    got = one(spark, S.split_method("v"), "  ")
    assert (got["short"], got["detail"]) == (None, None)


def test_percentage_fraction(spark):
    assert one(spark, S.parse_percentage("v"), "14%") == 14.0
    assert one(spark, S.parse_percentage("v"), "---") is None
    got = one(spark, S.parse_fraction("v"), "4 of 27")
    assert (got["landed"], got["attempted"]) == (4.0, 27.0)
    assert one(spark, S.parse_fraction("v"), "n/a")["landed"] is None


@pytest.mark.parametrize("code,label", [("U-DEC", "Decision"), ("S-DEC", "Decision"), ("M-DEC", "Decision"),
                                        ("KO/TKO", "Knockout"), ("SUB", "Submission"), ("DQ", "Other"), (None, "Other")])
def test_method_type(spark, code, label):
    assert one(spark, S.method_type("v"), code) == label


def test_outcomes_capitalize(spark):
    w = one(spark, S.participant_outcomes("v"), "Win")
    assert (w["first"], w["second"]) == ("Win", "Loss")
    d = one(spark, S.participant_outcomes("v"), "Draw")
    assert (d["first"], d["second"]) == ("Draw", "Draw")
    assert one(spark, S.capitalize("v"), "NC") == "Nc"
    assert one(spark, S.capitalize("v"), "hello WORLD") == "Hello world"


def test_dates(spark):
    assert one(spark, S.parse_date("v"), "March 30, 2024") == dt.date(2024, 3, 30)
    assert one(spark, S.parse_date("v", "MMM d, yyyy"), "Jul 22, 1989 ") == dt.date(1989, 7, 22)
    assert one(spark, S.parse_date("v"), "TBD") is None
    assert one(spark, S.parse_date("v"), "") is None


@pytest.mark.parametrize("text,num", [("12", 12.0), (" 7 ", 7.0), ("1e3", 1000.0), ("-2.5", -2.5), ("3d", None),
                                      ("0x10", None), ("1,000", None), ("", None), (None, None)])
def test_to_number(spark, text, num):
    assert one(spark, S.to_number("v"), text) == num


def test_labels_and_misc(spark):
    assert one(spark, S.clean_label("v"), "  Women's Strawweight ") == "womens_strawweight"
    assert one(spark, S.clean_label("v"), None) == ""
    df = spark.createDataFrame([("Win", "Knockout"), (None, "Decision")], "a string, b string")
    assert [r["o"] for r in df.select(S.composite_label("a", "b").alias("o")).collect()] == ["win_knockout", None]
    assert one(spark, S.safe_ratio(F.lit(1.0), F.lit(0.0)), None) is None
    assert one(spark, S.fight_duration(F.lit(30.0), F.lit(3)), None) == 630.0
    assert one(spark, S.list_item("v", 1), ["a"], "v array<string>") is None
    assert one(spark, S.zero_fill("v"), None, "v int") == 0
    assert one(spark, S.display_round("v", 2), 0.125, "v double") == pytest.approx(0.12)  # exact tie -> even


@pytest.mark.parametrize("secs,text", [(0, "0:00:00"), (3723, "1:02:03"), (90061, "1 day, 1:01:01"),
                                       (200000, "2 days, 7:33:20"), (-5, "-1 day, 23:59:55")])
def test_seconds_to_clock(spark, secs, text):
    assert one(spark, S.seconds_to_clock("v"), float(secs), "v double") == text


def test_day_diff_floor_and_display(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 2, 6), dt.datetime(2020, 1, 1, 12))], "a timestamp, b timestamp")
    assert df.select(S.day_diff("a", "b").alias("o")).first()["o"] == 0
    assert df.select(S.day_diff("b", "a").alias("o")).first()["o"] == -1  # floored like timedelta.days
    assert one(spark, S.date_display("v"), dt.date(2024, 3, 5), "v date") == "March 05, 2024"
    assert one(spark, S.record_string(F.lit(3), F.lit(None), F.lit(1)), None) == "3-0-1"


def test_day_diff_ignores_session_time_zone(spark):
    # 8 wall-clock days across a daylight-saving change stay 8 days in any session zone
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.sql("select timestamp_ntz'2020-03-09 00:00:00' a, timestamp_ntz'2020-03-01 00:00:00' b, "
                       "date'2020-03-09' da, date'2020-03-01' db")
        r = df.select(S.day_diff("a", "b").alias("t"), S.day_diff("da", "db").alias("d")).first()
        assert (r["t"], r["d"]) == (8, 8)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
