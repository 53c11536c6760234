import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tripmill import functions as X

METHODS = {
    None: "Other",
    "": "Other",
    "  \t": "Other",
    "  ": "Other",
    "Credit Card": "Credit",
    "CARD": "Credit",
    "cash card": "Credit",
    "Cash": "Cash",
    "petty CASH fund": "Cash",
    "1": "Credit",
    " 1 ": "Credit",
    " 1 ": "Credit",
    "1.0": "Credit",
    "1.": "Credit",
    "1.99": "Credit",
    "+1": "Credit",
    "1e0": "Credit",
    "10E-1": "Credit",
    "0_1": "Credit",
    "_1": "Other",
    "1_": "Other",
    "2": "Cash",
    ".2e1": "Cash",
    "2.7": "Cash",
    "3": "Other",
    "0.9": "Other",
    "-1": "Other",
    "1d": "Other",
    "1f": "Other",
    "0x1": "Other",
    "nan": "Other",
    "inf": "Other",
    "1e400": "Other",
    "No Charge": "Other",
    "1 2": "Other",
}


def _scripted(value):
    """The rule as a script states it."""
    text = "" if value is None else value.strip().lower()
    if "credit" in text or "card" in text:
        return "Credit"
    if "cash" in text:
        return "Cash"
    try:
        return {1: "Credit", 2: "Cash"}.get(int(float(text)), "Other")
    except (ValueError, OverflowError):
        return "Other"


def test_payment_method(spark):
    assert {v: _scripted(v) for v in METHODS} == METHODS
    df = spark.createDataFrame([(v,) for v in METHODS], "raw string")
    got = {r.raw: r.m for r in df.select("raw", X.payment_method("raw").alias("m")).collect()}
    assert got == METHODS


def test_payment_method_of_random_text(spark):
    draw = random.Random(11)
    pieces = ["1", "2", "0", "9", ".", "e", "E", "+", "-", "_", " ", "\t", "\u2003", "\x1d", "cash",
              "card", "CREDIT", "nan", "inf", "d", "x", "\n"]
    texts = {"".join(draw.choices(pieces, k=draw.randrange(1, 6))) for _ in range(4_000)}
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    got = {r.raw: r.m for r in df.select("raw", X.payment_method("raw").alias("m")).collect()}
    assert {t: m for t, m in got.items() if m != _scripted(t)} == {}


def test_payment_method_of_numbers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (5.0,), (None,)], "raw double")
    got = [r.m for r in df.select(X.payment_method("raw").alias("m")).collect()]
    assert got == ["Credit", "Cash", "Other", "Other"]


def test_number(spark):
    values = {"1": 1.0, " 2.5 ": 2.5, "-3e2": -300.0, "1d": None, "abc": None, "": None, None: None,
              "inf": float("inf"), "nan": None}
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    got = {r.raw: r.n for r in df.select("raw", X.number("raw").alias("n")).collect()}
    assert got == values


def test_whole_number(spark):
    df = spark.createDataFrame([("3",), ("3.0",), ("3.",), ("x",), ("3.5",), (None,)], "raw string")
    got = [r.n for r in df.select(X.whole_number("raw", strict=False).alias("n")).collect()]
    assert got == [3, 3, 3, None, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(X.whole_number("raw")).collect()


@pytest.fixture
def times(spark):
    values = [
        "2024-02-29 23:59:59.999", "2024-03-01 00:00:00", "2024-03-15 00:00:00",
        "2024-03-15 00:00:01", "2024-12-31 23:59:59", "2025-01-01 00:00:00",
    ]
    return spark.createDataFrame([(v,) for v in values], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t")
    )


def test_interval_ends_at_midnight_that_begins_the_last_day(times):
    got = [r.t.isoformat() for r in times.filter(X.in_interval("t", "2024-03-01", "2024-03-15")).collect()]
    assert got == ["2024-03-01T00:00:00", "2024-03-15T00:00:00"]


def test_day_month_year(times):
    assert times.filter(X.on_day("t", "2024-03-15")).count() == 2
    assert times.filter(X.on_day("t", date(2024, 2, 29))).count() == 1
    assert times.filter(X.in_month("t", "2024-03-01")).count() == 3
    assert times.filter(X.in_month("t", datetime(2024, 12, 31, 8))).count() == 1
    assert times.filter(X.in_year("t", 2024)).count() == 5
    dates = times.select(F.to_date("t").alias("t"))
    assert dates.filter(X.on_day("t", "2024-03-15")).count() == 2
    assert dates.filter(X.in_month("t", "2024-03-09")).count() == 3


def test_greater_than_ignores_null_and_nan(spark):
    df = spark.createDataFrame([(5.0,), (5.1,), (None,), (float("nan"),), (float("inf"),)], "x double")
    assert df.filter(X.greater_than("x", 5.0)).count() == 2
    assert df.agg(F.count_if(X.greater_than("x", 5.0))).first()[0] == 2


def test_time_parts(times):
    got = times.select(X.year_month("t"), X.month_start("t"), X.message_time("t")).first()
    assert tuple(got) == (202402, date(2024, 2, 1), "2024-02-29 23:59:59")


def test_duration_counts_whole_seconds_and_may_be_negative(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00.9' a, timestamp_ntz'2024-01-01 01:30:00.1' b"
    )
    assert df.select(X.duration_hours("a", "b")).first()[0] == 1.5
    assert df.select(X.duration_hours("b", "a")).first()[0] == -1.5


def test_parse_time(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02",), ("soon",), (None,)], "s string")
    strict = [r[0] for r in df.select(X.parse_time("s", X.MESSAGE_TIME)).collect()]
    assert strict == [datetime(2024, 1, 2, 3, 4, 5), None, None, None]
    free = [r[0] for r in df.select(X.parse_time("s")).collect()]
    assert free == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2), None, None]


def test_contains_text_takes_marks_literally(spark):
    df = spark.createDataFrame([("A_B",), ("axb",), ("50%",), (None,)], "s string")
    assert [r.s for r in df.filter(X.contains_text("s", "a_b")).collect()] == ["A_B"]
    assert [r.s for r in df.filter(X.contains_text("s", "0%")).collect()] == ["50%"]
