import base64
import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark import functions as X


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c"), ("", None, "c")], "a string, b string, c string")
    keys = values(df.select(X.surrogate_key("a", "b", "c")))
    assert keys[:2] == ["7b193b3d33184464106f41ddf733783b", "4f32a73dc87b7bbb7a654d8898d58c7e"]
    empty = values(df.select(X.surrogate_key("a", "b", "c", null_token="")))
    assert empty[1] != keys[1] and empty[0] == keys[0]


@pytest.mark.parametrize("a,b,c,total,rest", [(1, 2, 3, 6, -4), (1, None, 3, 4, -2), (None, None, 2, 2, -2), (None, None, None, 0, 0)])
def test_safe_add_subtract(spark, a, b, c, total, rest):
    df = spark.createDataFrame([(a, b, c)], "a int, b int, c int")
    assert tuple(df.select(X.safe_add("a", "b", "c"), X.safe_subtract("a", "b", "c")).first()) == (total, rest)


def test_safe_divide(spark):
    df = spark.createDataFrame([(6, 0), (10, 5), (0, 5), (None, 5), (5, None), (5, 0)], "n int, d int")
    assert values(df.select(X.safe_divide("n", "d"))) == [None, 2.0, 0.0, None, None, None]


def test_width_bucket(spark):
    amounts = [190000.0, 200000.0, 299999.99, 300000.0, 399999.99, 400000.0, 599999.99, 600000.0, 610000.0]
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    assert values(df.select(X.width_bucket("a", 200000, 600000, 4))) == [0, 1, 1, 2, 2, 3, 4, 5, 5]


def test_haversine(spark):
    point = [F.lit(v) for v in (48.864716, 2.349014, 52.379189, 4.899431)]
    miles, km = one(spark, X.haversine_distance(*point)), one(spark, X.haversine_distance(*point, unit="km"))
    assert round(miles) == 267 and round(km) == 430
    with pytest.raises(ValueError):
        X.haversine_distance("a", "b", "c", "d", unit="m")


def test_log_and_uniform(spark):
    df = spark.createDataFrame([(math.e,), (0.0,), (-1.0,)], "v double")
    logs = values(df.select(X.log_natural("v")))
    assert logs[0] == pytest.approx(1) and logs[1:] == [None, None]
    draws = values(spark.range(100).select(X.uniform(3)))
    assert all(0 <= v < 1 for v in draws) and draws == values(spark.range(100).select(X.uniform(3)))


@pytest.mark.parametrize(
    "text,value",
    [("Jw8=", "99.99"), ("2PE=", "-99.99"), ("99.99", "99.99"), ("AQ==", "0.01"), ("/w==", "-0.01"), ("f/////////8=", "92233720368547758.07"), ("gAAAAAAAAAA=", "-92233720368547758.08"), ("!!", None), (None, None)],
)
def test_decode_decimal(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(X.decode_decimal("t", 20, 2)).first()[0]
    assert got == (None if value is None else Decimal(value))


@pytest.mark.parametrize(
    "text,by_bytes,by_number",
    [
        ("0000", "-29293.56", "0"),
        ("1234", "-26588.24", "1234"),
        ("12E3", "-26620.89", "12000"),
        ("99e9", "-5345.95", "99000000000"),
        ("99.99", None, "99.99"),
        ("", None, None),
    ],
)
def test_decode_decimal_does_not_guess(spark, text, by_bytes, by_number):
    df = spark.createDataFrame([(text,)], "t string")
    for encoding, value in (("bytes", by_bytes), ("number", by_number)):
        got = df.select(X.decode_decimal("t", 20, 2, encoding)).first()[0]
        assert got == (None if value is None else Decimal(value))


@pytest.mark.parametrize("value", [10**37, -(10**37), 2**64, -(2**64), -(2**63) - 1, 2**70 + 5, -1, 0])
def test_decode_wide_decimals(spark, value):
    text = base64.b64encode(value.to_bytes(16, "big", signed=True)).decode()
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(X.decode_decimal("t", 38, 0, "bytes")).first()[0] == value


def test_masks(spark):
    df = spark.createDataFrame([("u1@example.com",), ("x",), ("plain",), (None,)], "e string")
    assert values(df.select(X.mask_email("e"))) == ["u*@example.com", "x", "p****", None]
    assert values(df.select(X.mask_partial("e", 3)))[2] == "pla**"


def test_regexp_instr(spark):
    df = spark.createDataFrame([("abc1de22f",), ("none",), (None,)], "t string")
    got = df.select(
        X.regexp_instr("t", "[0-9]+"),
        X.regexp_instr("t", "[0-9]+", occurrence=2),
        X.regexp_instr("t", "[0-9]+", position=5),
        X.regexp_instr("t", "C", flags="i"),
    )
    assert [tuple(r) for r in got.collect()] == [(4, 7, 7, 3), (0, 0, 0, 0), (None, None, None, None)]
    with pytest.raises(ValueError):
        X.with_flags("a", "q")


@pytest.mark.parametrize(
    "url,host,path,medium",
    [
        ("www.google.co.uk?utm_source=google&utm_medium=cpc", "www.google.co.uk", "", "cpc"),
        ("http://witchwerks.com/", "witchwerks.com", "", None),
        ("https://www.nytimes.com/2021/01/05/blog.html?utm_medium=", "www.nytimes.com", "2021/01/05/blog.html", None),
        ("android-app://m.facebook.com/", "m.facebook.com", "/m.facebook.com/", None),
    ],
)
def test_urls(spark, url, host, path, medium):
    df = spark.createDataFrame([(url,)], "u string")
    got = tuple(df.select(X.url_host("u"), X.url_path("u"), X.url_parameter("u", "utm_medium")).first())
    assert got == (host, path, medium)


GOLDEN = {
    "2020-11-29": ("Sunday", "Sun", 29, 1, 7, 334, "2020-11-23", "2020-11-29", 48, "2020-11-29", "2020-12-05", 48, "2020-11-23", "2020-11-29", 48, 11, "November", "Nov"),
    "2020-12-01": ("Tuesday", "Tue", 1, 3, 2, 336, "2020-11-30", "2020-12-06", 49, "2020-11-29", "2020-12-05", 48, "2020-11-30", "2020-12-06", 49, 12, "December", "Dec"),
}


@pytest.mark.parametrize("day", sorted(GOLDEN))
def test_golden_days(spark, day):
    c = F.lit(day).cast("date")
    columns = [
        X.day_name(c, False), X.day_name(c), X.day_of_month(c), X.day_of_week(c, False), X.day_of_week(c), X.day_of_year(c),
        X.week_start(c), X.week_end(c), X.week_of_year(c),
        X.week_start(c, "sunday"), X.week_end(c, "sunday"), X.week_of_year(c, "sunday"),
        X.iso_week_start(c), X.iso_week_end(c), X.iso_week_of_year(c),
        X.date_part("month", c), X.month_name(c, False), X.month_name(c),
    ]
    row = spark.range(1).select(*[e.alias(f"c{i}") for i, e in enumerate(columns)]).first()
    assert tuple(str(v) if isinstance(v, dt.date) else v for v in row) == GOLDEN[day]


def test_golden_moments(spark):
    utc = X.from_unixtimestamp(F.lit(1623076520))
    local = X.convert_timezone(utc, "America/Los_Angeles")
    row = spark.range(1).select(utc.alias("a"), local.alias("b"), X.round_timestamp(local).alias("c"), X.round_timestamp(utc).alias("d"), X.to_unixtimestamp(utc).alias("e")).first()
    assert [str(v) for v in row] == ["2021-06-07 14:35:20", "2021-06-07 07:35:20", "2021-06-07 00:00:00", "2021-06-08 00:00:00", "1623076520"]
    assert str(one(spark, X.from_unixtimestamp(F.lit(1623076520123), "milliseconds"))) == "2021-06-07 14:35:20.123000"
    with pytest.raises(ValueError):
        X.from_unixtimestamp("a", "fortnights")


def test_relative_dates(spark):
    as_of = "2021-06-07 02:00:00"
    assert str(one(spark, X.today(as_of, "America/Los_Angeles"))) == "2021-06-06"
    day = X.today(as_of)
    got = [one(spark, f) for f in (X.yesterday(day), X.tomorrow(day), X.n_weeks_ago(1, day), X.next_month(day), X.last_month_number(day), X.next_month_name(day))]
    assert [str(v) for v in got] == ["2021-06-06", "2021-06-08", "2021-05-31", "2021-07-01", "5", "Jul"]
    assert one(spark, X.periods_since(F.lit("2021-05-31").cast("date"), as_of, "month")) == 1
    assert one(spark, X.periods_since(F.lit("2021-06-06 23:59:59").cast("timestamp"), as_of, "day")) == 1
    with pytest.raises(ValueError):
        X.periods_since("a", as_of, "decade")
