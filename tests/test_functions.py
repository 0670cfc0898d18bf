from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from tidemark.functions import dates, values


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1)


def value(one, column):
    return one.select(column.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1/22/20", dt.date(2020, 1, 22)),
        ("12/31/69", dt.date(2069, 12, 31)),
        ("2/29/00", dt.date(2000, 2, 29)),
    ],
)
def test_header_date(one, text, expected):
    assert value(one, dates.header_date(F.lit(text))) == expected
    assert dates.parse_header(text) == expected


def test_names_that_are_no_dates():
    assert dates.parse_header("Country/Region") is None
    assert dates.parse_header("Lat") is None


def test_date_keys(one):
    day = F.lit(dt.date(2020, 9, 7))
    assert value(one, dates.dateid(day)) == 20200907
    assert value(one, dates.first_of_month(F.lit(2020), F.lit(9))) == dt.date(2020, 9, 1)
    assert value(one, dates.first_dateid(F.lit(2020), F.lit(9))) == 20200901
    assert value(one, dates.month_name(day)) == "September"
    assert value(one, dates.iso_text(day)) == "2020-09-07"
    assert value(one, dates.iso_date(F.lit("2020-09-07"))) == dt.date(2020, 9, 7)


def test_period_dates(one):
    assert value(one, dates.period_date(F.lit(2019), F.lit("M12"))) == dt.date(2019, 12, 1)
    assert value(one, dates.period_date(F.lit(2019), F.lit("M13"))) is None
    assert value(one, dates.period_date(F.lit(2019), F.lit(None).cast("string"))) is None


def test_days_between_is_half_open(one):
    a, b = F.lit(dt.date(2020, 2, 28)), F.lit(dt.date(2020, 3, 2))
    got = value(one, dates.days_between(a, b))
    assert [d.day for d in got] == [28, 29, 1]
    assert value(one, dates.days_between(b, b)) == []
    assert value(one, dates.days_between(b, a)) == []


def test_same_day_and_month(one):
    a, b = F.lit(dt.datetime(2020, 1, 1, 3)), F.lit(dt.datetime(2020, 1, 1, 22))
    assert value(one, dates.same_day(a, b))
    assert not value(one, dates.same_day(a, F.lit(dt.datetime(2020, 1, 2))))
    assert value(one, dates.same_month(a, F.lit(dt.date(2020, 1, 31))))
    assert not value(one, dates.same_month(a, F.lit(dt.date(2021, 1, 1))))


@pytest.mark.parametrize(("text", "number"), [("1.5", 1.5), ("NaN", None), ("x", None), ("", None), ("-2", -2.0)])
def test_parse_double(one, text, number):
    assert value(one, values.parse_double(F.lit(text))) == number


@pytest.mark.parametrize(("text", "number"), [(" 1976 ", 1976), ("1881 (1900)", None), ("", None)])
def test_parse_int(one, text, number):
    assert value(one, values.parse_int(F.lit(text))) == number


def test_texts(one):
    assert value(one, values.strip_newline(F.lit("a b \r\n"))) == "a b "
    assert value(one, values.words(F.lit("a b"))) == ["a", "b"]
    assert value(one, values.join_texts(F.array(F.lit("a"), F.lit(None), F.lit("b")))) == "a,b"
    assert value(one, values.thousands(F.lit(-1234567))) == "-1,234,567"
    assert value(one, values.plain_text(F.lit("<b>a&nbsp;&amp;lt;</b>"))) == "a &lt;"


def test_null_fills(spark, rows):
    df = spark.sql("SELECT * FROM VALUES (1, CAST(NULL AS INT), CAST(NULL AS DECIMAL(5,2)), CAST(NULL AS STRING)) t(a, b, c, d)")
    assert rows(values.zero_nulls(df, ["b"]).select("a", "b", "d")) == [(1, 0, None)]
    filled = values.zero_all_numbers(df)
    assert dict(filled.dtypes)["b"] == "int"
    row = filled.collect()[0]
    assert (row.b, float(row.c), row.d) == (0, 0.0, None)
