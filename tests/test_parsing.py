"""Parsers on the literal edge cases: bad text must become NULL (never
abort the job under ANSI), odd but valid forms must parse."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.functions import (date_key, decimal_comma, month_name,
                                 parse_date, parse_date_us, parse_ts_date,
                                 quarter_label, resolution_days, to_int)
from starforge.functions.parsing import ISO_DATE
from starforge.operators import fill_missing_score, fill_unknown, fill_zero


def _one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"s {typ}")
    return [r[0] for r in df.select(fn("s")).collect()]


def test_decimal_comma(spark):
    got = _one(spark, ["12,5", " 7,0 ", "1.234,56", "abc", "", None], decimal_comma)
    assert got == [12.5, 7.0, None, None, None, None]


def test_iso_dates_by_cast_agree_with_the_pattern(spark):
    """Plain texts are cast, without a formatter per row; whatever the pattern
    alone reads or refuses stays so."""
    odd = ["2001-02-28", "2001-02-29", "2001-2-3", "2001-02-03 ", " 2001-02-03", "2001-02-03\n", "2001-02-03 00:00:00",
           "2001-02-03T", "0000-01-01", "0999-01-01", "+12345-01-01", "12345-01-01", "-0001-01-01", "2001-13-01",
           "2001-00-10", "9999-12-31", "", "n/d", "1582-10-10", "2001-02-03\r", "２００１-02-03", None]
    df = spark.createDataFrame([(v,) for v in odd], "s string")
    rows = df.select(parse_date("s", ISO_DATE).cast("string"), F.try_to_date("s", ISO_DATE).cast("string")).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows]
    assert "CASE WHEN" in df.select(parse_date("s", ISO_DATE).alias("d"))._jdf.queryExecution().toString()


def test_to_int_goes_through_double(spark):
    assert _one(spark, ["7", "7.0", "NA", None], to_int) == [7, 7, None, None]


def test_iso_date_with_pattern(spark):
    got = _one(spark, ["2024-01-02", "2024-01-02 10:00:00", "02/01/2024", None],
               lambda c: parse_date(c, "yyyy-MM-dd"))
    assert got == [dt.date(2024, 1, 2), None, None, None]


def test_default_date_accepts_trailing_time(spark):
    got = _one(spark, ["2024-01-02", "2024-01-02 10:00:00", "junk"], parse_date)
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 2), None]


def test_us_meridiem_both_clocks(spark):
    got = _one(spark, ["3/5/2024 1:05:00 PM", "3/5/2024 13:05:00 PM", "3/5/2024 9:05:00 AM",
                       "12/31/2023 0:00:00 AM", "bad"], parse_date_us)
    assert got == [dt.date(2024, 3, 5)] * 3 + [dt.date(2023, 12, 31), None]


def test_iso_t_timestamp(spark):
    got = _one(spark, ["2024-01-02T10:00:00", None, "2024-01-02"], parse_ts_date)
    assert got == [dt.date(2024, 1, 2), None, None]


def test_calendar_functions(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 9),), (dt.date(1999, 12, 31),)], "d date")
    rows = df.select(date_key("d"), month_name("d"), quarter_label("d")).collect()
    assert [tuple(r) for r in rows] == [(20240309, "March", "Q1"), (19991231, "December", "Q4")]


def test_resolution_days_negative_and_null(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 10)),
                                (dt.date(2024, 1, 10), dt.date(2024, 1, 1)),
                                (None, dt.date(2024, 1, 1))], "a date, b date")
    got = [r[0] for r in df.select(resolution_days("b", "a")).collect()]
    assert got == [9, -9, None]


def test_null_policies(spark):
    df = spark.createDataFrame([(None, None, None), ("x", 2.0, 3.0)],
                               "t string, score double, m double")
    out = fill_zero(fill_missing_score(fill_unknown(df, ["t"]), ["score"]), ["m"]).collect()
    assert [tuple(r) for r in out] == [("Nao Informado", -1.0, 0.0), ("x", 2.0, 3.0)]


def test_to_long_is_exact(spark):
    from starforge.functions.parsing import to_long
    texts = ["9007199254740993", "9007199254740992", "7.0", " 12 ", "n/d", None, "9223372036854775807"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(to_long("t").alias("v"))
    assert [r.v for r in df.collect()] == [9007199254740993, 9007199254740992, 7, 12, None, None, 9223372036854775807]
