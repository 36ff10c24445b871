"""JSON payload access, dates and numbers on hand-written values."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from finlake.functions import dates, numbers, payload as P


def value(spark, text, path="$.a"):
    frame = spark.createDataFrame([(text,)], "payload string")
    return frame.select(P.scalar(P.parse("payload"), path)).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"a":"x"}', "x"),
        ('{"a":5}', "5"),
        ('{"a":true}', "true"),
        ('{"a":null}', None),
        ('{"b":1}', None),
        ('{"a":{"x":1}}', None),
        ('{"a":[1,2]}', None),
        ('{"a":"[1,2]"}', "[1,2]"),
        ('{"a":"{}"}', "{}"),
        ('{"a":12345678901234567.123456789}', "12345678901234567.123456789"),
        ('{"a":"é ã"}', "é ã"),
        ('{"a":1', None),
        ("", None),
        (None, None),
    ],
)
def test_scalar(spark, text, expected):
    assert value(spark, text) == expected


def test_names_are_case_sensitive_and_may_have_accents(spark):
    text = '{"t":1,"T":2,"TÍTULO":"LFT","INÍCIO":"2024-01-01"}'
    assert [value(spark, text, p) for p in ("$.t", "$.T", "$.TÍTULO", "$.INÍCIO")] == [
        "1", "2", "LFT", "2024-01-01",
    ]


def test_strip_removes_tabs_and_line_ends(spark):
    frame = spark.createDataFrame([(" \t {} \r",)], "v string")
    assert frame.select(P.strip("v")).first()[0] == "{}"


def apply(spark, function, text, strict=True):
    frame = spark.createDataFrame([(text,)], "v string")
    return frame.select(function(F.col("v"), strict=strict)).first()[0]


@pytest.mark.parametrize(
    "function, text, expected",
    [
        (dates.iso_day, "2024-03-05", date(2024, 3, 5)),
        (dates.iso_day, "2024-3-5", date(2024, 3, 5)),
        (dates.slash_day, "05/03/2024", date(2024, 3, 5)),
        (dates.slash_day, "5/3/2024", date(2024, 3, 5)),
        (dates.compact_month, "202403", date(2024, 3, 1)),
        (dates.compact_month_start, "202403", date(2024, 3, 1)),
        (dates.dashed_month, "2024-03", date(2024, 3, 1)),
        (dates.epoch_millis, "1704067211172", datetime(2024, 1, 1, 0, 0, 11, 172000)),
        (numbers.integer, "01", 1),
        (numbers.numeric, "0.00001200", Decimal("0.000012000")),
        (numbers.numeric, "12345678901234567.123456789", Decimal("12345678901234567.123456789")),
        (numbers.numeric, "0.1234567885", Decimal("0.123456789")),
        (numbers.numeric, "1.2E-5", Decimal("0.000012000")),
        (numbers.boolean, "true", True),
        (numbers.numeric, None, None),
    ],
)
def test_typing(spark, function, text, expected):
    assert apply(spark, function, text) == expected


@pytest.mark.parametrize(
    "function, text",
    [
        (numbers.integer, "1.0"),
        (numbers.integer, "5.5"),
        (numbers.numeric, "x"),
        (numbers.boolean, "maybe"),
        (dates.slash_day, "2024-03-05"),
        (dates.iso_day, ""),
        (dates.compact_month, "2024-03"),
        (dates.dashed_month, "202403"),
    ],
)
def test_bad_values_raise_or_give_null(spark, function, text):
    with pytest.raises(Exception):
        apply(spark, function, text)
    assert apply(spark, function, text, strict=False) is None


def test_arithmetic_keeps_nine_digits(spark):
    frame = spark.sql(
        "SELECT CAST('1.000000001' AS DECIMAL(38,9)) a, CAST('2.000000002' AS DECIMAL(38,9)) b, "
        "CAST(NULL AS DECIMAL(38,9)) n"
    )
    row = frame.select(
        numbers.plus_optional("a", "b").alias("ab"),
        numbers.plus_optional("a", "n").alias("an"),
        numbers.plus_optional("n", "a").alias("na"),
        numbers.minus("a", "b").alias("d"),
    )
    assert [f.dataType.simpleString() for f in row.schema] == ["decimal(38,9)"] * 4
    assert list(row.first()) == [
        Decimal("3.000000003"), Decimal("1.000000001"), None, Decimal("-1.000000001"),
    ]


def test_safe_divide_and_rounding(spark):
    frame = spark.sql("SELECT 3L a, 0L z, 4L b, 2.675D r, -2.675D m")
    row = frame.select(
        numbers.safe_divide("a", "b"),
        numbers.safe_divide("a", "z"),
        numbers.rounded("r", 2),
        numbers.rounded("m", 2),
    ).first()
    assert list(row) == [0.75, None, 2.68, -2.68]


@pytest.mark.parametrize(
    "run_date, monthly, conservative, quarterly",
    [
        (date(2026, 5, 10), date(2026, 4, 30), date(2026, 3, 31), date(2025, 12, 31)),
        (date(2026, 1, 1), date(2025, 12, 31), date(2025, 11, 30), date(2025, 9, 30)),
        (date(2024, 3, 31), date(2024, 2, 29), date(2024, 1, 31), date(2023, 9, 30)),
    ],
)
def test_reporting_dates(spark, run_date, monthly, conservative, quarterly):
    frame = spark.createDataFrame([(run_date,)], "d date")
    d = F.col("d")
    row = frame.select(
        dates.reporting_date(d, F.lit("monthly")),
        dates.reporting_date(d, F.lit("daily")),
        dates.reporting_date(d, F.lit("monthly"), conservative=True),
        dates.reporting_date(d, F.lit("quarterly")),
        dates.reporting_date(d, F.lit("quarterly"), conservative=True),
    ).first()
    assert list(row) == [monthly, monthly, conservative, quarterly, quarterly]
