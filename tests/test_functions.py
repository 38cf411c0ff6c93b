from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailmart.functions import (
    Bin,
    after_first,
    after_last,
    bin_label,
    days_between,
    is_missing,
    month_name,
    month_start,
    parse_dmy_date,
    parse_dmy_timestamp,
    percent,
    percent_text,
    ratio,
    strip_prefix,
    visible_length,
    weekday_name,
)


def value(spark, c):
    return spark.range(1).select(c).first()[0]


def text(v):
    return F.lit(v).cast("string")


@pytest.mark.parametrize(
    ("given", "want"), [("TXN_123", "123"), ("123", "123"), ("TXN_", ""), (None, None)]
)
def test_strip_prefix_twice(spark, given, want):
    once = strip_prefix(text(given), "TXN_")
    assert value(spark, once) == want
    assert value(spark, strip_prefix(once, "TXN_")) == want


def test_parts_of_text(spark):
    assert value(spark, after_first(text("Brand_7_x"), "_")) == "7_x"
    assert value(spark, after_first(text("Brand"), "_")) == "Brand"
    assert value(spark, after_last(text("add_to_cart"), "_")) == "cart"
    assert value(spark, after_last(text("view"), "_")) == "view"
    assert value(spark, visible_length(text("abc  "))) == 3


@pytest.mark.parametrize(
    ("given", "binary", "relaxed"),
    [
        (None, True, True),
        ("ERROR", True, True),
        ("error", False, True),
        ("ERROR ", False, True),
        ("Tea", False, False),
    ],
)
def test_is_missing(spark, given, binary, relaxed):
    sentinels = ["ERROR", "UNKNOWN"]
    assert bool(value(spark, is_missing(text(given), sentinels))) is binary
    assert bool(value(spark, is_missing(text(given), sentinels, True))) is relaxed


@pytest.mark.parametrize(
    ("age", "label"),
    [
        (24, "18-24"),
        (25, "25-34"),
        (34, "25-34"),
        (35, "35-44"),
        (44, "35-44"),
        (45, "45-54"),
        (54, "45-54"),
        (55, "55+"),
        (None, "55+"),
    ],
)
def test_bins_take_both_ends_and_the_rest(spark, age, label):
    bins = [Bin("18-24", high=25), Bin("25-34", 25, 34), Bin("35-44", 35, 44), Bin("45-54", 45, 54)]
    assert value(spark, bin_label(F.lit(age).cast("int"), bins, "55+")) == label


def test_first_matching_bin_wins(spark):
    bins = [Bin("Low", high=50), Bin("Mid", 50, 100), Bin("High", 100, 200)]
    got = [value(spark, bin_label(F.lit(x), bins, "Top")) for x in (49, 50, 100, 101, 200, 201)]
    assert got == ["Low", "Mid", "Mid", "High", "High", "Top"]


def test_dates(spark):
    assert value(spark, parse_dmy_date(text("31/12/2023"))) == dt.date(2023, 12, 31)
    assert value(spark, parse_dmy_date(text("1/2/2023"))) == dt.date(2023, 2, 1)
    for bad in ("2023-31-12", "", "31/02/2023x"):
        assert value(spark, parse_dmy_date(text(bad))) is None
        assert value(spark, parse_dmy_timestamp(text(bad))) is None
    assert value(spark, parse_dmy_timestamp(text("31/12/2023 23:57"))) == dt.datetime(
        2023, 12, 31, 23, 57
    )
    assert value(spark, parse_dmy_timestamp(text("1/2/2023 0:05:07"))) == dt.datetime(
        2023, 2, 1, 0, 5, 7
    )
    assert value(spark, parse_dmy_timestamp(text("1/2/2023"))) == dt.datetime(2023, 2, 1)
    day = F.lit(dt.date(2023, 5, 17))
    assert value(spark, month_start(day)) == dt.date(2023, 5, 1)
    assert value(spark, month_name(day)) == "May"
    assert value(spark, weekday_name(day)) == "Wednesday"
    assert value(spark, days_between(F.lit(dt.date(2023, 5, 1)), day)) == 16


def test_a_text_time_is_read_once(spark):
    """Each piece of the parser stands in the plan once."""
    df = spark.range(1).select(F.col("id").cast("string").alias("t")).select(parse_dmy_timestamp(F.col("t")).alias("x"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
    assert "RLIKE" not in plan.upper()
    assert plan.count("as timestamp_ntz") == 1


def test_rounding_is_half_away_from_zero(spark):
    assert value(spark, percent_text(F.lit(Decimal("1234.565")))) == "1,234.57 %"
    assert value(spark, percent_text(F.lit(Decimal("-0.125")))) == "-0.13 %"
    money = F.lit(Decimal("12.345")).cast("decimal(20,3)")
    assert value(spark, ratio(money, F.lit(1), 2)) == Decimal("12.35")
    assert value(spark, ratio(-money, F.lit(1), 2)) == Decimal("-12.35")


def test_zero_divisor_is_null(spark):
    for zero in (F.lit(0), F.lit(0.0), F.lit(Decimal("0.00"))):
        assert value(spark, ratio(F.lit(5), zero)) is None
        assert value(spark, ratio(F.lit(5), zero, 2)) is None
        assert value(spark, percent(F.lit(5), zero)) is None
        assert value(spark, percent(F.lit(5), zero, None)) is None


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("01/02/2023 10:11:12.1234567", dt.datetime(2023, 2, 1, 10, 11, 12, 123456)),
        ("01/02/2023 1:05 PM", dt.datetime(2023, 2, 1, 13, 5)),
        ("01/02/2023 12:05 am", dt.datetime(2023, 2, 1, 0, 5)),
        ("01/02/2023T10:11:12", dt.datetime(2023, 2, 1, 10, 11, 12)),
        ("26/03/2023 02:30", dt.datetime(2023, 3, 26, 2, 30)),
        ("01/02/2023 13:05 PM", None),
        ("01/02/2023 25:00", None),
        ("01/02/2023 12:00 PM", dt.datetime(2023, 2, 1, 12)),
        ("01/02/2023 00:05 AM", None),
        ("01/02/2023 10:11:123", None),
        ("01/02/2023 10:11:12.1234567 pm", dt.datetime(2023, 2, 1, 22, 11, 12, 123456)),
        ("01/02/2023 1:05PM", dt.datetime(2023, 2, 1, 13, 5)),
        ("01/02/2023 10:11:12.", None),
        ("01/02/2023 10:11 xm", None),
        ("P|2023-02-01 10:11", None),
        ("|2023-02-01", None),
        ("2023-02-01", None),
        ("a\n01/02/2023", None),
        ("30/02/2023 10:11", None),
        ("29/02/2024", dt.datetime(2024, 2, 29)),
        ("0/1/2023", None),
        (None, None),
    ],
)
def test_day_first_times_need_no_zone(spark, given, want):
    saved = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert value(spark, parse_dmy_timestamp(text(given))) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)
