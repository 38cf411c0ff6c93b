from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from retailmart.operators.funnels import funnel
from retailmart.operators.periods import period_change


def months(spark):
    data = [(1, 100), (2, 150), (4, 0), (5, 50)]
    return spark.createDataFrame(
        [(dt.date(2023, m, 1), Decimal(v)) for m, v in data], "month date, r decimal(20,2)"
    )


def test_previous_is_the_row_before(spark):
    got = period_change(months(spark), "month", "r").orderBy("month").collect()
    assert [r["previous"] for r in got] == [None, 100, 150, 0]
    assert [r["change_pct"] for r in got] == [None, 50, -100, None]


def test_filled_calendar(spark):
    got = period_change(months(spark), "month", "r", fill_calendar=True).orderBy("month").collect()
    assert [r["month"].month for r in got] == [1, 2, 3, 4, 5]
    assert [r["previous"] for r in got] == [None, 100, 150, None, 0]


def events(spark):
    data = [("web", "view")] * 8 + [("web", "click")] * 3 + [("app", "view"), ("app", "bounce")]
    return spark.createDataFrame(data, "channel string, e string")


STEPS = [("view", "views"), ("click", "clicks"), ("cart", "carts"), ("purchase", "purchases")]
RATES = ["r1", "r2", "r3"]


def test_funnel(spark):
    got = funnel(events(spark), "e", STEPS, RATES).first()
    assert tuple(got) == (9, 3, 0, 0, 33.33, 0.0, None)


def test_funnel_by_channel(spark, rows):
    got = funnel(events(spark), "e", STEPS[:2], ["rate"], by=["channel"])
    assert rows(got) == [("app", 1, 0, 0.0), ("web", 8, 3, 37.5)]


def test_funnel_may_ignore_case(spark):
    df = spark.createDataFrame([("View ",), ("view",), ("CLICK",)], "e string")
    assert tuple(funnel(df, "e", STEPS[:2], ["rate"]).first()) == (1, 0, 0.0)
    relaxed = funnel(df, "e", STEPS[:2], ["rate"], case_insensitive=True)
    assert tuple(relaxed.first()) == (2, 1, 50.0)


def test_rates_must_fit_steps(spark):
    with pytest.raises(ValueError):
        funnel(events(spark), "e", STEPS, ["only one"])
