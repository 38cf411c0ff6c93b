from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailmart.operators.totals import (
    exact_sum,
    average_order_value,
    contribution,
    exact_mean,
    group_totals,
    totals_by_attribute,
)


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(
        [
            ("a", Decimal("10.00"), 1),
            ("a", Decimal("20.00"), 2),
            ("b", Decimal("30.00"), 1),
            ("c", Decimal("0.05"), 2),
            ("c", None, 3),
            (None, Decimal("-0.05"), 1),
        ],
        "k string, m decimal(18,2), s int",
    )


def test_shares_of_money_and_rows(sales, rows):
    got = contribution(
        sales, ["k"], {"total": "m"}, {"pct": "total", "rows_pct": "n"}, count="n"
    )
    assert rows(got, "k", "total", "n", "pct", "rows_pct") == [
        ("a", Decimal("30.00"), 2, Decimal("50.00"), 33.33),
        ("b", Decimal("30.00"), 1, Decimal("50.00"), 16.67),
        ("c", Decimal("0.05"), 2, Decimal("0.08"), 33.33),
        (None, Decimal("-0.05"), 1, Decimal("-0.08"), 16.67),
    ]


def test_shares_add_up(spark):
    df = spark.range(5000).select(
        (F.col("id") % 37).alias("k"), ((F.col("id") * 7919) % 100003 / 100).cast("decimal(18,2)").alias("m")
    )
    pct = contribution(df, ["k"], {"t": "m"}, {"p": "t"}).agg(F.sum("p")).first()[0]
    assert abs(float(pct) - 100) < 37 * 0.005


def test_no_total_gives_no_share(spark):
    df = spark.createDataFrame([("a", Decimal("5.00")), ("b", Decimal("-5.00"))], "k string, m decimal(18,2)")
    got = contribution(df, ["k"], {"t": "m"}, {"p": "t"}).collect()
    assert [r["p"] for r in got] == [None, None]


def test_shares_run_the_shuffle_once(sales):
    got = contribution(sales, ["k"], {"t": "m"}, {"p": "t"}, count="n")
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_doubles_are_summed_as_they_are(spark, rows):
    df = spark.createDataFrame([("a", 0.25), ("b", 0.75)], "k string, m double")
    assert rows(contribution(df, ["k"], {"t": "m"}, {"p": "t"})) == [("a", 0.25, 25.0), ("b", 0.75, 75.0)]


def test_mean_rounds_once(spark):
    # 1.005 and 2.675 are the classic values that binary doubles round down.
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),)], "m decimal(18,2)")
    assert df.agg(exact_mean(df, "m", 2)).first()[0] == Decimal("1.01")


def test_average_order_value_skips_unknown_amounts(sales, rows):
    assert average_order_value(sales, "m", digits=1).first()[0] == Decimal("12.0")
    assert rows(average_order_value(sales, "m", ["k"])) == [
        ("a", Decimal("15.00")),
        ("b", Decimal("30.00")),
        ("c", Decimal("0.05")),
        (None, Decimal("-0.05")),
    ]


def test_totals_by_attribute_equal_join_then_group(spark, rows):
    fact = spark.range(3000).select(
        (F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 101).cast("decimal(18,2)")).alias("m"),
        (F.col("id") % 3).alias("t"),
    )
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 4).alias("g"))
    for how in ("left", "inner"):
        got = totals_by_attribute(
            fact, dim, "k", ["g"], {"s": "m"}, count="n", counts={"c": "m"}, also_by=["t"], how=how
        )
        want = group_totals(fact.join(dim, "k", how), ["g", "t"], {"s": "m"}, "n", {"c": "m"})
        assert rows(got) == rows(want)


@pytest.mark.parametrize("kind", ["decimal(38,18)", "decimal(18,10)", "decimal(10,0)", "decimal(18,2)"])
def test_sums_hold_any_scale(spark, kind):
    df = spark.sql(f"select cast(60 as {kind}) as v union all select cast(60 as {kind})")
    assert df.agg(exact_sum(df, "v").alias("s")).first()["s"] == 120
