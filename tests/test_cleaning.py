from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailmart.functions import Bin
from retailmart.operators import cleaning as cl


def test_text_steps(spark, rows):
    df = spark.createDataFrame([("TXN_1", "Brand_7", "add_to_cart")], "t string, b string, e string")
    df = cl.strip_prefix(cl.strip_prefix(df, "t", "TXN_"), "t", "TXN_")
    df = cl.after_last(cl.after_first(df, "b", "_"), "e", "_")
    assert rows(df) == [("1", "7", "cart")]


def test_sentinels_to_label(spark):
    df = spark.createDataFrame([(None,), ("ERROR",), ("error",), ("Tea",)], "c string")
    assert [r[0] for r in cl.sentinels_to_label(df, ["c"], ["ERROR"]).collect()] == [
        "NA",
        "NA",
        "error",
        "Tea",
    ]


def test_null_and_zero(spark, rows):
    df = spark.createDataFrame([(0, None), (5, 3)], "a int, b int")
    assert rows(cl.sentinel_to_null(df, {"a": 0})) == [(5, 3), (None, None)]
    out = cl.null_to_default(df, {"b": 0})
    assert out.schema["b"].dataType.simpleString() == "int"
    assert rows(out) == [(0, 0), (5, 3)]


def priced(spark):
    data = [("Tea", None), ("Cake", Decimal("9")), ("Pie", None), (None, Decimal("1.5"))]
    return spark.createDataFrame(data, "item string, price decimal(10,2)")


def test_fill_from_lookup(spark, rows):
    got = cl.fill_from_lookup(
        priced(spark), "price", "item", {"Tea": Decimal("1.5"), "Cake": Decimal("3")}, F.col("price").isNull()
    )
    assert rows(got) == [
        ("Cake", Decimal("9.00")),
        ("Pie", None),
        ("Tea", Decimal("1.50")),
        (None, Decimal("1.50")),
    ]
    back = cl.fill_from_lookup(
        priced(spark), "item", "price", {Decimal("1.5"): "Tea"}, F.col("item").isNull()
    )
    assert ("Tea", Decimal("1.50")) in rows(back)


def test_fill_from_derived_mapping(spark, rows):
    seen = spark.createDataFrame(
        [("Tea", 1), ("Tea", 1), ("Cake", 3), ("Cake", 4), ("Pie", None), (None, 7)],
        "item string, price int",
    )
    mapping = cl.derive_mapping(seen, "item", "price")
    assert rows(mapping) == [("Tea", 1)]
    gaps = spark.createDataFrame([("Tea", None), ("Cake", None), (None, None)], "item string, price int")
    got = cl.fill_from_table(gaps, "price", "item", mapping, F.col("price").isNull())
    assert rows(got) == [("Cake", None), ("Tea", 1), (None, None)]


@pytest.mark.parametrize(
    ("total", "qty", "price", "want"),
    [
        (None, 2, "1.50", ("3.00", 2, "1.50")),
        ("3.00", None, "1.50", ("3.00", 2, "1.50")),
        ("3.00", 2, None, ("3.00", 2, "1.50")),
        (None, None, "1.50", (None, None, "1.50")),
        ("3.00", None, None, ("3.00", None, None)),
        (None, None, None, (None, None, None)),
        ("3.00", 0, None, ("3.00", 0, None)),
        ("3.00", None, "0.00", ("3.00", None, "0.00")),
        ("9.99", 1, "1.00", ("9.99", 1, "1.00")),
        ("5.00", None, "2.00", ("5.00", 3, "2.00")),
    ],
)
def test_fill_by_product(spark, total, qty, price, want):
    def money(x):
        return None if x is None else Decimal(x)

    df = spark.createDataFrame(
        [(money(total), qty, money(price))], "t decimal(10,2), q int, p decimal(10,2)"
    )
    got = cl.fill_by_product(df, "t", "q", "p")
    assert got.schema == df.schema or got.dtypes == df.dtypes
    assert tuple(got.first()) == (money(want[0]), want[1], money(want[2]))


def test_scale_duration_bins_flag(spark, rows):
    df = spark.createDataFrame(
        [(Decimal("0.15"), "2023-01-01", "2023-01-09", None, None), (None, None, None, 1, None)],
        "u decimal(5,2), a string, b string, x int, y int",
    ).withColumns({c: F.col(c).cast("date") for c in "ab"})
    df = cl.scale_and_rename(df, "u", "pct", 100, 2)
    df = cl.duration_days(df, "a", "b", "days")
    df = cl.bin_column(df, "x", [Bin("low", high=1), Bin("one", 1, 1)], "rest", "bin")
    df = cl.validity_flag(df, ["x", "y"], "valid")
    assert df.columns[0] == "pct"
    assert rows(df, "pct", "days", "bin", "valid") == [
        (Decimal("15.00"), 8, "rest", 0),
        (None, None, "one", 1),
    ]
