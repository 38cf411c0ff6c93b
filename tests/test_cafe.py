from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from retailmart.plans import cafe
from retailmart.sources.schemas import CAFE_RAW

RAW = [
    # id, item, quantity, price, total, payment, location, date
    ("TXN_1", "Salad", 2, "5", None, "Cash", "In-store", "2023-01-05"),
    ("TXN_2", "UNKNOWN", 1, "1.5", "1.5", "ERROR", None, "2023-01-20"),
    ("TXN_3", "Cake", None, None, "9", "Cash", "Takeaway", "2023-02-03"),
    ("TXN_4", None, 3, "3", "9", "UNKNOWN", "ERROR", None),
    ("TXN_5", "ERROR", 2, None, "4", "Credit Card", "Takeaway", "2023-02-10"),
    ("TXN_6", "Coffee", None, "2", None, "Cash", "In-store", "2023-04-01"),
]


@pytest.fixture(scope="module")
def raw(spark):
    def money(v):
        return None if v is None else Decimal(v)

    def day(v):
        return None if v is None else dt.date.fromisoformat(v)

    data = [(i, it, q, money(p), money(t), pm, loc, day(d)) for i, it, q, p, t, pm, loc, d in RAW]
    return spark.createDataFrame(data, CAFE_RAW)


def test_silver(raw, rows):
    got = rows(cafe.cafe_silver(raw))
    assert [r[:7] for r in got] == [
        ("1", "Salad", 2, Decimal("5.00"), Decimal("10.00"), "Cash", "In-store"),
        ("2", "Tea", 1, Decimal("1.50"), Decimal("1.50"), "NA", "NA"),
        ("3", "Cake", 3, Decimal("3.00"), Decimal("9.00"), "Cash", "Takeaway"),
        ("4", "NA", 3, Decimal("3.00"), Decimal("9.00"), "NA", "NA"),
        # The price comes after the item is looked up, so the item stays unknown.
        ("5", "NA", 2, Decimal("2.00"), Decimal("4.00"), "Credit Card", "Takeaway"),
        ("6", "Coffee", None, Decimal("2.00"), None, "Cash", "In-store"),
    ]


def test_parity_mapping_takes_one_and_a_half_for_salad(raw, rows):
    assert rows(cafe.cafe_silver(raw, parity=True), "Transaction_ID", "Item")[1] == ("2", "Salad")


def test_cleaning_twice_changes_nothing(raw, rows):
    once = cafe.cafe_silver(raw)
    # A second pass may use what the first one filled in; without that it is stable.
    twice = cafe.cafe_silver(cafe.cafe_silver(once))
    assert rows(twice) == rows(cafe.cafe_silver(twice))


def test_total_is_quantity_times_price(raw):
    bad = cafe.cafe_silver(raw).filter("Total_Spent <> Quantity * Price_Per_Unit")
    assert bad.count() == 0


@pytest.mark.parametrize(
    ("spent", "label"), [("4.99", "Low"), ("5", "Medium"), ("15", "Medium"), ("15.01", "High")]
)
def test_spend_bounds(spark, spent, label):
    gold = spark.createDataFrame([(Decimal(spent),)], "Total_Spent decimal(10,2)")
    got = cafe.spend_buckets(gold).collect()
    assert [(r["Spend_Category"], float(r["Revenue_Pct"])) for r in got] == [(label, 100.0)]


def test_months(raw):
    gold = cafe.gold_cafe_sales(cafe.cafe_silver(raw))
    got = cafe.monthly_running_total(gold).collect()
    assert [(r["Month_Name"], r["Transactions"], r["Running_Total"]) for r in got] == [
        ("Jan", 2, Decimal("11.50")),
        ("Feb", 2, Decimal("24.50")),
        ("Apr", 1, Decimal("24.50")),
    ]
    share = cafe.monthly_contribution(gold).collect()
    assert [r["Running_Cont_Pct"] for r in share] == ["46.94 %", "100.00 %", "100.00 %"]
    # April has no known revenue, so it has no share of its own.
    assert share[2]["Monthly_Cont_Pct"] is None


def test_pareto_leaves_out_unknown_items(raw):
    gold = cafe.cafe_silver(raw)
    assert [r["Item"] for r in cafe.item_pareto(gold).collect()] == ["Salad", "Cake", "Tea"]
    assert [r["Item"] for r in cafe.item_pareto(gold, threshold=80).collect()] == ["Salad", "Cake"]
