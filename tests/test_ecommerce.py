from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailmart.plans import ecommerce as plan
from retailmart.plans import ecommerce_analyses as an
from retailmart.sources import schemas


@pytest.fixture(scope="module")
def staged(spark):
    def frame(schema, *data):
        return spark.createDataFrame(list(data), schema)

    d = Decimal
    return plan.Ecommerce(
        campaigns=frame(
            schemas.CAMPAIGNS_STAGED,
            (1, "Email", "Retention", "1/1/2023", "11/01/2023", "All", 0.153),
            (2, "Social", "Awareness", "05/02/2023", "25/2/2023", "New Customers", 0.2),
            (3, "Email", "Awareness", "05/02/2023", "05/02/2023", "All", 0.1),
        ),
        customers=frame(
            schemas.CUSTOMERS,
            (1, dt.date(2021, 1, 1), "US", 24, "Male", "Gold", "Email"),
            (2, dt.date(2021, 1, 2), "UK", 25, "Female", "Silver", "Social"),
            (3, dt.date(2021, 1, 3), "US", None, "Other", "Silver", "Social"),
        ),
        products=frame(
            schemas.PRODUCTS,
            (1, "Home", "Brand_1", d("50.00"), dt.date(2021, 1, 1), 0),
            (2, "Sports", "Brand_22", d("200.00"), dt.date(2021, 1, 1), 1),
        ),
        events=frame(
            schemas.EVENTS_STAGED,
            (1, "01/01/2023 10:00", 1, 1, "view", 1, "mobile", "Email", 0, "PDP", d("10.00"), "A"),
            (2, "01/01/2023 10:01", 1, 1, "add_to_cart", 1, None, "Email", 1, "PDP", d("20.05"), "A"),
            (3, "01/01/2023 10:02", 9, 2, "view", 2, "mobile", "Email", 8, "PDP", None, "A"),
            (4, "01/01/2023 10:03", 2, 3, "click", 0, "mobile", "Email", 1, "PDP", d("5.00"), "A"),
        ),
        transactions=frame(
            schemas.TRANSACTIONS_STAGED,
            (1, "31/01/2023 23:57", 1, 1, 2, d("0.00"), d("100.04"), 0, 0),
            (2, "01/02/2023 00:05", 1, 2, 1, d("0.10"), d("-40.00"), 1, 1),
            (3, "01/02/2023 0:06", 2, 1, 1, d("0.10"), d("50.01"), 1, 0),
            (4, "01/04/2023 0:07", 2, 0, 3, d("0.00"), None, 2, 0),
            (5, "01/04/2023 0:08", 3, 7, 1, None, d("10.00"), 3, 0),
            (6, "01/04/2023 0:09", 3, 2, 1, None, d("30.00"), 3, 0),
        ),
    )


@pytest.fixture(scope="module")
def shop(staged):
    return plan.ecommerce_silver(staged)


def test_silver(shop, rows):
    assert rows(shop.campaigns, "campaign_id", "expected_uplift_pct", "campaigns_duration_days") == [
        (0, Decimal("0.00"), 0),
        (1, Decimal("15.00"), 10),
        (2, Decimal("20.00"), 20),
        (3, Decimal("10.00"), 0),
    ]
    assert rows(shop.products, "brand") == [("1",), ("22",)]
    assert rows(shop.customers, "age_group") == [("18-24",), ("25-34",), ("55+",)]
    assert rows(shop.events, "event_type") == [("cart",), ("click",), ("view",), ("view",)]
    assert rows(shop.events, "event_id", "product_id", "campaign_id")[3] == (4, None, 1)
    assert rows(shop.transactions, "transaction_id", "valid_transaction_flag")[3] == (4, 0)
    assert shop.transactions.schema["transaction_timestamp"].dataType.simpleString() == "timestamp_ntz"
    assert shop.transactions.filter("campaign_id is null").count() == 0


def test_sales_base_wants_known_products(shop, rows):
    got = rows(plan.sales_base(shop), "customer_id", "product_id", "objective", "transaction_date")
    assert got == [
        (1, 1, "Unknown", dt.date(2023, 1, 31)),
        (1, 2, "Retention", dt.date(2023, 2, 1)),
        (2, 1, "Retention", dt.date(2023, 2, 1)),
        (3, 2, "Awareness", dt.date(2023, 4, 1)),
    ]


def test_refunds_can_be_left_out(shop):
    assert plan.sales_base(shop, exclude_refunds=True).count() == 3
    assert plan.time_sales(shop, exclude_refunds=True).agg(F.sum("total_revenue")).first()[0] == Decimal("190.05")
    assert plan.customer_behavior(shop, exclude_refunds=True).filter("customer_id = 1").first()["total_orders"] == 1


def test_revenue_is_rounded_per_product(shop, rows):
    got = rows(plan.product_performance(shop), "product_id", "total_units_sold", "total_revenue")
    # 150.05 to one place, half away from zero.
    assert got == [(1, 3, Decimal("150.1")), (2, 2, Decimal("-10.0"))]


def test_daily_revenue_is_the_facts_revenue(shop):
    days = plan.time_sales(shop).agg(F.sum("total_revenue"), F.sum("total_transactions")).first()
    assert tuple(days) == (Decimal("150.05"), 5)


def test_campaign_view_leaves_out_the_unknown(shop, rows):
    assert rows(plan.campaign_performance(shop), "campaign_id") == [(1,), (1,), (3,), (3,)]


def test_event_view_keeps_orphans_with_null_keys(shop, rows):
    got = rows(plan.event_behavior(shop), "event_id", "customer_id", "campaign_id", "channel")
    assert got == [(1, 1, 0, "Unknown"), (2, 1, 1, "Email"), (3, None, None, None)]
    narrow = plan.event_behavior(shop, ["event_type"])
    assert "Join" not in narrow._jdf.queryExecution().optimizedPlan().toString()


def test_discount_labels(shop, rows):
    right = rows(an.discount_impact(shop), "discount_status", "Total_transactions")
    swapped = rows(
        an.discount_impact(shop, an.PARITY_DISCOUNT_LABELS), "discount_status", "Total_transactions"
    )
    # A NULL discount counts as discounted, as in the published query.
    assert right == [("No", 1), ("Yes", 3)]
    assert swapped == [("No", 3), ("Yes", 1)]


def test_ab_labels(shop, rows):
    got = rows(an.campaign_ab(shop, an.PARITY_AB_LABELS), "campaign_group_test", "discount_status")
    assert got == [("Control - No Campaing", "No Discount"), ("Treatment - Campaing", "Yes Discount")]


def test_kpis(shop):
    got = an.kpi_dashboard(shop).first()
    assert got["total_transactions"] == 4
    assert got["total_customers"] == 3
    assert got["total_revenue"] == Decimal("140.05")
    assert got["avg_order_value"] == Decimal("35.01")
    assert got["discounted_orders"] == 2
    assert got["discount_penetration_pct"] == Decimal("50.00")


def test_kpis_of_nothing(shop):
    none = replace(shop, transactions=shop.transactions.limit(0))
    got = an.kpi_dashboard(none).first()
    assert (got["total_transactions"], got["avg_order_value"], got["discount_penetration_pct"]) == (0, None, None)


def test_campaign_efficiency_without_days(shop, rows):
    got = rows(an.campaign_efficiency(shop), "campaign_id", "revenue_per_day", "channel_rank")
    assert got == [(1, Decimal("1.00"), 1), (3, None, 2)]


def test_channel_share(shop, rows):
    got = rows(
        an.channel_share(shop, distinct_campaigns=True),
        "channel",
        "campaigns",
        "total_revenue",
        "revenue_share_pct",
        "distinct_campaigns",
    )
    assert got == [("Email", 4, Decimal("50.01"), 100.0, 2)]


def test_month_over_month(shop):
    got = an.month_over_month(plan.time_sales(shop)).collect()
    assert [(r["sales_month"], r["previous_month_revenue"]) for r in got] == [
        (1, None),
        (2, Decimal("100.04")),
        (4, Decimal("10.01")),
    ]
    filled = an.month_over_month(plan.time_sales(shop), fill_calendar=True).collect()
    assert [r["sales_month"] for r in filled] == [1, 2, 3, 4]


def test_segments_take_spenders_only(spark, rows):
    spent = ["99.99", "100", "300", "300.01", "0", "-5"]
    df = spark.createDataFrame([(Decimal(s),) for s in spent], "total_spent decimal(20,2)")
    assert rows(an.customer_segments(df), "customer_segment", "customers") == [
        ("High Value", 1),
        ("Low Value", 1),
        ("Medium Value", 2),
    ]


def test_price_of_one_hundred_is_mid(spark, rows):
    df = spark.createDataFrame(
        [(1, Decimal("100"), 1, Decimal("5.0")), (2, None, 1, Decimal("5.0"))],
        "product_id int, base_price decimal(18,2), total_units_sold bigint, total_revenue decimal(20,1)",
    )
    assert rows(an.price_segments(df), "price_segment") == [("Extreme High Price",), ("Mid Price",)]


def test_durations(shop, rows):
    assert rows(an.session_duration_by_age(shop)) == [
        ("18-24", Decimal("15.03")),
        (None, None),
    ]
    assert rows(an.channel_funnel_counts(shop)) == [
        ("Email", "cart", 1),
        ("Unknown", "view", 1),
        (None, "view", 1),
    ]


def test_gold_views_by_name(shop):
    assert set(plan.gold_views(shop)) == {
        "sales_base",
        "product_performance",
        "campaign_performance",
        "time_sales",
        "customer_behavior",
        "event_behavior",
    }
