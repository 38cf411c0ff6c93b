"""Analyses over the e-commerce gold views.

Figures per product, day or customer take the gold frame. Figures per dimension
attribute of a fact (channel, segment, objective, age group) take the cleaned
tables, so that the fact can be folded to one row per key ahead of the join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmart.functions import Bin, percent, ratio
from retailmart.operators.cleaning import bin_column
from retailmart.operators.funnels import funnel
from retailmart.operators.periods import period_change
from retailmart.operators.ranking import top_ranked, top_rows
from retailmart.operators.totals import (
    add_shares,
    contribution,
    exact_mean,
    exact_sum,
    group_totals,
    totals_by_attribute,
)
from retailmart.plans.ecommerce import (
    NO_CAMPAIGN,
    UNKNOWN,
    Ecommerce,
    event_behavior,
    sales_base,
)

# Fixed values.
PRICE_BINS = (
    Bin("Low Price", high=50),
    Bin("Mid Price", 50, 100),
    Bin("High Price", 100, 200),
)
PRICE_REST = "Extreme High Price"
SPENDING_BINS = (Bin("Low Value", high=100), Bin("Medium Value", 100, 300))
SPENDING_REST = "High Value"
FUNNEL_STEPS = (
    ("view", "views"),
    ("click", "clicks"),
    ("cart", "carts"),
    ("purchase", "purchases"),
)
FUNNEL_RATES = (
    "view_to_click_rate_pct",
    "click_to_cart_rate_pct",
    "cart_to_purchase_rate_pct",
)
DISCOUNT_LABELS = ("No", "Yes")
# The published discount analysis has the two labels the wrong way round.
PARITY_DISCOUNT_LABELS = ("Yes", "No")
AB_LABELS = ("Control - No Campaign", "Treatment - Campaign")
# Spelt as in the published results.
PARITY_AB_LABELS = ("Control - No Campaing", "Treatment - Campaing")


def _two_way(is_first: Column, labels: Sequence[str]) -> Column:
    return F.when(is_first, labels[0]).otherwise(labels[1])


def top_transactions(shop: Ecommerce, n: int = 10) -> DataFrame:
    """Transactions whose revenue rank is at most ``n``, ties kept."""
    columns = ["transaction_date", "customer_id", "product_id", "quantity", "gross_revenue"]
    return top_ranked(sales_base(shop, columns), "gross_revenue", n, rank="revenue_rank").orderBy(
        "revenue_rank"
    )


def products_by_price(products: DataFrame) -> DataFrame:
    return products.select("base_price", "product_id").orderBy(
        F.col("base_price").desc(), "product_id"
    )


def discount_impact(shop: Ecommerce, labels: Sequence[str] = DISCOUNT_LABELS) -> DataFrame:
    """Sales by discounted or not; ``labels`` are those for no discount and for the rest."""
    sales = sales_base(shop, ["discount_applied", "quantity", "gross_revenue"])
    return sales.groupBy(
        _two_way(F.col("discount_applied") == 0, labels).alias("discount_status")
    ).agg(
        F.count("*").alias("Total_transactions"),
        F.sum("quantity").alias("total_quantity"),
        F.round(exact_sum(sales, "gross_revenue"), 2).alias("total_revenue"),
        exact_mean(sales, "gross_revenue", 2).alias("avg_order_revenue"),
    )


def discount_buckets(shop: Ecommerce) -> DataFrame:
    sales = sales_base(shop, ["discount_applied", "quantity", "gross_revenue"])
    return (
        sales.groupBy("discount_applied")
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum("quantity").alias("total_units_sold"),
            F.round(exact_sum(sales, "gross_revenue"), 2).alias("total_revenue"),
            exact_mean(sales, "gross_revenue", 2).alias("avg_order_value"),
        )
        .orderBy(F.col("total_revenue").desc(), "discount_applied")
    )


def campaign_ab(shop: Ecommerce, labels: Sequence[str] = AB_LABELS) -> DataFrame:
    """No campaign against campaign, each with and without a discount."""
    sales = sales_base(shop, ["campaign_id", "discount_applied", "quantity", "gross_revenue"])
    return sales.groupBy(
        _two_way(F.col("campaign_id") == NO_CAMPAIGN, labels).alias("campaign_group_test"),
        _two_way(F.col("discount_applied") == 0, ("No Discount", "Yes Discount")).alias(
            "discount_status"
        ),
    ).agg(
        F.count("*").alias("total_transactions"),
        F.sum("quantity").alias("total_units_sold"),
        exact_sum(sales, "gross_revenue").alias("total_revenue"),
        exact_mean(sales, "gross_revenue", 2).alias("avg_order_value"),
    )


def kpi_dashboard(shop: Ecommerce) -> DataFrame:
    """One row of key figures."""
    sales = sales_base(shop, ["customer_id", "quantity", "gross_revenue", "discount_applied"])
    discounted = F.count_if(F.col("discount_applied") > 0)
    return sales.agg(
        F.count("*").alias("total_transactions"),
        F.count_distinct("customer_id").alias("total_customers"),
        F.sum("quantity").alias("total_units_sold"),
        F.round(exact_sum(sales, "gross_revenue"), 2).alias("total_revenue"),
        exact_mean(sales, "gross_revenue", 2).alias("avg_order_value"),
        exact_mean(sales, "quantity").alias("avg_units_per_order"),
        discounted.alias("discounted_orders"),
        percent(discounted, F.count("*"), 2).cast("decimal(5,2)").alias("discount_penetration_pct"),
    )


def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    return top_rows(
        products.select("product_id", "category", "total_revenue", "total_units_sold"),
        "total_revenue",
        n,
        ["product_id"],
        rank="revenue_rank",
        dense=True,
    )


def category_performance(products: DataFrame) -> DataFrame:
    """Per category; sums the revenues already rounded per product."""
    return (
        products.groupBy("category")
        .agg(
            F.count("product_id").alias("number_of_products"),
            F.sum("total_units_sold").alias("units_sold"),
            exact_sum(products, "total_revenue").alias("category_revenue"),
            exact_mean(products, "total_revenue", 2).alias("avg_product_revenue"),
        )
        .withColumnRenamed("category_revenue", "total_revenue")
        .orderBy(F.col("total_revenue").desc(), "category")
    )


def category_share(products: DataFrame) -> DataFrame:
    return (
        contribution(
            products,
            ["category"],
            {"category_revenue": "total_revenue"},
            {"revenue_share_pct": "category_revenue"},
        )
        .withColumnRenamed("category_revenue", "total_revenue")
        .orderBy(F.col("total_revenue").desc(), "category")
    )


def price_segments(products: DataFrame) -> DataFrame:
    return (
        group_totals(
            bin_column(products, "base_price", PRICE_BINS, PRICE_REST, "price_segment"),
            ["price_segment"],
            {"units_sold": "total_units_sold", "segment_revenue": "total_revenue"},
            counts={"products": "product_id"},
        )
        .withColumnRenamed("segment_revenue", "total_revenue")
        .orderBy(F.col("total_revenue").desc(), "price_segment")
    )


def _campaign_sales(shop: Ecommerce) -> DataFrame:
    return shop.transactions.filter(F.col("gross_revenue").isNotNull())


def _by_campaign_attribute(
    shop: Ecommerce,
    attribute: str,
    sums: Mapping[str, str],
    count: str,
    key_count: str | None = None,
) -> DataFrame:
    """Totals per attribute of the known campaigns."""
    return totals_by_attribute(
        _campaign_sales(shop),
        shop.campaigns.filter(F.col("channel") != UNKNOWN),
        "campaign_id",
        [attribute],
        sums,
        count=count,
        how="inner",
        key_count=key_count,
    )


def top_campaigns(shop: Ecommerce, n: int = 10) -> DataFrame:
    known = shop.campaigns.filter(F.col("channel") != UNKNOWN).select("campaign_id")
    totals = group_totals(
        _campaign_sales(shop), ["campaign_id"], {"total_revenue": "gross_revenue"}
    )
    return top_rows(
        totals.join(known, "campaign_id", "left_semi"),
        "total_revenue",
        n,
        ["campaign_id"],
        rank="revenue_rank",
    )


def channel_share(shop: Ecommerce, distinct_campaigns: bool = False) -> DataFrame:
    """Transactions (under the published name ``campaigns``), revenue and share per channel.

    ``distinct_campaigns`` adds the number of campaigns that sold something.
    """
    distinct = "distinct_campaigns" if distinct_campaigns else None
    totals = _by_campaign_attribute(
        shop, "channel", {"total_revenue": "gross_revenue"}, "campaigns", distinct
    )
    shares = add_shares(
        totals, {"revenue_share_pct": "total_revenue"}, digits=None, summed=totals.columns[1:]
    )
    return shares.orderBy(F.col("total_revenue").desc(), "channel")


def objective_performance(shop: Ecommerce) -> DataFrame:
    """Sales per campaign objective, the unknown one included."""
    totals = totals_by_attribute(
        sales_base(shop, ["campaign_id", "quantity", "gross_revenue"]),
        shop.campaigns,
        "campaign_id",
        ["objective"],
        {"units_sold": "quantity", "total_revenue": "gross_revenue"},
        count="transactions",
        counts={"valued": "gross_revenue"},
    )
    shared = add_shares(
        totals,
        {"revenue_share_pct": "total_revenue"},
        digits=None,
        summed=["units_sold", "total_revenue", "transactions", "valued"],
    )
    return shared.select(
        "objective",
        "transactions",
        "units_sold",
        F.round("total_revenue", 2).alias("total_revenue"),
        "revenue_share_pct",
        ratio(F.col("total_revenue"), F.col("valued"), 2).alias("avg_order_value"),
    ).orderBy(F.col("total_revenue").desc(), "objective")


def segment_performance(shop: Ecommerce) -> DataFrame:
    totals = _by_campaign_attribute(
        shop,
        "target_segment",
        {"units_sold": "quantity", "total_revenue": "gross_revenue"},
        "transactions",
    )
    return totals.withColumn(
        "avg_order_value", ratio(F.col("total_revenue"), F.col("transactions"))
    ).orderBy(F.col("total_revenue").desc(), "target_segment")


def campaign_efficiency(shop: Ecommerce, n: int = 3) -> DataFrame:
    """Per channel the campaigns ranked at most ``n`` by revenue per campaign day."""
    totals = group_totals(
        _campaign_sales(shop), ["campaign_id"], {"total_revenue": "gross_revenue"}
    )
    known = shop.campaigns.filter(F.col("channel") != UNKNOWN)
    days = F.col("campaigns_duration_days")
    per_day = totals.join(
        known.select("campaign_id", "channel", "campaigns_duration_days"), "campaign_id"
    ).select(
        "campaign_id",
        "channel",
        "campaigns_duration_days",
        "total_revenue",
        ratio(F.col("total_revenue"), days, 2).alias("revenue_per_day"),
        ratio(F.col("total_revenue"), days).alias("_per_day"),
    )
    return top_ranked(per_day, "_per_day", n, ["channel"], rank="channel_rank", few_rows=True).drop("_per_day")


def _calendar_share(days: DataFrame, key: str, prefix: str) -> DataFrame:
    names = {
        f"{prefix}_revenue": "total_revenue",
        f"{prefix}_transactions": "total_transactions",
        f"{prefix}_units": "total_units_sold",
    }
    return contribution(days, [key], names, {"revenue_pct": f"{prefix}_revenue"}).orderBy(key)


def seasonality_month(days: DataFrame) -> DataFrame:
    """Per calendar month over all years."""
    return _calendar_share(days, "sales_month", "monthly")


def yearly_trend(days: DataFrame) -> DataFrame:
    return _calendar_share(days, "sales_year", "yearly")


def month_over_month(days: DataFrame, fill_calendar: bool = False) -> DataFrame:
    monthly = group_totals(
        days,
        [F.trunc("transaction_date", "MM").alias("month")],
        {"monthly_revenue": "total_revenue"},
    )
    changed = period_change(
        monthly,
        "month",
        "monthly_revenue",
        "previous_month_revenue",
        "revenue_change_pct",
        fill_calendar,
    )
    return changed.select(
        F.year("month").alias("sales_year"),
        F.month("month").alias("sales_month"),
        "monthly_revenue",
        "previous_month_revenue",
        "revenue_change_pct",
    ).orderBy("sales_year", "sales_month")


def quarterly_demand(days: DataFrame) -> DataFrame:
    return group_totals(
        days,
        ["sales_year", F.quarter("transaction_date").alias("sales_quarter")],
        {
            "quarterly_transactions": "total_transactions",
            "quarterly_units": "total_units_sold",
        },
    ).orderBy("sales_year", "sales_quarter")


def customer_segments(customers: DataFrame) -> DataFrame:
    """Low, medium and high value customers, among those who spent anything."""
    spenders = bin_column(
        customers.filter(F.col("total_spent") > 0),
        "total_spent",
        SPENDING_BINS,
        SPENDING_REST,
        "customer_segment",
    )
    return (
        spenders.groupBy("customer_segment")
        .agg(
            F.count("*").alias("customers"),
            exact_mean(spenders, "total_spent", 2).alias("avg_spending"),
            F.round(exact_sum(spenders, "total_spent"), 2).alias("segment_spent"),
        )
        .withColumnRenamed("segment_spent", "total_spent")
        .orderBy(F.col("avg_spending").desc(), "customer_segment")
    )


def top_customers(customers: DataFrame, n: int = 10) -> DataFrame:
    return top_rows(
        customers.select("customer_id", "country", "age_group", "total_spent"),
        "total_spent",
        n,
        ["customer_id"],
        rank="spending_rank",
    )


def country_performance(customers: DataFrame) -> DataFrame:
    """Per country; ``avg_order_value`` is the plain mean of the customers' rounded means."""
    return customers.groupBy("country").agg(
        F.count("*").alias("customers"),
        F.sum("total_orders").alias("total_orders"),
        F.round(exact_sum(customers, "total_spent"), 2).alias("total_revenue"),
        exact_mean(customers, "avg_order_value", 2).alias("avg_order_value"),
    ).orderBy(F.col("total_revenue").desc(), "country")


def age_group_spend(customers: DataFrame) -> DataFrame:
    """Per age group; ``avg_order_value`` as in ``country_performance``."""
    return customers.groupBy("age_group").agg(
        F.count("*").alias("customers"),
        F.round(exact_sum(customers, "total_spent"), 2).alias("total_revenue"),
        exact_mean(customers, "avg_order_value", 2).alias("avg_order_value"),
    ).orderBy(F.col("total_revenue").desc(), "age_group")


def event_distribution(shop: Ecommerce) -> DataFrame:
    return contribution(
        event_behavior(shop, ["event_type"]),
        ["event_type"],
        {},
        {"event_pct": "total_events"},
        count="total_events",
    ).orderBy(F.col("total_events").desc(), "event_type")


def _product_events(shop: Ecommerce) -> DataFrame:
    return shop.events.filter(F.col("product_id").isNotNull())


def channel_funnel_counts(shop: Ecommerce) -> DataFrame:
    return totals_by_attribute(
        _product_events(shop),
        shop.campaigns,
        "campaign_id",
        ["channel"],
        {},
        count="events",
        also_by=["event_type"],
    ).orderBy("channel", "event_type")


def funnel_conversion(shop: Ecommerce) -> DataFrame:
    return funnel(event_behavior(shop, ["event_type"]), "event_type", FUNNEL_STEPS, FUNNEL_RATES)


def session_duration_by_event(shop: Ecommerce) -> DataFrame:
    """Mean over events: a session's duration counts once per event of the session."""
    events = event_behavior(shop, ["event_type", "session_duration_sec"])
    return events.groupBy("event_type").agg(
        F.count("*").alias("events"),
        exact_mean(events, "session_duration_sec", 2).alias("avg_session_duration_sec"),
    ).orderBy(F.col("avg_session_duration_sec").desc(), "event_type")


def _duration_by(shop: Ecommerce, dim: DataFrame, key: str, attribute: str, out: str) -> DataFrame:
    totals = totals_by_attribute(
        _product_events(shop),
        dim,
        key,
        [attribute],
        {"seconds": "session_duration_sec"},
        count="events",
        counts={"timed": "session_duration_sec"},
    )
    return totals.select(
        attribute, "events", ratio(F.col("seconds"), F.col("timed"), 2).alias(out)
    ).orderBy(F.col(out).desc(), attribute)


def engagement_by_channel(shop: Ecommerce) -> DataFrame:
    return _duration_by(
        shop, shop.campaigns, "campaign_id", "channel", "avg_session_duration_sec"
    )


def session_duration_by_age(shop: Ecommerce) -> DataFrame:
    return _duration_by(
        shop, shop.customers, "customer_id", "age_group", "avg_session_duration"
    ).drop("events")
