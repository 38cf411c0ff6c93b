"""E-commerce star schema: staged files to cleaned tables to gold views."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.functions import Bin, parse_dmy_date, parse_dmy_timestamp, ratio
from retailmart.operators.cleaning import (
    after_first,
    after_last,
    bin_column,
    duration_days,
    null_to_default,
    scale_and_rename,
    sentinel_to_null,
    validity_flag,
)
from retailmart.operators.joins import join_dimension
from retailmart.operators.totals import exact_sum, group_totals
from retailmart.sources.files import add_unknown_member, type_staging

# Fixed values.
NO_CAMPAIGN = 0
UNKNOWN = "Unknown"
UNKNOWN_CAMPAIGN = {
    "campaign_id": NO_CAMPAIGN,
    "channel": UNKNOWN,
    "objective": UNKNOWN,
    "target_segment": UNKNOWN,
    "expected_uplift_pct": 0,
    "campaigns_duration_days": 0,
}
AGE_BINS = (Bin("18-24", high=25), Bin("25-34", 25, 34), Bin("35-44", 35, 44), Bin("45-54", 45, 54))
AGE_REST = "55+"

SALES_COLUMNS = (
    "transaction_date",
    "customer_id",
    "product_id",
    "quantity",
    "discount_applied",
    "gross_revenue",
    "campaign_id",
    "objective",
)
EVENT_COLUMNS = (
    "event_id",
    "customer_id",
    "campaign_id",
    "age_group",
    "channel",
    "session_duration_sec",
    "event_type",
)


@dataclass(frozen=True)
class Ecommerce:
    """The five tables of the star schema."""

    campaigns: DataFrame
    customers: DataFrame
    products: DataFrame
    events: DataFrame
    transactions: DataFrame


def type_ecommerce(staged: Ecommerce) -> Ecommerce:
    """Text dates to dates, key 0 to NULL, the uplift to two places."""

    def typed_fact(df: DataFrame, time: str) -> DataFrame:
        return sentinel_to_null(
            type_staging(df, {time: parse_dmy_timestamp}), {"product_id": 0, "campaign_id": 0}
        )

    return Ecommerce(
        campaigns=type_staging(
            staged.campaigns,
            {
                "start_date": parse_dmy_date,
                "end_date": parse_dmy_date,
                "expected_uplift": "decimal(5,2)",
            },
        ),
        customers=staged.customers,
        products=staged.products,
        events=typed_fact(staged.events, "events_timestamp"),
        transactions=typed_fact(staged.transactions, "transaction_timestamp"),
    )


def clean_campaigns(typed: DataFrame) -> DataFrame:
    df = scale_and_rename(typed, "expected_uplift", "expected_uplift_pct", 100, 2)
    df = duration_days(df, "start_date", "end_date", "campaigns_duration_days")
    return add_unknown_member(df, "campaign_id", UNKNOWN_CAMPAIGN)


def clean_customers(typed: DataFrame) -> DataFrame:
    return bin_column(typed, "age", AGE_BINS, AGE_REST, "age_group")


def clean_products(typed: DataFrame, brand_delim: str = "_") -> DataFrame:
    return after_first(typed, "brand", brand_delim)


def clean_events(typed: DataFrame) -> DataFrame:
    return null_to_default(after_last(typed, "event_type", "_"), {"campaign_id": NO_CAMPAIGN})


def clean_transactions(typed: DataFrame) -> DataFrame:
    df = null_to_default(typed, {"campaign_id": NO_CAMPAIGN})
    return validity_flag(df, ["product_id", "gross_revenue"], "valid_transaction_flag")


def clean_ecommerce(typed: Ecommerce, brand_delim: str = "_") -> Ecommerce:
    return Ecommerce(
        campaigns=clean_campaigns(typed.campaigns),
        customers=clean_customers(typed.customers),
        products=clean_products(typed.products, brand_delim),
        events=clean_events(typed.events),
        transactions=clean_transactions(typed.transactions),
    )


def ecommerce_silver(staged: Ecommerce, brand_delim: str = "_") -> Ecommerce:
    """Staged files to cleaned tables; both facts stay one narrow stage behind their scan."""
    return clean_ecommerce(type_ecommerce(staged), brand_delim)


def without_refunds(shop: Ecommerce) -> Ecommerce:
    """The shop without refunded transactions, for any view or analysis."""
    return Ecommerce(
        shop.campaigns,
        shop.customers,
        shop.products,
        shop.events,
        shop.transactions.filter(F.col("refund_flag") == 0),
    )


def _with_revenue(transactions: DataFrame, exclude_refunds: bool) -> DataFrame:
    known = transactions.filter(F.col("gross_revenue").isNotNull())
    if exclude_refunds:
        known = known.filter(F.col("refund_flag") == 0)
    return known


def sales_base(
    shop: Ecommerce,
    columns: Sequence[str] = SALES_COLUMNS,
    exclude_refunds: bool = False,
) -> DataFrame:
    """Transactions of known products, with the campaign's objective.

    The campaign join is made only when ``objective`` is among ``columns``.
    """
    t = shop.transactions
    if exclude_refunds:
        t = t.filter(F.col("refund_flag") == 0)
    t = t.withColumn("transaction_date", F.col("transaction_timestamp").cast("date"))
    own = [c for c in SALES_COLUMNS if c != "objective"]
    needed = {*columns, "product_id"} | ({"campaign_id"} if "objective" in columns else set())
    df = join_dimension(
        t.select(*[c for c in own if c in needed]), shop.products, "product_id", "left_semi"
    )
    if "objective" in columns:
        df = join_dimension(df, shop.campaigns.select("campaign_id", "objective"), "campaign_id")
    return df.select(*columns)


def product_performance(shop: Ecommerce, exclude_refunds: bool = False) -> DataFrame:
    """Units and revenue per product, the revenue rounded to one place per product.

    The fact is folded to one row per product before the product table joins.
    """
    sold = group_totals(
        _with_revenue(shop.transactions, exclude_refunds).filter(F.col("product_id").isNotNull()),
        ["product_id"],
        {"total_units_sold": "quantity", "_revenue": "gross_revenue"},
    )
    return sold.join(
        shop.products.select("product_id", "base_price", "category"), "product_id"
    ).select(
        "product_id",
        "base_price",
        "category",
        "total_units_sold",
        F.round("_revenue", 1).alias("total_revenue"),
    )


def campaign_performance(shop: Ecommerce, exclude_refunds: bool = False) -> DataFrame:
    """Transactions with revenue beside their campaign; the unknown campaign is left out."""
    known = shop.campaigns.filter(F.col("channel") != UNKNOWN)
    return join_dimension(
        _with_revenue(shop.transactions, exclude_refunds).select(
            "campaign_id", "quantity", "gross_revenue"
        ),
        known.select("campaign_id", "channel", "target_segment", "campaigns_duration_days"),
        "campaign_id",
        "inner",
    ).select(
        "campaign_id",
        "channel",
        "target_segment",
        "quantity",
        "gross_revenue",
        "campaigns_duration_days",
    )


def time_sales(shop: Ecommerce, exclude_refunds: bool = False) -> DataFrame:
    """Transactions, units and revenue per day."""
    day = F.col("transaction_timestamp").cast("date").alias("transaction_date")
    daily = group_totals(
        _with_revenue(shop.transactions, exclude_refunds),
        [day],
        {"total_units_sold": "quantity", "total_revenue": "gross_revenue"},
        counts={"total_transactions": "transaction_id"},
    )
    return daily.select(
        "transaction_date",
        F.year("transaction_date").alias("sales_year"),
        F.month("transaction_date").alias("sales_month"),
        "total_transactions",
        "total_units_sold",
        "total_revenue",
    )


def customer_behavior(shop: Ecommerce, exclude_refunds: bool = False) -> DataFrame:
    """Orders, spend and mean order value per customer.

    The fact is folded to one row per customer before the customer table joins.
    """
    bought = _with_revenue(shop.transactions, exclude_refunds)
    spent = exact_sum(bought, "gross_revenue")
    per_customer = bought.groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_orders"),
        spent.alias("total_spent"),
        ratio(spent, F.count("gross_revenue"), 2).alias("avg_order_value"),
    )
    return per_customer.join(
        shop.customers.select("customer_id", "country", "age_group"), "customer_id"
    ).select(
        "customer_id", "country", "age_group", "total_orders", "total_spent", "avg_order_value"
    )


def event_behavior(shop: Ecommerce, columns: Sequence[str] = EVENT_COLUMNS) -> DataFrame:
    """Events with a product beside customer and campaign attributes.

    ``customer_id`` and ``campaign_id`` are those of the dimension rows, NULL where
    there is none. Joins that ``columns`` does not need are not made.
    """
    wanted = set(columns)
    df = shop.events.filter(F.col("product_id").isNotNull())
    own = [c for c in EVENT_COLUMNS if c in df.columns and c in wanted]
    by_customer = bool(wanted & {"customer_id", "age_group"})
    by_campaign = bool(wanted & {"campaign_id", "channel"})
    keys = (["customer_id"] if by_customer else []) + (["campaign_id"] if by_campaign else [])
    df = df.select(*dict.fromkeys([*keys, *own]))
    if by_customer:
        dim = shop.customers.select(
            "customer_id", "age_group", F.col("customer_id").alias("_customer")
        )
        df = join_dimension(df, dim, "customer_id")
        df = df.withColumn("customer_id", F.col("_customer"))
    if by_campaign:
        dim = shop.campaigns.select(
            "campaign_id", "channel", F.col("campaign_id").alias("_campaign")
        )
        df = join_dimension(df, dim, "campaign_id")
        df = df.withColumn("campaign_id", F.col("_campaign"))
    return df.select(*columns)


def gold_views(shop: Ecommerce) -> dict[str, DataFrame]:
    """All six gold frames by name, e.g. for ``register_views``."""
    return {
        "sales_base": sales_base(shop),
        "product_performance": product_performance(shop),
        "campaign_performance": campaign_performance(shop),
        "time_sales": time_sales(shop),
        "customer_behavior": customer_behavior(shop),
        "event_behavior": event_behavior(shop),
    }
