"""Cafe sales: cleaned table, gold view and analyses."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.functions import Bin, month_name, month_start, percent, percent_text, weekday_name
from retailmart.operators.cleaning import (
    bin_column,
    fill_by_product,
    fill_from_lookup,
    sentinels_to_label,
    strip_prefix,
)
from retailmart.operators.quality import category_frequency, range_profile
from retailmart.operators.ranking import top_rows
from retailmart.operators.running import pareto, running_total
from retailmart.operators.totals import (
    add_shares,
    average_order_value,
    grand_totals,
    group_totals,
)

# Fixed values.
ID_PREFIX = "TXN_"
SENTINELS = ("ERROR", "UNKNOWN")
NA = "NA"
ITEM_PRICES = {
    "Salad": Decimal("5"),
    "Juice": Decimal("3"),
    "Tea": Decimal("1.5"),
    "Cookie": Decimal("1"),
    "Smoothie": Decimal("4"),
    "Coffee": Decimal("2"),
    "Sandwich": Decimal("4"),
    "Cake": Decimal("3"),
}
# Prices that belong to one item only.
PRICE_ITEMS = {
    Decimal("5"): "Salad",
    Decimal("1.5"): "Tea",
    Decimal("1"): "Cookie",
    Decimal("2"): "Coffee",
}
# The published analysis maps 1.5 to Salad; its figures rest on that.
PARITY_PRICE_ITEMS = {**PRICE_ITEMS, Decimal("1.5"): "Salad"}
SPEND_BINS = (Bin("Low", high=5), Bin("Medium", 5, 15))
SPEND_REST = "High"
GOLD_COLUMNS = (
    "Transaction_ID",
    "Item",
    "Quantity",
    "Price_Per_Unit",
    "Total_Spent",
    "Payment_Method",
    "Location",
    "Transaction_Date",
)


def cafe_silver(raw: DataFrame, parity: bool = False) -> DataFrame:
    """Clean the raw table in the order the steps depend on each other; no shuffle.

    ``parity`` takes the published price-to-item mapping with its slip.
    """
    df = strip_prefix(raw, "Transaction_ID", ID_PREFIX)
    df = sentinels_to_label(df, ["Item"], SENTINELS, NA)
    df = fill_from_lookup(
        df, "Price_Per_Unit", "Item", ITEM_PRICES, F.col("Price_Per_Unit").isNull()
    )
    df = fill_from_lookup(
        df,
        "Item",
        "Price_Per_Unit",
        PARITY_PRICE_ITEMS if parity else PRICE_ITEMS,
        F.col("Item") == NA,
    )
    df = fill_by_product(df, "Total_Spent", "Quantity", "Price_Per_Unit")
    return sentinels_to_label(df, ["Payment_Method", "Location"], SENTINELS, NA)


def gold_cafe_sales(silver: DataFrame) -> DataFrame:
    return silver.select(*GOLD_COLUMNS)


def item_price_range(gold: DataFrame) -> DataFrame:
    return range_profile(
        gold,
        {"Max_Price": ("max", "Price_Per_Unit"), "Min_Price": ("min", "Price_Per_Unit")},
        ["Item"],
    )


def item_spend_range(gold: DataFrame) -> DataFrame:
    return range_profile(
        gold, {"Max_Spent": ("max", "Total_Spent"), "Min_Spent": ("min", "Total_Spent")}, ["Item"]
    )


def avg_price(gold: DataFrame) -> DataFrame:
    return range_profile(
        gold, {"Avg_Price": ("avg", "Price_Per_Unit")}, digits={"Avg_Price": 2}
    )


def avg_spend(gold: DataFrame) -> DataFrame:
    return range_profile(gold, {"Avg_Spend": ("avg", "Total_Spent")}, digits={"Avg_Spend": 2})


def _item_totals(gold: DataFrame) -> DataFrame:
    return group_totals(
        gold, ["Item"], {"Total_Quantity_Sold": "Quantity", "Total_Spent_all": "Total_Spent"}
    )


def top_items_by_quantity(gold: DataFrame, n: int = 3) -> DataFrame:
    return top_rows(_item_totals(gold), "Total_Quantity_Sold", n, ["Item"])


def bottom_items_by_quantity(gold: DataFrame, n: int = 3) -> DataFrame:
    return top_rows(_item_totals(gold), "Total_Quantity_Sold", n, ["Item"], descending=False)


def top_items_by_revenue(gold: DataFrame, n: int = 3) -> DataFrame:
    totals = group_totals(gold, ["Item"], {"total_spent_sum": "Total_Spent"}, count="_rows")
    # As in ``pareto``, a condition that stays above the aggregate.
    known = totals.filter(F.when(F.col("Item") != NA, F.col("_rows")) > 0).drop("_rows")
    return top_rows(known, "total_spent_sum", n, ["Item"])


def orders_by_payment(gold: DataFrame) -> DataFrame:
    return category_frequency(gold, "Payment_Method", "num_of_orders")


def orders_by_location(gold: DataFrame) -> DataFrame:
    return category_frequency(gold, "Location", "num_of_orders")


def payment_by_location(gold: DataFrame) -> DataFrame:
    known = gold.filter((F.col("Payment_Method") != NA) & (F.col("Location") != NA))
    return group_totals(
        known, ["Payment_Method", "Location"], {}, count="number_of_orders"
    ).orderBy("Location", "Payment_Method")


def _monthly(gold: DataFrame, count: str | None = None) -> DataFrame:
    return group_totals(
        gold.filter(F.col("Transaction_Date").isNotNull()),
        [month_start(F.col("Transaction_Date")).alias("Sales_Month")],
        {"Monthly_Revenue": "Total_Spent"},
        count,
    )


def monthly_running_total(gold: DataFrame) -> DataFrame:
    running = running_total(
        _monthly(gold, "Transactions"),
        "Sales_Month",
        "Monthly_Revenue",
        "Running_Total",
        calendar_order=True,
    )
    return running.withColumn("Month_Name", month_name(F.col("Sales_Month"))).orderBy("Sales_Month")


def monthly_contribution(gold: DataFrame) -> DataFrame:
    """Share and cumulative share per month, as numbers and as text with ``%``."""
    monthly = _monthly(gold)
    whole = grand_totals(monthly, ["Monthly_Revenue"])["Monthly_Revenue"]
    running = running_total(
        monthly, "Sales_Month", "Monthly_Revenue", "Running_Revenue", calendar_order=True
    )
    share = percent(F.col("Monthly_Revenue"), whole)
    upto = percent(F.col("Running_Revenue"), whole)
    return running.select(
        "Sales_Month",
        share.alias("Monthly_Cont"),
        upto.alias("Running_Cont"),
        percent_text(share).alias("Monthly_Cont_Pct"),
        percent_text(upto).alias("Running_Cont_Pct"),
    ).orderBy("Sales_Month")


def weekday_sales(gold: DataFrame) -> DataFrame:
    """Grouped by the number of the weekday; only seven names are formatted."""
    totals = group_totals(
        gold.filter(F.col("Transaction_Date").isNotNull()),
        [F.weekday("Transaction_Date").alias("day")],
        {"Weekday_Spent": "Total_Spent"},
        counts={"Total_Transactions": "Total_Spent"},
    ).filter(F.col("Total_Transactions") > 0)
    monday = F.lit("2024-01-01").cast("date")
    return totals.select(
        weekday_name(F.date_add(monday, F.col("day"))).alias("Days_of_week"),
        F.col("Weekday_Spent").alias("Total_Spent"),
        "Total_Transactions",
    ).orderBy(F.col("Total_Spent").desc(), "Days_of_week")


def overall_aov(gold: DataFrame) -> DataFrame:
    return average_order_value(gold, "Total_Spent", out="AOV", digits=1)


def monthly_aov(gold: DataFrame) -> DataFrame:
    dated = gold.filter(F.col("Transaction_Date").isNotNull())
    month = month_start(F.col("Transaction_Date")).alias("Sales_Month")
    return average_order_value(dated, "Total_Spent", [month], "Monthly_AOV").orderBy("Sales_Month")


def location_aov(gold: DataFrame) -> DataFrame:
    known = gold.filter(F.col("Location") != NA)
    channel = F.col("Location").alias("Channel")
    return average_order_value(known, "Total_Spent", [channel], "AOV").orderBy(
        F.col("AOV").desc(), "Channel"
    )


def payment_aov(gold: DataFrame) -> DataFrame:
    known = gold.filter(F.col("Payment_Method") != NA)
    return average_order_value(known, "Total_Spent", ["Payment_Method"], "AOV").orderBy(
        F.col("AOV").desc(), "Payment_Method"
    )


def item_pareto(gold: DataFrame, threshold: float | None = None) -> DataFrame:
    """The items of a menu are few, however many are sold."""
    return pareto(
        gold,
        "Item",
        "Total_Spent",
        "Item_Revenue",
        "Revenue_Pct",
        "Cumulative_Revenue_Pct",
        threshold,
        leave_out=NA,
        few_keys=True,
    ).orderBy(F.col("Item_Revenue").desc(), "Item")


def payment_revenue_share(gold: DataFrame) -> DataFrame:
    totals = group_totals(
        gold.filter(F.col("Payment_Method") != NA),
        ["Payment_Method"],
        {"Payment_Revenue": "Total_Spent"},
    ).filter(F.col("Payment_Revenue").isNotNull())
    return add_shares(totals, {"Revenue_Pct": "Payment_Revenue"}).orderBy(
        F.col("Payment_Revenue").desc(), "Payment_Method"
    )


def spend_buckets(gold: DataFrame) -> DataFrame:
    """Counts and sums skip the rows of unknown amount, whatever bucket they fall in."""
    totals = group_totals(
        bin_column(gold, "Total_Spent", SPEND_BINS, SPEND_REST, "Spend_Category"),
        ["Spend_Category"],
        {"Revenue": "Total_Spent"},
        counts={"Transactions": "Total_Spent"},
    ).filter(F.col("Transactions") > 0)
    return add_shares(
        totals, {"Transaction_Pct": "Transactions", "Revenue_Pct": "Revenue"}
    ).orderBy(F.col("Revenue").desc(), "Spend_Category")
