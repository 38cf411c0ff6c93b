"""The TPC-H-like test tables as canonical retail tables.

The expressions give the canonical tables the flaws their cleaning is about:
missing values, placeholders, refunds. All rows of the tables are used.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmart.sources.files import type_staging


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(text: Column, width: int) -> Column:
    """Zeros in front of a short text; a longer one stays whole."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def _pick(c: Column, options: dict, otherwise: object) -> Column:
    (first, value), *rest = options.items()
    out = F.when(c == first, F.lit(value))
    for key, v in rest:
        out = out.when(c == key, F.lit(v))
    return out.otherwise(F.lit(otherwise))


def _null_every(n: int, key: Column, value: Column) -> Column:
    return F.when(key % n != 0, value)


def cafe_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.col("o_custkey") % 11
    key = F.col("o_orderkey")
    quantity = 1 + key % 5
    prices = {0: 5, 1: 3, 2: Decimal("1.5"), 3: 1, 4: 4, 5: 2, 6: 4, 7: 3, 8: 5, 9: Decimal("1.5")}
    price = F.coalesce(
        _pick(item, {k: Decimal(v) for k, v in prices.items()}, None),
        2 + F.col("o_custkey") % 2,
    ).cast("decimal(10,2)")
    items = {
        0: "Salad",
        1: "Juice",
        2: "Tea",
        3: "Cookie",
        4: "Smoothie",
        5: "Coffee",
        6: "Sandwich",
        7: "Cake",
        8: "UNKNOWN",
        9: "ERROR",
    }
    payments = {
        "1-URGENT": "Cash",
        "2-HIGH": "Credit Card",
        "3-MEDIUM": "Digital Wallet",
        "4-NOT SPECIFIED": "UNKNOWN",
    }
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("TXN_"), _padded(key.cast("string"), 7)).alias("Transaction_ID"),
        _pick(item, items, None).alias("Item"),
        _null_every(13, key, quantity.cast("int")).alias("Quantity"),
        _null_every(17, key, price).alias("Price_Per_Unit"),
        _null_every(19, key, (quantity * price).cast("decimal(10,2)")).alias("Total_Spent"),
        _pick(F.col("o_orderpriority"), payments, None).alias("Payment_Method"),
        _pick(F.col("o_orderstatus"), {"F": "In-store", "O": "Takeaway"}, "ERROR").alias(
            "Location"
        ),
        _null_every(23, key, F.col("o_orderdate").cast("date")).alias("Transaction_Date"),
    )


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    start = F.date_add(F.lit("1995-01-01").cast("date"), key.cast("int"))
    objectives = {0: "Reactivation", 1: "Retention", 2: "Awareness"}
    return (
        table(spark, sf_dir, "supplier")
        .join(
            table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey"),
            "s_nationkey",
        )
        .join(
            table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"),
            "n_regionkey",
        )
        .select(
            (key + 1).cast("bigint").alias("campaign_id"),
            F.col("r_name").alias("channel"),
            _pick(key % 4, objectives, "Acquisition").alias("objective"),
            start.alias("start_date"),
            F.date_add(start, (8 + key % 82).cast("int")).alias("end_date"),
            _pick(key % 3, {0: "New Customers", 1: "Deal Seekers"}, "All").alias(
                "target_segment"
            ),
            ((key % 16) / F.lit(Decimal("100.0"))).cast("decimal(5,2)").alias("expected_uplift"),
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    channels = {0: "Organic", 1: "Paid Search", 2: "Social", 3: "Email"}
    return (
        table(spark, sf_dir, "customer")
        .join(
            table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey"),
            "c_nationkey",
        )
        .select(
            key.cast("bigint").alias("customer_id"),
            F.date_add(F.lit("1994-01-01").cast("date"), (key % 365).cast("int")).alias(
                "signup_date"
            ),
            F.col("n_name").alias("country"),
            (18 + key % 53).cast("int").alias("age"),
            _pick(key % 3, {0: "Male", 1: "Female"}, "Other").alias("gender"),
            F.col("c_mktsegment").alias("loyalty_tier"),
            _pick(key % 5, channels, "Referral").alias("acquisition_channel"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(18,2)")
    return table(spark, sf_dir, "part").select(
        key.cast("bigint").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        ((price - 900) * 4).cast("decimal(18,2)").alias("base_price"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key % 1000).cast("int")).alias(
            "launch_date"
        ),
        (key % 2).cast("int").alias("is_premium"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("l_orderkey")
    revenue = (
        F.col("l_extendedprice").cast("decimal(12,2)") * F.lit(Decimal("0.001"))
    ).cast("decimal(18,2)")
    refund = F.col("l_returnflag") == "R"
    return (
        table(spark, sf_dir, "lineitem")
        .join(
            table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey"),
            "l_orderkey",
        )
        .select(
            (order * 8 + F.col("l_linenumber")).alias("transaction_id"),
            F.col("o_orderdate").alias("transaction_timestamp"),
            F.col("o_custkey").cast("bigint").alias("customer_id"),
            _null_every(10, order, F.col("l_partkey").cast("bigint")).alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_discount").cast("decimal(4,2)").alias("discount_applied"),
            _null_every(10, order, F.when(refund, -revenue).otherwise(revenue)).alias(
                "gross_revenue"
            ),
            _null_every(5, F.col("l_suppkey"), (F.col("l_suppkey") + 1).cast("bigint")).alias(
                "campaign_id"
            ),
            F.when(refund, 1).otherwise(0).alias("refund_flag"),
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    kind = F.col("event_type")
    sources = {0: "Organic", 1: "Paid Search", 2: "Social", 3: "Email"}
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("events_timestamp"),
        F.col("user_id").cast("bigint").alias("customer_id"),
        (key % 2500).alias("session_id"),
        F.when(kind == "error", "bounce")
        .when(kind == "signup", "add_to_cart")
        .otherwise(kind)
        .alias("event_type"),
        _null_every(10, key, (key % 200).cast("bigint")).alias("product_id"),
        _null_every(50, key, _pick(key % 3, {0: "desktop", 1: "mobile"}, "tablet")).alias(
            "device_type"
        ),
        _pick(key % 5, sources, "Direct").alias("traffic_source"),
        _null_every(2, key, (1 + key % 10).cast("bigint")).alias("campaign_id"),
        _pick(key % 5, {0: "Home", 1: "PLP", 2: "PDP", 3: "Cart"}, "Checkout").alias(
            "page_category"
        ),
        F.col("value").cast("decimal(18,2)").alias("session_duration_sec"),
        _pick(key % 4, {0: "Variant_A", 1: "Variant_B"}, "Control").alias("experiment_group"),
    )


def _date_text(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def _time_text(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy HH:mm:ss.SSSSSS")


def _zero_for_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def staged_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns as their raw file holds them: text dates, the uplift a float."""
    return type_staging(
        campaigns(spark, sf_dir),
        {"start_date": _date_text, "end_date": _date_text, "expected_uplift": "double"},
    )


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as their raw file holds them: text times, 0 for missing keys."""
    return type_staging(
        events(spark, sf_dir),
        {
            "events_timestamp": _time_text,
            "product_id": _zero_for_null,
            "campaign_id": _zero_for_null,
        },
    )


def staged_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as their raw file holds them: text times, 0 for missing keys."""
    return type_staging(
        transactions(spark, sf_dir),
        {
            "transaction_timestamp": _time_text,
            "product_id": _zero_for_null,
            "campaign_id": _zero_for_null,
        },
    )


def broken_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged transactions, quantities as text too, some with values that do not convert."""
    key, time = F.col("transaction_id"), F.col("transaction_timestamp")
    pieces = F.col("quantity").cast("string")
    return staged_transactions(spark, sf_dir).withColumns(
        {
            "transaction_timestamp": F.when(key % 11 == 0, "31/02/2023 10:00")
            .when(key % 13 == 0, F.concat(F.lit("x"), time))
            .otherwise(time),
            "quantity": F.when(key % 17 == 0, F.concat(pieces, F.lit(" pcs"))).otherwise(pieces),
        }
    )


def part_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by name, every seventh without one."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.cast("bigint").alias("product_id"),
        _null_every(7, key, F.col("p_name")).alias("name"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
    )


def _spelled(key: Column, text: Column) -> Column:
    """One text in several spellings that a database server takes for equal."""
    return F.when(key % 3 == 0, F.concat(F.upper(text), F.lit("  "))).when(key % 3 == 1, F.lower(text)).otherwise(text)


def loosely_spelled_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns whose channels are spelled in several ways, every tenth unknown."""
    key = F.col("campaign_id")
    channel = F.when(key % 10 == 7, "unknown").otherwise(F.col("channel"))
    return campaigns(spark, sf_dir).withColumn("channel", _spelled(key, channel))


def loosely_spelled_cafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cafe's raw sales with items, places and placeholders spelled in several ways."""
    key = F.col("Quantity") + F.length("Transaction_ID")
    raw = cafe_raw(spark, sf_dir)
    return raw.withColumns({c: _spelled(F.coalesce(key, F.lit(1)), F.col(c)) for c in ("Item", "Location")})


def loosely_spelled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose types are spelled in several ways."""
    return events(spark, sf_dir).withColumn("event_type", _spelled(F.col("event_id"), F.col("event_type")))
