"""Every job and preset under its query name, run over the test tables.

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``. Decimals are shown
as doubles and whole numbers as bigint, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmart.functions import parse_dmy_date, parse_dmy_timestamp
from retailmart.operators import cleaning as cl
from retailmart.operators import quality as dq
from retailmart.operators.funnels import funnel
from retailmart.operators.ranking import top_ranked
from retailmart.operators.running import pareto, running_total
from retailmart.plans import cafe
from retailmart.plans import ecommerce as shop_plan
from retailmart.plans import ecommerce_analyses as an
from retailmart.plans.ecommerce import Ecommerce
from retailmart.sources import bindings, schemas
from retailmart.sources.files import (
    REPLACE_PARTITIONS,
    csv_ingest,
    csv_ingest_traced,
    register_views,
    scratch_path,
    staged_types,
    stored,
    type_staging,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

# Brands of the test tables read Brand#n.
BRAND_DELIM = "#"

TABLES = ("campaigns", "customers", "products", "events", "transactions")

_QUERIES: dict[str, Query] = {}


def present(df: DataFrame) -> DataFrame:
    def shown(f: T.StructField):
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegralType, T.BooleanType)):
            return F.col(f.name).cast("bigint").alias(f.name)
        return F.col(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


class _Shop:
    """The five tables, each built when it is first asked for."""

    def __init__(self, **tables: Callable[[], DataFrame]) -> None:
        self._tables = tables

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise AttributeError(name)
        frame = self._tables[name]()
        setattr(self, name, frame)
        return frame


def typed_shop(spark: SparkSession, sf_dir: str) -> _Shop:
    """The tables as loaded, before cleaning."""
    return _Shop(**{t: partial(getattr(bindings, t), spark, sf_dir) for t in TABLES})


def clean_shop(spark: SparkSession, sf_dir: str) -> _Shop:
    typed = typed_shop(spark, sf_dir)
    return _Shop(
        campaigns=lambda: shop_plan.clean_campaigns(typed.campaigns),
        customers=lambda: shop_plan.clean_customers(typed.customers),
        products=lambda: shop_plan.clean_products(typed.products, BRAND_DELIM),
        events=lambda: shop_plan.clean_events(typed.events),
        transactions=lambda: shop_plan.clean_transactions(typed.transactions),
    )


def staged_shop(spark: SparkSession, sf_dir: str) -> Ecommerce:
    return Ecommerce(
        bindings.staged_campaigns(spark, sf_dir),
        bindings.customers(spark, sf_dir),
        bindings.products(spark, sf_dir),
        bindings.staged_events(spark, sf_dir),
        bindings.staged_transactions(spark, sf_dir),
    )


def gold_cafe(spark: SparkSession, sf_dir: str, parity: bool = False) -> DataFrame:
    return cafe.gold_cafe_sales(cafe.cafe_silver(bindings.cafe_raw(spark, sf_dir), parity))


def _on_typed(name: str, fn: Callable[[_Shop], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: fn(typed_shop(spark, sf_dir)))


def _on_shop(name: str, fn: Callable[[_Shop], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: fn(clean_shop(spark, sf_dir)))


def _on_cafe_raw(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: fn(bindings.cafe_raw(spark, sf_dir)))


def _on_cafe(name: str, fn: Callable[[DataFrame], DataFrame], parity: bool = False) -> None:
    query(name)(lambda spark, sf_dir: fn(gold_cafe(spark, sf_dir, parity)))


# Ingest and model upkeep


@query("in_csv_ingest")
def _csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    bindings.staged_transactions(spark, sf_dir).write.option("header", True).csv(path)
    rows, _ = csv_ingest(spark, path, schemas.TRANSACTIONS_STAGED)
    return rows


def _ingested(staged: Callable[[SparkSession, str], DataFrame], schema: str) -> Query:
    """Write a table as a CSV file and read it back by its schema."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "csv")
        staged(spark, sf_dir).write.option("header", True).csv(path)
        return csv_ingest(spark, path, schema)[0]

    return run


for _name, _staged, _schema in (
    ("campaigns", bindings.staged_campaigns, schemas.CAMPAIGNS_STAGED),
    ("customers", bindings.customers, schemas.CUSTOMERS),
    ("products", bindings.products, schemas.PRODUCTS),
    ("events", bindings.staged_events, schemas.EVENTS_STAGED),
    ("cafe", bindings.cafe_raw, schemas.CAFE_RAW),
):
    query(f"in_csv_ingest_{_name}")(_ingested(_staged, _schema))


@query("in_csv_rejects")
def _csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refunds are written with a quantity that is no number."""
    path = scratch_path(spark, "csv")
    staged = bindings.staged_transactions(spark, sf_dir)
    quantity = F.when(F.col("refund_flag") == 1, "n/a").otherwise(F.col("quantity").cast("string"))
    staged.withColumn("quantity", quantity).write.option("header", True).csv(path)
    rows, rejects = csv_ingest(spark, path, schemas.TRANSACTIONS_STAGED)
    return (
        rows.select(F.lit(1).alias("good"))
        .unionByName(rejects.select(F.lit(0).alias("good")))
        .groupBy("good")
        .agg(F.count("*").alias("n_rows"))
    )


@query("in_csv_reject_reasons")
def _csv_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files without a header in which refunds have no whole quantity and some lines lack their last field."""
    staged = bindings.staged_transactions(spark, sf_dir)
    pieces = F.col("quantity").cast("string")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in staged.columns]
    fields[staged.columns.index("quantity")] = F.when(F.col("refund_flag") == 1, F.concat(pieces, F.lit(" pcs"))).otherwise(pieces)
    short = F.col("transaction_id") % 101 == 0
    line = F.when(short, F.concat_ws(",", *fields[:-1])).otherwise(F.concat_ws(",", *fields))
    path = scratch_path(spark, "csv")
    staged.select(line.alias("value")).write.text(path)
    rows, rejects = csv_ingest_traced(spark, path, schemas.TRANSACTIONS_STAGED, header=False)
    placed = F.col("file").contains(path.rsplit("/", 1)[-1]) & (F.col("block_start") >= 0)
    traced = rejects.groupBy("reason").agg(F.count("*").alias("n_rows"), F.count_if(placed).alias("n_placed"))
    return traced.unionByName(rows.select(F.lit("good").alias("reason"), F.lit(0).alias("n_placed")).groupBy("reason").agg(
        F.count("*").alias("n_rows"), F.sum("n_placed").alias("n_placed")
    ))


@query("in_type_staging")
def _type_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_staging(
        bindings.staged_transactions(spark, sf_dir),
        {"transaction_timestamp": parse_dmy_timestamp, "discount_applied": "decimal(4,2)"},
    )


TYPED_RULES = {"transaction_timestamp": parse_dmy_timestamp, "quantity": "int"}


@query("in_typed_rows")
def _typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_types(bindings.broken_transactions(spark, sf_dir), TYPED_RULES).typed


@query("in_typed_rejects")
def _typed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = staged_types(bindings.broken_transactions(spark, sf_dir), TYPED_RULES).rejects
    return rejects.withColumn("failed_columns", F.concat_ws(",", "failed_columns"))


@query("in_typed_counts")
def _typed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_types(bindings.broken_transactions(spark, sf_dir), TYPED_RULES).counts()


@query("in_write_table")
def _write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = shop_plan.clean_transactions(bindings.transactions(spark, sf_dir))
    month = F.trunc(F.col("transaction_timestamp").cast("date"), "MM")
    path = write_table(fact.withColumn("month", month), scratch_path(spark, "table"), ["month"])
    return spark.read.parquet(path)


@query("in_write_table_again")
def _write_table_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load up to 1996, load March 1996 again without refunds (twice: a load that is repeated), then the later months.

    The fact is stored first: each load would otherwise join and shuffle all of it again.
    """
    fact = shop_plan.clean_transactions(bindings.transactions(spark, sf_dir))
    fact = stored(fact.withColumn("month", F.trunc(F.col("transaction_timestamp").cast("date"), "MM")), "fact")
    path = scratch_path(spark, "table")
    march = F.lit("1996-03-01").cast("date")
    loads = [
        F.year("month") <= 1996,
        (F.col("month") == march) & (F.col("refund_flag") == 0),
        (F.col("month") == march) & (F.col("refund_flag") == 0),
        F.year("month") > 1996,
    ]
    for rows in loads:
        write_table(fact.filter(rows), path, ["month"], mode=REPLACE_PARTITIONS)
    return spark.read.schema(fact.schema).parquet(path)


@query("in_bucketed_join")
def _bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend per customer from fact and dimension stored by customer: neither is shuffled again."""
    shop = clean_shop(spark, sf_dir)
    names = []
    for frame in (shop.transactions, shop.customers):
        path = scratch_path(spark, "bucketed")
        names.append(path.rsplit("/", 1)[-1].replace("-", "_"))
        write_table(frame, path, bucket_by=["customer_id"], buckets=8, name=names[-1])
    fact, customers = (spark.table(n) for n in names)
    spend = fact.groupBy("customer_id").agg(F.sum("gross_revenue").alias("spent"), F.count("*").alias("orders"))
    return customers.hint("merge").join(spend, "customer_id").select("customer_id", "country", "spent", "orders")


@query("in_register_views")
def _register_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(shop_plan.gold_views(clean_shop(spark, sf_dir)))
    return spark.sql(
        "select category, count(*) as products, sum(total_units_sold) as units_sold "
        "from product_performance group by category"
    )


@query("in_add_unknown_member")
def _add_unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    campaigns = shop_plan.clean_campaigns(bindings.campaigns(spark, sf_dir))
    again = shop_plan.add_unknown_member(campaigns, "campaign_id", shop_plan.UNKNOWN_CAMPAIGN)
    return again.select("campaign_id", "channel", "objective", "target_segment", "start_date")


# Profiling and data quality

for _name in TABLES:
    _on_typed(f"dq_row_count_{_name}", lambda s, t=_name: dq.row_count(getattr(s, t)))
_on_cafe_raw("dq_row_count_cafe", dq.row_count)

# name: (table, stats, scale)
RANGES = {
    "campaign_dates": (
        "campaigns",
        {
            "first_day_of_campaigns": ("min", "start_date"),
            "last_day_of_campaigns": ("max", "end_date"),
        },
        {},
    ),
    "uplift": (
        "campaigns",
        {
            "min_uplift": ("min", "expected_uplift"),
            "max_uplift": ("max", "expected_uplift"),
            "avg_uplift": ("avg", "expected_uplift"),
        },
        {},
    ),
    "signup": (
        "customers",
        {"min_signup_date": ("min", "signup_date"), "max_signup_date": ("max", "signup_date")},
        {},
    ),
    "age": (
        "customers",
        {"min_age": ("min", "age"), "max_age": ("max", "age"), "avg_age": ("avg", "age")},
        {},
    ),
    "launch": (
        "products",
        {
            "first_product_launch_date": ("min", "launch_date"),
            "last_product_launch_date": ("max", "launch_date"),
        },
        {},
    ),
    "price": (
        "products",
        {
            "min_price": ("min", "base_price"),
            "max_price": ("max", "base_price"),
            "avg_price": ("avg", "base_price"),
        },
        {},
    ),
    "transaction_time": (
        "transactions",
        {
            "first_transaction": ("min", "transaction_timestamp"),
            "last_transaction": ("max", "transaction_timestamp"),
        },
        {},
    ),
    "revenue": (
        "transactions",
        {
            "min_gross_revenue": ("min", "gross_revenue"),
            "max_gross_revenue": ("max", "gross_revenue"),
            "avg_gross_revenue": ("avg", "gross_revenue"),
        },
        {},
    ),
    "event_time": (
        "events",
        {"first_event": ("min", "events_timestamp"), "last_event": ("max", "events_timestamp")},
        {},
    ),
    "session_duration": (
        "events",
        {
            "min_sess_dur_seconds": ("min", "session_duration_sec"),
            "max_sess_dur_minutes": ("max", "session_duration_sec"),
            "avg_sess_dur_minutes": ("avg", "session_duration_sec"),
        },
        {"max_sess_dur_minutes": 60, "avg_sess_dur_minutes": 60},
    ),
}
for _name, (_table, _stats, _scale) in RANGES.items():
    _on_typed(
        f"dq_range_{_name}",
        lambda s, t=_table, st=_stats, sc=_scale: dq.range_profile(getattr(s, t), st, scale=sc),
    )

_on_cafe_raw("dq_duplicate_keys_cafe", lambda df: dq.duplicate_keys(df, ["Transaction_ID"]))
_on_typed(
    "dq_duplicate_keys_campaigns", lambda s: dq.duplicate_keys(s.campaigns, ["campaign_id"])
)
_on_typed("dq_duplicate_keys_events", lambda s: dq.duplicate_keys(s.events, ["event_id"]))
_on_typed(
    "dq_duplicate_keys_transactions",
    lambda s: dq.duplicate_keys(s.transactions, ["transaction_id"]),
)
_on_typed(
    "dq_duplicate_rows_customers",
    lambda s: dq.duplicate_rows(s.customers, ["customer_id"], ["customer_id"]),
)
_on_typed(
    "dq_duplicate_rows_products",
    lambda s: dq.duplicate_rows(s.products, ["product_id"], ["product_id"]),
)
_on_typed(
    "dq_duplicate_rows_transactions",
    lambda s: dq.duplicate_rows(
        s.transactions, ["transaction_id"], ["transaction_id", "customer_id", "quantity"]
    ),
)

for _name in ("campaigns", "customers", "products"):
    _on_typed(
        f"dq_completeness_{_name}",
        lambda s, t=_name: dq.completeness(getattr(s, t), getattr(s, t).columns),
    )
for _name in ("transactions", "events"):
    _on_typed(
        f"dq_missing_{_name}",
        lambda s, t=_name: dq.completeness(getattr(s, t), getattr(s, t).columns[1:], "missing"),
    )
    _on_shop(
        f"dq_missing_campaign_after_cleaning_{_name}",
        lambda s, t=_name: dq.completeness(getattr(s, t), ["campaign_id"], "missing"),
    )
_on_cafe_raw(
    "dq_missing_cafe_date", lambda df: dq.completeness(df, ["Transaction_Date"], "missing")
)

for _column in ("Item", "Payment_Method", "Location"):
    _on_cafe_raw(
        f"dq_sentinel_count_{_column.lower()}",
        lambda df, c=_column: dq.sentinel_count(df, c, cafe.SENTINELS),
    )
_on_cafe_raw(
    "dq_conformance_transaction_id",
    lambda df: dq.conformance(df, dq.breaks_prefix_or_length("Transaction_ID", "TXN", 11)),
)
query("dq_conformance_campaign_dates")(
    lambda spark, sf_dir: dq.conformance(
        bindings.staged_campaigns(spark, sf_dir),
        dq.breaks_parse("start_date", parse_dmy_date(F.col("start_date"))),
    )
)

# name: (table, column, filter, descending)
FREQUENCIES = {
    "campaign_channel": ("campaigns", "channel", None, True),
    "campaign_objective": ("campaigns", "objective", None, True),
    "campaign_segment": ("campaigns", "target_segment", None, True),
    "customer_country": ("customers", "country", None, True),
    "customer_gender": ("customers", "gender", None, True),
    "customer_loyalty": ("customers", "loyalty_tier", None, True),
    "customer_acquisition": ("customers", "acquisition_channel", None, True),
    "product_premium": ("products", "is_premium", None, False),
    "product_brand": ("products", "brand", None, True),
    "product_category": ("products", "category", None, True),
    "transaction_customer": ("transactions", "customer_id", None, True),
    "transaction_quantity": ("transactions", "quantity", None, True),
    "transaction_discount": ("transactions", "discount_applied", None, True),
    "transaction_campaign": ("transactions", "campaign_id", "campaign_id is not null", True),
    "transaction_refund": ("transactions", "refund_flag", None, True),
    "event_customer": ("events", "customer_id", None, True),
    "event_session": ("events", "session_id", None, True),
    "event_type": ("events", "event_type", None, True),
    "event_product": ("events", "product_id", "product_id is not null", True),
    "event_product_purchased": (
        "events",
        "product_id",
        "product_id is not null and event_type = 'purchase'",
        True,
    ),
    "event_device": ("events", "device_type", None, True),
    "event_source": ("events", "traffic_source", None, True),
    "event_campaign": ("events", "campaign_id", None, True),
    "event_campaign_purchased": ("events", "campaign_id", "event_type = 'purchase'", True),
    "event_page": ("events", "page_category", None, True),
    "event_experiment": ("events", "experiment_group", None, True),
}
for _name, (_table, _column, _where, _desc) in FREQUENCIES.items():
    _on_typed(
        f"dq_frequency_{_name}",
        lambda s, t=_table, c=_column, w=_where, d=_desc: dq.category_frequency(
            getattr(s, t), c, where=F.expr(w) if w else None, descending=d
        ),
    )

# The frequencies of each table in one scan.
for _name in TABLES:
    _on_typed(
        f"dq_profile_frequencies_{_name}",
        lambda s, t=_name: dq.profile_frequencies(
            getattr(s, t),
            {n: (c, F.expr(w) if w else None) for n, (table, c, w, _) in FREQUENCIES.items() if table == t},
        ),
    )
    _on_typed(f"dq_profile_{_name}", lambda s, t=_name: dq.profile(getattr(s, t), getattr(s, t).columns))

_on_typed(
    "dq_distinct_values_country", lambda s: dq.distinct_values(s.customers, ["country"])
)
_on_cafe_raw("dq_distinct_values_item", lambda df: dq.distinct_values(df, ["Item"]))
_on_cafe_raw(
    "dq_distinct_values_item_prices",
    lambda df: dq.distinct_values(df, ["Item", "Price_Per_Unit", "Quantity", "Total_Spent"]),
)
# name: (table, columns)
DISTINCT_COUNTS = {
    "products": ("products", ["brand", "category"]),
    "transaction_customers": ("transactions", ["customer_id"]),
    "transaction_products": ("transactions", ["product_id"]),
    "transaction_campaigns": ("transactions", ["campaign_id"]),
    "event_customers": ("events", ["customer_id"]),
    "event_sessions": ("events", ["session_id"]),
    "event_products": ("events", ["product_id"]),
}
for _name, (_table, _columns) in DISTINCT_COUNTS.items():
    _on_typed(
        f"dq_distinct_count_{_name}",
        lambda s, t=_table, c=_columns: dq.distinct_count(getattr(s, t), c),
    )



@query("dq_sketch_customers_by_month")
def _sketch_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and products per month: exact, and whether the stored sketches, united for all months, come within five
    standard errors."""
    fact = bindings.transactions(spark, sf_dir)
    month = F.trunc(F.col("transaction_timestamp").cast("date"), "MM").alias("month")
    counted = ["customer_id", "product_id"]
    path = scratch_path(spark, "sketches")
    write_table(dq.distinct_sketches(fact, [month], counted), path, ["month"], mode=REPLACE_PARTITIONS)
    stored = spark.read.schema("customer_id binary, product_id binary, month date").parquet(path)
    no_month = F.lit(None).cast("date").alias("month")
    exact = [F.count_distinct(c).alias(c) for c in counted]
    monthly = fact.groupBy(month).agg(*exact).unionByName(fact.agg(*exact).select(no_month, *counted))
    united = dq.united_distinct_count(stored, counted, ["month"]).unionByName(
        dq.united_distinct_count(stored, counted).select(no_month, *counted)
    )
    near = [
        (F.abs(F.col(f"e.{c}") - F.col(c)) <= 5 * dq.sketch_error() * F.col(c)).alias(f"{c}_near") for c in counted
    ]
    guesses = united.select(F.col("month").alias("_month"), F.struct(*counted).alias("e"))
    return monthly.join(guesses, monthly["month"].eqNullSafe(guesses["_month"])).select("month", *counted, *near)


# name: (fact, dimension, key)
FOREIGN_KEYS = {
    "transaction_customer": ("transactions", "customers", "customer_id"),
    "transaction_product": ("transactions", "products", "product_id"),
    "transaction_campaign": ("transactions", "campaigns", "campaign_id"),
    "event_customer": ("events", "customers", "customer_id"),
    "event_product": ("events", "products", "product_id"),
    "event_campaign": ("events", "campaigns", "campaign_id"),
}
for _name, (_fact, _dim, _key) in FOREIGN_KEYS.items():
    _on_typed(
        f"dq_orphan_keys_{_name}",
        lambda s, f=_fact, d=_dim, k=_key: dq.orphan_keys(getattr(s, f), getattr(s, d), k),
    )


# The checks above find nothing where the tables are sound; here every seventh row of a table is there twice, and every
# fifth row of a dimension is missing.
_on_cafe_raw(
    "dq_duplicate_keys_cafe_repeated",
    lambda df: dq.duplicate_keys(
        df.unionByName(df.filter(F.substring("Transaction_ID", -1, 1) == "7")), ["Transaction_ID"]
    ),
)
for _name, _key in (("campaigns", "campaign_id"), ("events", "event_id")):
    _on_typed(
        f"dq_duplicate_keys_{_name}_repeated",
        lambda s, t=_name, k=_key: dq.duplicate_keys(
            getattr(s, t).unionByName(getattr(s, t).filter(F.col(k) % 7 == 0)), [k]
        ),
    )
for _name, _key in (("customers", "customer_id"), ("products", "product_id")):
    _on_typed(
        f"dq_duplicate_rows_{_name}_repeated",
        lambda s, t=_name, k=_key: dq.duplicate_rows(
            getattr(s, t).unionByName(getattr(s, t).filter(F.col(k) % 7 == 0)), [k], [k]
        ),
    )
for _name, (_fact, _dim, _key) in FOREIGN_KEYS.items():
    _on_typed(
        f"dq_orphan_keys_{_name}_lacking",
        lambda s, f=_fact, d=_dim, k=_key: dq.orphan_keys(
            getattr(s, f), getattr(s, d).filter(F.col(k) % 5 != 0), k
        ),
    )


@query("dq_orphan_keys_default_campaign")
def _orphan_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What replacing missing keys by 0 would break, were there no unknown member."""
    fact = shop_plan.clean_transactions(bindings.transactions(spark, sf_dir))
    return dq.orphan_keys(fact, bindings.campaigns(spark, sf_dir), "campaign_id")


_on_typed(
    "dq_co_missing_transactions",
    lambda s: dq.co_missing(s.transactions, ["product_id", "gross_revenue"]),
)
_on_typed(
    "dq_row_with_global_stats_campaigns",
    lambda s: dq.row_with_global_stats(
        cl.duration_days(s.campaigns, "start_date", "end_date", "campaigns_duration").select(
            "campaign_id", "start_date", "campaigns_duration", "end_date"
        ),
        "campaigns_duration",
        "avg_campaigns_duration",
        "min_campaigns_duration",
        "max_campaigns_duration",
    ),
)
_on_typed(
    "dq_group_count_extremes_product",
    lambda s: dq.group_count_extremes(
        s.transactions,
        "product_id",
        "products_count",
        "max_products_count",
        "min_products_count",
    ),
)

# Cleaning

_on_cafe_raw(
    "cl_strip_prefix",
    lambda df: cl.strip_prefix(
        cl.strip_prefix(df, "Transaction_ID", cafe.ID_PREFIX), "Transaction_ID", cafe.ID_PREFIX
    ).select("Transaction_ID"),
)
_on_typed(
    "cl_after_first",
    lambda s: cl.after_first(s.products, "brand", BRAND_DELIM).select("product_id", "brand"),
)
_on_typed(
    "cl_after_last",
    lambda s: cl.after_last(s.events, "event_type", "_").select("event_id", "event_type"),
)
_on_cafe_raw(
    "cl_sentinels_to_label",
    lambda df: cl.sentinels_to_label(
        df, ["Item", "Payment_Method", "Location"], cafe.SENTINELS
    ).select("Transaction_ID", "Item", "Payment_Method", "Location"),
)
query("cl_sentinel_to_null")(
    lambda spark, sf_dir: cl.sentinel_to_null(
        bindings.staged_transactions(spark, sf_dir), {"product_id": 0, "campaign_id": 0}
    ).select("transaction_id", "product_id", "campaign_id")
)


def _labelled_items(df: DataFrame) -> DataFrame:
    return cl.sentinels_to_label(df, ["Item"], cafe.SENTINELS)


def _filled_from_lookup(df: DataFrame, price_items: dict[Decimal, str]) -> DataFrame:
    df = cl.fill_from_lookup(
        _labelled_items(df),
        "Price_Per_Unit",
        "Item",
        cafe.ITEM_PRICES,
        F.col("Price_Per_Unit").isNull(),
    )
    df = cl.fill_from_lookup(
        df, "Item", "Price_Per_Unit", price_items, F.col("Item") == cafe.NA
    )
    return df.select("Transaction_ID", "Item", "Price_Per_Unit")


_on_cafe_raw("cl_fill_from_lookup", lambda df: _filled_from_lookup(df, cafe.PRICE_ITEMS))
_on_cafe_raw(
    "cl_fill_from_lookup_parity", lambda df: _filled_from_lookup(df, cafe.PARITY_PRICE_ITEMS)
)


def _known_items(df: DataFrame) -> DataFrame:
    return _labelled_items(df).filter(F.col("Item") != cafe.NA)


_on_cafe_raw(
    "cl_derive_mapping", lambda df: cl.derive_mapping(_known_items(df), "Item", "Price_Per_Unit")
)
_on_cafe_raw(
    "cl_derive_mapping_reverse",
    lambda df: cl.derive_mapping(_known_items(df), "Price_Per_Unit", "Item"),
)
_on_cafe_raw(
    "cl_fill_from_table",
    lambda df: cl.fill_from_table(
        _labelled_items(df),
        "Price_Per_Unit",
        "Item",
        cl.derive_mapping(_known_items(df), "Item", "Price_Per_Unit"),
        F.col("Price_Per_Unit").isNull(),
    ).select("Transaction_ID", "Item", "Price_Per_Unit"),
)
_on_cafe_raw(
    "cl_fill_by_product",
    lambda df: cl.fill_by_product(df, "Total_Spent", "Quantity", "Price_Per_Unit").select(
        "Transaction_ID", "Total_Spent", "Quantity", "Price_Per_Unit"
    ),
)
_on_typed(
    "cl_null_to_default",
    lambda s: cl.null_to_default(s.events, {"campaign_id": 0}).select("event_id", "campaign_id"),
)
_on_typed(
    "cl_scale_and_rename",
    lambda s: cl.scale_and_rename(
        s.campaigns, "expected_uplift", "expected_uplift_pct", 100, 2
    ).select("campaign_id", "expected_uplift_pct"),
)
_on_typed(
    "cl_duration_days",
    lambda s: cl.duration_days(
        s.campaigns, "start_date", "end_date", "campaigns_duration_days"
    ).select("campaign_id", "campaigns_duration_days"),
)
_on_typed(
    "cl_bin_column",
    lambda s: cl.bin_column(
        s.customers, "age", shop_plan.AGE_BINS, shop_plan.AGE_REST, "age_group"
    ).select("customer_id", "age", "age_group"),
)
_on_typed(
    "cl_validity_flag",
    lambda s: cl.validity_flag(
        s.transactions, ["product_id", "gross_revenue"], "valid_transaction_flag"
    ).select("transaction_id", "product_id", "gross_revenue", "valid_transaction_flag"),
)
_on_cafe_raw("cl_cafe_silver", cafe.cafe_silver)
_on_cafe_raw("cl_cafe_silver_parity", lambda df: cafe.cafe_silver(df, parity=True))
for _name in TABLES:
    query(f"cl_ecommerce_silver_{_name}")(
        lambda spark, sf_dir, t=_name: getattr(
            shop_plan.ecommerce_silver(staged_shop(spark, sf_dir), BRAND_DELIM), t
        )
    )

# Gold views

_on_cafe("gv_gold_cafe_sales", lambda gold: gold)
for _name in (
    "sales_base",
    "product_performance",
    "campaign_performance",
    "time_sales",
    "customer_behavior",
    "event_behavior",
):
    _on_shop(f"gv_{_name}", getattr(shop_plan, _name))
_on_shop("gv_time_sales_no_refunds", lambda s: shop_plan.time_sales(s, exclude_refunds=True))

# Cafe analyses

for _name in (
    "item_price_range",
    "item_spend_range",
    "avg_price",
    "avg_spend",
    "top_items_by_quantity",
    "bottom_items_by_quantity",
    "orders_by_payment",
    "orders_by_location",
    "payment_by_location",
    "top_items_by_revenue",
    "monthly_running_total",
    "monthly_contribution",
    "weekday_sales",
    "overall_aov",
    "monthly_aov",
    "location_aov",
    "payment_aov",
    "item_pareto",
    "payment_revenue_share",
    "spend_buckets",
):
    _on_cafe(_name, getattr(cafe, _name))
_on_cafe("item_pareto_80", lambda gold: cafe.item_pareto(gold, threshold=80))
_on_cafe("item_pareto_parity", cafe.item_pareto, parity=True)
_on_cafe("top_items_by_quantity_parity", cafe.top_items_by_quantity, parity=True)

# E-commerce analyses

for _name in (
    "top_transactions",
    "discount_impact",
    "discount_buckets",
    "campaign_ab",
    "kpi_dashboard",
    "top_campaigns",
    "channel_share",
    "objective_performance",
    "segment_performance",
    "campaign_efficiency",
    "event_distribution",
    "channel_funnel_counts",
    "funnel_conversion",
    "session_duration_by_event",
    "engagement_by_channel",
    "session_duration_by_age",
):
    _on_shop(_name, getattr(an, _name))
for _name in (
    "products_by_price",
    "top_products",
    "category_performance",
    "category_share",
    "price_segments",
):
    _on_shop(
        _name, lambda s, fn=getattr(an, _name): fn(shop_plan.product_performance(s))
    )
for _name in ("seasonality_month", "yearly_trend", "month_over_month", "quarterly_demand"):
    _on_shop(_name, lambda s, fn=getattr(an, _name): fn(shop_plan.time_sales(s)))
for _name in ("customer_segments", "top_customers", "country_performance", "age_group_spend"):
    _on_shop(_name, lambda s, fn=getattr(an, _name): fn(shop_plan.customer_behavior(s)))
_on_shop(
    "discount_impact_parity", lambda s: an.discount_impact(s, an.PARITY_DISCOUNT_LABELS)
)
_on_shop("campaign_ab_parity", lambda s: an.campaign_ab(s, an.PARITY_AB_LABELS))
_on_shop("channel_share_distinct", lambda s: an.channel_share(s, distinct_campaigns=True))
_on_shop(
    "month_over_month_filled",
    lambda s: an.month_over_month(shop_plan.time_sales(s), fill_calendar=True),
)
for _name in (
    "top_transactions",
    "discount_impact",
    "discount_buckets",
    "campaign_ab",
    "kpi_dashboard",
    "top_campaigns",
    "channel_share",
    "objective_performance",
    "segment_performance",
    "campaign_efficiency",
):
    _on_shop(
        f"{_name}_no_refunds",
        lambda s, fn=getattr(an, _name): fn(shop_plan.without_refunds(s)),
    )
_on_shop(
    "funnel_by_device",
    lambda s: funnel(s.events, "event_type", an.FUNNEL_STEPS, an.FUNNEL_RATES, ["device_type"]),
)
_on_shop(
    "top_products_by_category",
    lambda s: top_ranked(
        shop_plan.product_performance(s).select("category", "product_id", "total_units_sold"),
        "total_units_sold",
        2,
        ["category"],
        dense=True,
    ),
)
_on_shop(
    "customer_pareto",
    lambda s: pareto(s.transactions, "customer_id", "gross_revenue"),
)
_on_typed(
    "running_revenue_by_time",
    lambda s: running_total(
        s.transactions.select("transaction_id", "transaction_timestamp", "gross_revenue"),
        "transaction_timestamp",
        "gross_revenue",
        "running_revenue",
    ),
)
query("running_price_by_name")(
    lambda spark, sf_dir: running_total(
        bindings.part_prices(spark, sf_dir), "name", "price", "running_price", descending=True, before="price_ahead"
    )
)
_on_typed(
    "running_events_by_duration",
    lambda s: running_total(
        s.events.select(
            "event_id", F.col("session_duration_sec").cast("double").alias("duration"), F.lit(1).cast("bigint").alias("one")
        ),
        "duration",
        "one",
        "events_so_far",
    ),
)

# Text under the server's collation


def collated_shop(spark: SparkSession, sf_dir: str) -> _Shop:
    """The cleaned shop with loosely spelled channels and event types that compare as on the server."""
    shop = clean_shop(spark, sf_dir)
    loose = bindings.loosely_spelled_campaigns(spark, sf_dir)
    events = bindings.loosely_spelled_events(spark, sf_dir)
    shop.campaigns = shop_plan.clean_campaigns(schemas.server_collated(loose, ["channel"]))
    shop.events = shop_plan.clean_events(schemas.server_collated(events, ["event_type"]))
    return shop


def _collated_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = schemas.server_collated(bindings.loosely_spelled_cafe(spark, sf_dir), ["Item", "Location"])
    return cafe.gold_cafe_sales(cafe.cafe_silver(raw))


for _name, _fn in (
    ("gv_campaign_performance", shop_plan.campaign_performance),
    ("channel_share", an.channel_share),
    ("funnel_conversion", an.funnel_conversion),
):
    query(f"{_name}_collated")(
        lambda spark, sf_dir, fn=_fn: schemas.plain_text(fn(collated_shop(spark, sf_dir)))
    )
for _name, _fn in (
    ("cl_cafe_silver", lambda gold: gold),
    ("payment_by_location", cafe.payment_by_location),
    ("location_aov", cafe.location_aov),
):
    query(f"{_name}_collated")(
        lambda spark, sf_dir, fn=_fn: schemas.plain_text(fn(_collated_gold(spark, sf_dir)))
    )
