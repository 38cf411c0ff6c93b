"""Declared schemas: ``*_STAGED`` as the raw CSV files hold them, the others typed.

Staged dates are text (day first); money is read as decimal, not as float. ``server_collated`` gives any of them, or a
frame, text that compares as on the database server the jobs stem from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Equality without letter case and trailing blanks.
SERVER_COLLATION = "UTF8_LCASE_RTRIM"


def collated_schema(schema: str | T.StructType, columns: Sequence[str] | None = None) -> T.StructType:
    """The schema with its text columns, or those named, under the server's collation."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)

    def field(f: T.StructField) -> T.StructField:
        if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns):
            return T.StructField(f.name, T.StringType(SERVER_COLLATION), f.nullable, f.metadata)
        return f

    return T.StructType([field(f) for f in schema.fields])


def server_collated(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The frame with its text columns, or those named, under the server's collation.

    Comparisons, joins, groups and distinct counts on them then ignore letter case and trailing blanks; the texts stay
    as they are, and a group shows one of its spellings. Groups on collated text are sorted, not hashed, so fold facts
    by plain keys first, as the jobs here do, or name only the columns that need it.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in collated_schema(df.schema, columns).fields])


def plain_text(df: DataFrame) -> DataFrame:
    """Collated text columns as plain lower-case text without trailing blanks: one spelling for all that are equal."""

    def shown(f: T.StructField):
        if isinstance(f.dataType, T.StringType) and f.dataType.collation == SERVER_COLLATION:
            return F.lower(F.rtrim(F.col(f.name).cast("string"))).alias(f.name)
        return F.col(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


CAFE_RAW = (
    "Transaction_ID string, Item string, Quantity int, Price_Per_Unit decimal(10,2), "
    "Total_Spent decimal(10,2), Payment_Method string, Location string, Transaction_Date date"
)

CAMPAIGNS_STAGED = (
    "campaign_id bigint, channel string, objective string, start_date string, end_date string, "
    "target_segment string, expected_uplift double"
)
CAMPAIGNS = (
    "campaign_id bigint, channel string, objective string, start_date date, end_date date, "
    "target_segment string, expected_uplift decimal(5,2)"
)
CUSTOMERS = (
    "customer_id bigint, signup_date date, country string, age int, gender string, "
    "loyalty_tier string, acquisition_channel string"
)
PRODUCTS = (
    "product_id bigint, category string, brand string, base_price decimal(18,2), "
    "launch_date date, is_premium int"
)
EVENTS_STAGED = (
    "event_id bigint, events_timestamp string, customer_id bigint, session_id bigint, "
    "event_type string, product_id bigint, device_type string, traffic_source string, "
    "campaign_id bigint, page_category string, session_duration_sec decimal(18,2), "
    "experiment_group string"
)
EVENTS = EVENTS_STAGED.replace("events_timestamp string", "events_timestamp timestamp_ntz")
TRANSACTIONS_STAGED = (
    "transaction_id bigint, transaction_timestamp string, customer_id bigint, product_id bigint, "
    "quantity int, discount_applied decimal(4,2), gross_revenue decimal(18,2), "
    "campaign_id bigint, refund_flag int"
)
TRANSACTIONS = TRANSACTIONS_STAGED.replace(
    "transaction_timestamp string", "transaction_timestamp timestamp_ntz"
)
