"""The catalog's queries as SQL for DuckDB, to check Spark's results against.

Written apart from the Spark code. Rounded quotients are taken in whole numbers,
so that rounding half away from zero is exact.
"""

from __future__ import annotations

# The canonical tables, from the test tables.
CAFE_PRICE = """case o_custkey % 11 when 0 then 5 when 1 then 3 when 2 then 1.5 when 3 then 1
  when 4 then 4 when 5 then 2 when 6 then 4 when 7 then 3 when 8 then 5 when 9 then 1.5
  else 2 + o_custkey % 2 end"""

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "cafe_raw": (
        (),
        f"""
select 'TXN_' || case when length(cast(o_orderkey as varchar)) < 7 then lpad(cast(o_orderkey as varchar), 7, '0') else cast(o_orderkey as varchar) end as Transaction_ID,
 case o_custkey % 11 when 0 then 'Salad' when 1 then 'Juice' when 2 then 'Tea' when 3 then 'Cookie'
  when 4 then 'Smoothie' when 5 then 'Coffee' when 6 then 'Sandwich' when 7 then 'Cake'
  when 8 then 'UNKNOWN' when 9 then 'ERROR' else null end as Item,
 case when o_orderkey % 13 = 0 then null else cast(1 + o_orderkey % 5 as int) end as Quantity,
 case when o_orderkey % 17 = 0 then null
  else cast({CAFE_PRICE} as decimal(10,2)) end as Price_Per_Unit,
 case when o_orderkey % 19 = 0 then null
  else cast((1 + o_orderkey % 5) * cast({CAFE_PRICE} as decimal(10,2)) as decimal(10,2))
  end as Total_Spent,
 case o_orderpriority when '1-URGENT' then 'Cash' when '2-HIGH' then 'Credit Card'
  when '3-MEDIUM' then 'Digital Wallet' when '4-NOT SPECIFIED' then 'UNKNOWN'
  else null end as Payment_Method,
 case o_orderstatus when 'F' then 'In-store' when 'O' then 'Takeaway' else 'ERROR' end as Location,
 case when o_orderkey % 23 = 0 then null else cast(o_orderdate as date) end as Transaction_Date
from orders""",
    ),
    "campaigns_t": (
        (),
        """
select cast(s_suppkey + 1 as int) as campaign_id, r_name as channel,
 case s_suppkey % 4 when 0 then 'Reactivation' when 1 then 'Retention' when 2 then 'Awareness'
  else 'Acquisition' end as objective,
 cast(date_add(date '1995-01-01', to_days(cast(s_suppkey as int))) as date) as start_date,
 cast(date_add(date '1995-01-01', to_days(cast(s_suppkey + 8 + s_suppkey % 82 as int))) as date)
  as end_date,
 case s_suppkey % 3 when 0 then 'New Customers' when 1 then 'Deal Seekers' else 'All' end
  as target_segment,
 cast((s_suppkey % 16) / 100.0 as decimal(5,2)) as expected_uplift
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    ),
    "customers_t": (
        (),
        """
select cast(c_custkey as int) as customer_id,
 cast(date_add(date '1994-01-01', to_days(cast(c_custkey % 365 as int))) as date) as signup_date,
 n_name as country, cast(18 + c_custkey % 53 as int) as age,
 case c_custkey % 3 when 0 then 'Male' when 1 then 'Female' else 'Other' end as gender,
 c_mktsegment as loyalty_tier,
 case c_custkey % 5 when 0 then 'Organic' when 1 then 'Paid Search' when 2 then 'Social'
  when 3 then 'Email' else 'Referral' end as acquisition_channel
from customer join nation on c_nationkey = n_nationkey""",
    ),
    "products_t": (
        (),
        """
select cast(p_partkey as int) as product_id, p_type as category, p_brand as brand,
 cast((cast(p_retailprice as decimal(18,2)) - 900) * 4 as decimal(18,2)) as base_price,
 cast(date_add(date '1995-01-01', to_days(cast(p_partkey % 1000 as int))) as date) as launch_date,
 cast(p_partkey % 2 as int) as is_premium
from part""",
    ),
    "transactions_t": (
        (),
        """
select l_orderkey * 8 + l_linenumber as transaction_id, o_orderdate as transaction_timestamp,
 cast(o_custkey as int) as customer_id,
 case when l_orderkey % 10 = 0 then null else cast(l_partkey as int) end as product_id,
 cast(l_quantity as int) as quantity, cast(l_discount as decimal(4,2)) as discount_applied,
 cast(case when l_orderkey % 10 = 0 then null
  when l_returnflag = 'R'
   then -cast(cast(l_extendedprice as decimal(12,2)) * 0.001 as decimal(18,2))
  else cast(cast(l_extendedprice as decimal(12,2)) * 0.001 as decimal(18,2))
  end as decimal(18,2)) as gross_revenue,
 case when l_suppkey % 5 = 0 then null else cast(l_suppkey + 1 as int) end as campaign_id,
 case when l_returnflag = 'R' then 1 else 0 end as refund_flag
from lineitem join orders on l_orderkey = o_orderkey""",
    ),
    "events_t": (
        (),
        """
select event_id, ts as events_timestamp, cast(user_id as int) as customer_id,
 event_id % 2500 as session_id,
 case event_type when 'error' then 'bounce' when 'signup' then 'add_to_cart' else event_type end
  as event_type,
 case when event_id % 10 = 0 then null else cast(event_id % 200 as int) end as product_id,
 case when event_id % 50 = 0 then null when event_id % 3 = 0 then 'desktop'
  when event_id % 3 = 1 then 'mobile' else 'tablet' end as device_type,
 case event_id % 5 when 0 then 'Organic' when 1 then 'Paid Search' when 2 then 'Social'
  when 3 then 'Email' else 'Direct' end as traffic_source,
 case when event_id % 2 = 0 then null else cast(1 + event_id % 10 as int) end as campaign_id,
 case event_id % 5 when 0 then 'Home' when 1 then 'PLP' when 2 then 'PDP' when 3 then 'Cart'
  else 'Checkout' end as page_category,
 cast(value as decimal(18,2)) as session_duration_sec,
 case event_id % 4 when 0 then 'Variant_A' when 1 then 'Variant_B' else 'Control' end
  as experiment_group
from events""",
    ),
    # The cleaned tables.
    "cafe_labelled": (
        ("cafe_raw",),
        """
select * replace (
 case when Item is null or Item in ('ERROR', 'UNKNOWN') then 'NA' else Item end as Item)
from cafe_raw""",
    ),
    "item_prices": (
        (),
        """
select * from (values ('Salad', 5.0), ('Juice', 3.0), ('Tea', 1.5), ('Cookie', 1.0),
 ('Smoothie', 4.0), ('Coffee', 2.0), ('Sandwich', 4.0), ('Cake', 3.0)) v(i, p)""",
    ),
    "cafe_priced": (
        ("cafe_labelled", "item_prices"),
        """
select c.* replace (cast(coalesce(Price_Per_Unit, p) as decimal(10,2)) as Price_Per_Unit)
from cafe_labelled c left join item_prices on Item = i""",
    ),
    "cafe_items": (
        ("cafe_priced",),
        """
select * replace (case when Item <> 'NA' then Item when Price_Per_Unit = 5 then 'Salad'
 when Price_Per_Unit = 1.5 then 'Tea' when Price_Per_Unit = 1 then 'Cookie'
 when Price_Per_Unit = 2 then 'Coffee' else Item end as Item)
from cafe_priced""",
    ),
    "cafe_items_parity": (
        ("cafe_priced",),
        """
select * replace (case when Item <> 'NA' then Item when Price_Per_Unit = 5 then 'Salad'
 when Price_Per_Unit = 1.5 then 'Salad' when Price_Per_Unit = 1 then 'Cookie'
 when Price_Per_Unit = 2 then 'Coffee' else Item end as Item)
from cafe_priced""",
    ),
}

_FILL_TOTAL = """
select * replace (
 cast(coalesce(Total_Spent, Quantity * Price_Per_Unit) as decimal(10,2)) as Total_Spent)
from {source}"""
_FILL_PRICE = """
select * replace (
 cast(coalesce(Price_Per_Unit, Total_Spent / nullif(Quantity, 0)) as decimal(10,2))
 as Price_Per_Unit)
from {source}"""
_FILL_QUANTITY = """
select * replace (
 coalesce(Quantity, cast(round(Total_Spent / nullif(Price_Per_Unit, 0), 0) as int)) as Quantity)
from {source}"""
_CAFE_LABELS = """
select * replace (replace(Transaction_ID, 'TXN_', '') as Transaction_ID,
 case when Payment_Method is null or Payment_Method in ('ERROR', 'UNKNOWN') then 'NA'
  else Payment_Method end as Payment_Method,
 case when Location is null or Location in ('ERROR', 'UNKNOWN') then 'NA'
  else Location end as Location)
from {source}"""


def _add_fill(prefix: str, source: str) -> str:
    steps = ((_FILL_TOTAL, "total"), (_FILL_PRICE, "price"), (_FILL_QUANTITY, "quantity"))
    for text, step in steps:
        name = f"{prefix}_{step}"
        CTES[name] = ((source,), text.format(source=source))
        source = name
    return source


_filled = _add_fill("filled", "cafe_items")
_filled_parity = _add_fill("filled_parity", "cafe_items_parity")
_filled_raw = _add_fill("filled_raw", "cafe_raw")
CTES["gold"] = ((_filled,), _CAFE_LABELS.format(source=_filled))
CTES["gold_parity"] = ((_filled_parity,), _CAFE_LABELS.format(source=_filled_parity))

CTES |= {
    "campaigns_k": (
        ("campaigns_t",),
        """
select campaign_id, channel, objective, start_date, end_date, target_segment,
 cast(expected_uplift * 100 as decimal(5,2)) as expected_uplift_pct,
 datediff('day', start_date, end_date) as campaigns_duration_days
from campaigns_t
union all select 0, 'Unknown', 'Unknown', null, null, 'Unknown', 0, 0""",
    ),
    "customers_k": (
        ("customers_t",),
        """
select *, case when age < 25 then '18-24' when age <= 34 then '25-34' when age <= 44 then '35-44'
 when age <= 54 then '45-54' else '55+' end as age_group
from customers_t""",
    ),
    "products_k": (
        ("products_t",),
        "select * replace (replace(brand, 'Brand#', '') as brand) from products_t",
    ),
    "events_k": (
        ("events_t",),
        """
select * replace (regexp_replace(event_type, '^.*_', '') as event_type,
 coalesce(campaign_id, 0) as campaign_id)
from events_t""",
    ),
    "transactions_k": (
        ("transactions_t",),
        """
select * replace (coalesce(campaign_id, 0) as campaign_id),
 case when product_id is null and gross_revenue is null then 0 else 1 end
  as valid_transaction_flag
from transactions_t""",
    ),
    # The gold views.
    "sales_base": (
        ("transactions_k", "products_k", "campaigns_k"),
        """
select transaction_timestamp::date as transaction_date, customer_id, product_id, quantity,
 discount_applied, gross_revenue, t.campaign_id, objective
from transactions_k t semi join products_k using (product_id)
left join campaigns_k k on k.campaign_id = t.campaign_id""",
    ),
    "product_performance": (
        ("transactions_k", "products_k"),
        """
select product_id, base_price, category, units as total_units_sold,
 round(revenue, 1) as total_revenue
from products_k join (
 select product_id, sum(quantity) as units, sum(gross_revenue) as revenue
 from transactions_k where gross_revenue is not null group by all) using (product_id)""",
    ),
    "campaign_performance": (
        ("transactions_k", "campaigns_k"),
        """
select campaign_id, channel, target_segment, quantity, gross_revenue, campaigns_duration_days
from transactions_k join campaigns_k using (campaign_id)
where gross_revenue is not null and campaign_id <> 0""",
    ),
    "time_sales": (
        ("transactions_k",),
        """
select d as transaction_date, year(d) as sales_year, month(d) as sales_month,
 count(*) as total_transactions, sum(quantity) as total_units_sold,
 sum(gross_revenue) as total_revenue
from (select *, transaction_timestamp::date as d from transactions_k)
where gross_revenue is not null group by d""",
    ),
    "event_behavior": (
        ("events_k", "customers_k", "campaigns_k"),
        """
select event_id, c.customer_id, k.campaign_id, age_group, channel, session_duration_sec, event_type
from events_k e left join customers_k c using (customer_id)
left join campaigns_k k using (campaign_id)
where product_id is not null""",
    ),
}


def half_away(num: str, den: str, digits: int) -> str:
    """``num / den`` (whole numbers) rounded half away from zero, as a double."""
    n, d = f"(({num})::hugeint * {10**digits})", f"({den})"
    return (
        f"((case when ({n} < 0) <> ({d} < 0) then -1 else 1 end)"
        f" * ((2 * abs({n}) + abs({d})) // nullif(2 * abs({d}), 0)))::double / {10**digits}"
    )


def cents(column: str, scale: int = 2) -> str:
    return f"sum(({column} * {10**scale})::bigint)"


def mean(column: str, digits: int = 2, scale: int = 2) -> str:
    return half_away(cents(column, scale), f"{10**scale} * count({column})", digits)


CTES["customer_behavior"] = (
    ("customers_k", "transactions_k"),
    f"""
select customer_id, country, age_group, total_orders, total_spent, avg_order_value
from customers_k join (
 select customer_id, count(*) as total_orders, sum(gross_revenue) as total_spent,
  ({mean('gross_revenue')})::decimal(18,2) as avg_order_value
 from transactions_k where gross_revenue is not null group by all) using (customer_id)""",
)

CTES["monthly"] = (
    ("gold",),
    """
select cast(date_trunc('month', Transaction_Date) as date) as Sales_Month,
 sum(Total_Spent) as Monthly_Revenue, count(*) as Transactions
from gold where Transaction_Date is not null group by 1""",
)


def _item_revenue(source: str) -> str:
    return f"""
select Item, sum(Total_Spent) as Item_Revenue from {source}
where Total_Spent is not null and Item <> 'NA' group by Item"""


def _running_items(source: str) -> str:
    return f"""
select *, sum(Item_Revenue) over () as all_revenue,
 sum(Item_Revenue) over (order by Item_Revenue desc) as upto,
 sum(Item_Revenue) over (order by Item_Revenue desc
  range between current row and current row) as ties
from {source}"""


CTES["item_rev"] = (("gold",), _item_revenue("gold"))
CTES["item_rev_parity"] = (("gold_parity",), _item_revenue("gold_parity"))
CTES["item_run"] = (("item_rev",), _running_items("item_rev"))
CTES["item_run_parity"] = (("item_rev_parity",), _running_items("item_rev_parity"))


def with_tables(sql: str, *names: str) -> str:
    """Put the named tables, and those they rest on, in front of ``sql``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        needs, _ = CTES[name]
        for n in needs:
            add(n)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "with " + ",\n".join(f"{n} as ({CTES[n][1]})" for n in ordered) + "\n" + sql


def share(part: str, whole: str) -> str:
    """100 * part / whole for money of two places, rounded to two."""
    return half_away(f"({part} * 100)::hugeint * 100", f"({whole} * 100)::hugeint", 2)


def count_share(part: str, whole: str) -> str:
    return half_away(f"{part} * 100", whole, 2)


def raw_share(part: str, whole: str) -> str:
    return f"100.0::double * ({part})::double / ({whole})::double"


_ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str, *tables: str) -> None:
    if name in _ORACLE:
        raise ValueError(f"oracle {name} is registered twice")
    _ORACLE[name] = with_tables(sql, *tables) if tables else sql


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# How each column is shown: whole numbers as bigint, decimals as double.
TRANSACTION_COLUMNS = """transaction_id::bigint as transaction_id, {time},
 customer_id::bigint as customer_id, product_id::bigint as product_id,
 quantity::bigint as quantity, discount_applied::double as discount_applied,
 gross_revenue::double as gross_revenue, campaign_id::bigint as campaign_id,
 refund_flag::bigint as refund_flag"""
EVENT_COLUMNS = """event_id::bigint as event_id, events_timestamp,
 customer_id::bigint as customer_id, session_id::bigint as session_id, event_type,
 product_id::bigint as product_id, device_type, traffic_source,
 campaign_id::bigint as campaign_id, page_category,
 session_duration_sec::double as session_duration_sec, experiment_group"""
CAFE_COLUMNS = """Transaction_ID, Item, Quantity::bigint as Quantity,
 Price_Per_Unit::double as Price_Per_Unit, Total_Spent::double as Total_Spent, Payment_Method,
 Location, Transaction_Date"""

# Ingest and model upkeep
_TEXT_TIME = "strftime(transaction_timestamp, '%d/%m/%Y %H:%M:%S.%f') as transaction_timestamp"
_STAGED = TRANSACTION_COLUMNS.format(time=_TEXT_TIME).replace(
    "product_id::bigint", "coalesce(product_id, 0)::bigint"
).replace("campaign_id::bigint", "coalesce(campaign_id, 0)::bigint")
oracle("in_csv_ingest", f"select {_STAGED} from transactions_t", "transactions_t")
oracle(
    "in_csv_ingest_campaigns",
    "select campaign_id::bigint as campaign_id, channel, objective,"
    " strftime(start_date, '%d/%m/%Y') as start_date, strftime(end_date, '%d/%m/%Y') as end_date,"
    " target_segment, expected_uplift::double as expected_uplift from campaigns_t",
    "campaigns_t",
)
oracle(
    "in_csv_ingest_customers",
    "select customer_id::bigint as customer_id, signup_date, country, age::bigint as age, gender,"
    " loyalty_tier, acquisition_channel from customers_t",
    "customers_t",
)
oracle(
    "in_csv_ingest_products",
    "select product_id::bigint as product_id, category, brand, base_price::double as base_price,"
    " launch_date, is_premium::bigint as is_premium from products_t",
    "products_t",
)
oracle(
    "in_csv_ingest_events",
    "select * replace (strftime(events_timestamp, '%d/%m/%Y %H:%M:%S.%f') as events_timestamp,"
    " coalesce(product_id, 0) as product_id, coalesce(campaign_id, 0) as campaign_id)"
    f" from (select {EVENT_COLUMNS} from events_t)",
    "events_t",
)
oracle("in_csv_ingest_cafe", f"select {CAFE_COLUMNS} from cafe_raw", "cafe_raw")
oracle(
    "in_csv_rejects",
    "select (1 - refund_flag)::bigint as good, count(*) as n_rows from transactions_t group by 1",
    "transactions_t",
)
oracle(
    "in_type_staging",
    f"select {_STAGED.replace(_TEXT_TIME, 'transaction_timestamp')} from transactions_t",
    "transactions_t",
)
oracle(
    "in_write_table",
    f"select {TRANSACTION_COLUMNS.format(time='transaction_timestamp')},"
    " valid_transaction_flag::bigint as valid_transaction_flag,"
    " cast(date_trunc('month', transaction_timestamp) as date) as month from transactions_k",
    "transactions_k",
)
# Staged transactions with broken values; what does not convert is spelled out.
CTES["broken_t"] = (
    ("transactions_t",),
    """
select *, transaction_id % 11 = 0 or transaction_id % 13 = 0 as bad_time, transaction_id % 17 = 0 as bad_quantity,
 strftime(transaction_timestamp, '%d/%m/%Y %H:%M:%S.%f') as time_text
from transactions_t""",
)
oracle(
    "in_typed_rows",
    f"select {_STAGED.replace(_TEXT_TIME, 'transaction_timestamp')} from broken_t where not bad_time and not bad_quantity",
    "broken_t",
)
oracle(
    "in_typed_rejects",
    "select "
    + _STAGED.replace(
        _TEXT_TIME,
        "case when transaction_id % 11 = 0 then '31/02/2023 10:00' when transaction_id % 13 = 0 then 'x' || time_text"
        " else time_text end as transaction_timestamp",
    ).replace(
        "quantity::bigint as quantity",
        "quantity::varchar || case when bad_quantity then ' pcs' else '' end as quantity",
    )
    + ", case when bad_time and bad_quantity then 'transaction_timestamp,quantity' when bad_time"
    " then 'transaction_timestamp' else 'quantity' end as failed_columns from broken_t where bad_time or bad_quantity",
    "broken_t",
)
oracle(
    "in_typed_counts",
    "select 'transaction_timestamp' as column_name, count(*) filter (where bad_time) as lost_values from broken_t"
    " union all select 'quantity', count(*) filter (where bad_quantity) from broken_t",
    "broken_t",
)
oracle(
    "in_write_table_again",
    _ORACLE["in_write_table"]
    + " where refund_flag = 0 or date_trunc('month', transaction_timestamp) <> date '1996-03-01'",
)
oracle(
    "in_bucketed_join",
    "select customer_id::bigint as customer_id, country, sum(gross_revenue)::double as spent, count(*) as orders"
    " from transactions_k join customers_k using (customer_id) group by customer_id, country",
    "transactions_k",
    "customers_k",
)
oracle(
    "running_revenue_by_time",
    "select transaction_id::bigint as transaction_id, transaction_timestamp, gross_revenue::double as gross_revenue,"
    " (sum(gross_revenue) over (order by transaction_timestamp nulls first))::double as running_revenue"
    " from transactions_t",
    "transactions_t",
)
oracle(
    "running_price_by_name",
    "select product_id, name, price::double as price, coalesce(upto, 0)::double as running_price,"
    " coalesce(upto - ties, 0)::double as price_ahead from (select *,"
    " sum(price) over (order by name desc nulls last) as upto,"
    " sum(price) over (order by name desc nulls last range between current row and current row) as ties"
    " from (select p_partkey::bigint as product_id, case when p_partkey % 7 <> 0 then p_name end as name,"
    " p_retailprice::decimal(18,2) as price from part))",
)
oracle(
    "running_events_by_duration",
    "select event_id::bigint as event_id, session_duration_sec::double as duration, 1::bigint as one,"
    " (count(*) over (order by session_duration_sec::double nulls first))::bigint as events_so_far from events_t",
    "events_t",
)
oracle(
    "in_register_views",
    "select category, count(*) as products, sum(total_units_sold)::bigint as units_sold"
    " from product_performance group by category",
    "product_performance",
)
oracle(
    "in_add_unknown_member",
    "select campaign_id::bigint as campaign_id, channel, objective, target_segment, start_date"
    " from campaigns_k",
    "campaigns_k",
)

# Profiling and data quality
_TABLES = {
    "campaigns": "campaigns_t",
    "customers": "customers_t",
    "products": "products_t",
    "events": "events_t",
    "transactions": "transactions_t",
}
_COLUMNS = {
    "campaigns": "campaign_id channel objective start_date end_date target_segment expected_uplift",
    "customers": "customer_id signup_date country age gender loyalty_tier acquisition_channel",
    "products": "product_id category brand base_price launch_date is_premium",
    "events": "events_timestamp customer_id session_id event_type product_id device_type"
    " traffic_source campaign_id page_category session_duration_sec experiment_group",
    "transactions": "transaction_timestamp customer_id product_id quantity discount_applied"
    " gross_revenue campaign_id refund_flag",
}
for _name, _table in _TABLES.items():
    oracle(f"dq_row_count_{_name}", f"select count(*) as total_rows from {_table}", _table)
oracle("dq_row_count_cafe", "select count(*) as total_rows from orders")

_RANGES = {
    "campaign_dates": (
        "campaigns_t",
        "min(start_date) as first_day_of_campaigns, max(end_date) as last_day_of_campaigns",
    ),
    "uplift": (
        "campaigns_t",
        "min(expected_uplift)::double as min_uplift, max(expected_uplift)::double as max_uplift,"
        " sum(expected_uplift)::double / count(expected_uplift) as avg_uplift",
    ),
    "signup": (
        "customers_t",
        "min(signup_date) as min_signup_date, max(signup_date) as max_signup_date",
    ),
    "age": (
        "customers_t",
        "min(age)::bigint as min_age, max(age)::bigint as max_age,"
        " (sum(age) // count(age))::bigint as avg_age",
    ),
    "launch": (
        "products_t",
        "min(launch_date) as first_product_launch_date,"
        " max(launch_date) as last_product_launch_date",
    ),
    "price": (
        "products_t",
        "min(base_price)::double as min_price, max(base_price)::double as max_price,"
        " sum(base_price)::double / count(base_price) as avg_price",
    ),
    "transaction_time": (
        "transactions_t",
        "min(transaction_timestamp) as first_transaction,"
        " max(transaction_timestamp) as last_transaction",
    ),
    "revenue": (
        "transactions_t",
        "min(gross_revenue)::double as min_gross_revenue,"
        " max(gross_revenue)::double as max_gross_revenue,"
        " sum(gross_revenue)::double / count(gross_revenue) as avg_gross_revenue",
    ),
    "event_time": (
        "events_t",
        "min(events_timestamp) as first_event, max(events_timestamp) as last_event",
    ),
    "session_duration": (
        "events_t",
        "min(session_duration_sec)::double as min_sess_dur_seconds,"
        " max(session_duration_sec)::double / 60 as max_sess_dur_minutes,"
        " sum(session_duration_sec)::double / count(session_duration_sec) / 60"
        " as avg_sess_dur_minutes",
    ),
}
for _name, (_table, _select) in _RANGES.items():
    oracle(f"dq_range_{_name}", f"select {_select} from {_table}", _table)

for _name, _table, _key, _cast in (
    ("cafe", "cafe_raw", "Transaction_ID", ""),
    ("campaigns", "campaigns_t", "campaign_id", "::bigint"),
    ("events", "events_t", "event_id", "::bigint"),
    ("transactions", "transactions_t", "transaction_id", "::bigint"),
):
    oracle(
        f"dq_duplicate_keys_{_name}",
        f"select {_key}{_cast} as {_key}, count(*) as duplicate_count,"
        f" ({_key} is null)::bigint as null_key"
        f" from {_table} t group by t.{_key} having count(*) > 1",
        _table,
    )
for _name, _table, _key, _select in (
    ("customers", "customers_t", "customer_id", "customer_id::bigint as customer_id"),
    ("products", "products_t", "product_id", "product_id::bigint as product_id"),
    (
        "transactions",
        "transactions_t",
        "transaction_id",
        "transaction_id::bigint as transaction_id, customer_id::bigint as customer_id,"
        " quantity::bigint as quantity",
    ),
):
    oracle(
        f"dq_duplicate_rows_{_name}",
        f"select {_select}, duplicate_count from"
        f" (select *, count(*) over (partition by {_key}) as duplicate_count from {_table}) t"
        " where duplicate_count > 1",
        _table,
    )
for _name in ("campaigns", "customers", "products"):
    _counts = ", ".join(f"count({c}) as {c}" for c in _COLUMNS[_name].split())
    oracle(
        f"dq_completeness_{_name}",
        f"select count(*) as total_rows, {_counts} from {_TABLES[_name]}",
        _TABLES[_name],
    )
for _name in ("transactions", "events"):
    _counts = ", ".join(f"count(*) - count({c}) as {c}" for c in _COLUMNS[_name].split())
    oracle(
        f"dq_missing_{_name}",
        f"select count(*) as total_rows, {_counts} from {_TABLES[_name]}",
        _TABLES[_name],
    )
    oracle(
        f"dq_missing_campaign_after_cleaning_{_name}",
        "select count(*) as total_rows, count(*) - count(campaign_id) as campaign_id"
        f" from {_name}_k",
        f"{_name}_k",
    )
oracle(
    "dq_missing_cafe_date",
    "select count(*) as total_rows, count(*) - count(Transaction_Date) as Transaction_Date"
    " from cafe_raw",
    "cafe_raw",
)
for _column in ("Item", "Payment_Method", "Location"):
    oracle(
        f"dq_sentinel_count_{_column.lower()}",
        "select count(*) as missing_rows from cafe_raw"
        f" where {_column} is null or {_column} = 'ERROR' or {_column} = 'UNKNOWN'",
        "cafe_raw",
    )
oracle(
    "dq_conformance_transaction_id",
    "select count(*) as broken_rows from cafe_raw"
    " where left(Transaction_ID, 3) <> 'TXN' or length(Transaction_ID) > 11",
    "cafe_raw",
)
oracle(
    "dq_conformance_campaign_dates",
    "select count(*) as broken_rows from"
    " (select strftime(start_date, '%d/%m/%Y') as d from campaigns_t)"
    " where d is not null and try_strptime(d, '%d/%m/%Y') is null",
    "campaigns_t",
)

_FREQUENCIES = {
    "campaign_channel": ("campaigns_t", "channel", ""),
    "campaign_objective": ("campaigns_t", "objective", ""),
    "campaign_segment": ("campaigns_t", "target_segment", ""),
    "customer_country": ("customers_t", "country", ""),
    "customer_gender": ("customers_t", "gender", ""),
    "customer_loyalty": ("customers_t", "loyalty_tier", ""),
    "customer_acquisition": ("customers_t", "acquisition_channel", ""),
    "product_premium": ("products_t", "is_premium", ""),
    "product_brand": ("products_t", "brand", ""),
    "product_category": ("products_t", "category", ""),
    "transaction_customer": ("transactions_t", "customer_id", ""),
    "transaction_quantity": ("transactions_t", "quantity", ""),
    "transaction_discount": ("transactions_t", "discount_applied", ""),
    "transaction_campaign": ("transactions_t", "campaign_id", "where campaign_id is not null"),
    "transaction_refund": ("transactions_t", "refund_flag", ""),
    "event_customer": ("events_t", "customer_id", ""),
    "event_session": ("events_t", "session_id", ""),
    "event_type": ("events_t", "event_type", ""),
    "event_product": ("events_t", "product_id", "where product_id is not null"),
    "event_product_purchased": (
        "events_t",
        "product_id",
        "where product_id is not null and event_type = 'purchase'",
    ),
    "event_device": ("events_t", "device_type", ""),
    "event_source": ("events_t", "traffic_source", ""),
    "event_campaign": ("events_t", "campaign_id", ""),
    "event_campaign_purchased": ("events_t", "campaign_id", "where event_type = 'purchase'"),
    "event_page": ("events_t", "page_category", ""),
    "event_experiment": ("events_t", "experiment_group", ""),
}
_WHOLE = {"is_premium", "customer_id", "quantity", "campaign_id", "refund_flag", "session_id"}
_WHOLE |= {"product_id"}
for _name, (_table, _column, _where) in _FREQUENCIES.items():
    _shown = f"{_column}::bigint" if _column in _WHOLE else _column
    if _column == "discount_applied":
        _shown = "discount_applied::double"
    oracle(
        f"dq_frequency_{_name}",
        f"select {_shown} as {_column}, count(*) as n_rows from {_table} t {_where}"
        f" group by t.{_column}",
        _table,
    )

oracle("dq_distinct_values_country", "select distinct country from customers_t", "customers_t")
oracle("dq_distinct_values_item", "select distinct Item from cafe_raw", "cafe_raw")
oracle(
    "dq_distinct_values_item_prices",
    "select distinct Item, Price_Per_Unit::double as Price_Per_Unit, Quantity::bigint as Quantity,"
    " Total_Spent::double as Total_Spent from cafe_raw",
    "cafe_raw",
)
for _name, _table, _columns in (
    ("products", "products_t", ("brand", "category")),
    ("transaction_customers", "transactions_t", ("customer_id",)),
    ("transaction_products", "transactions_t", ("product_id",)),
    ("transaction_campaigns", "transactions_t", ("campaign_id",)),
    ("event_customers", "events_t", ("customer_id",)),
    ("event_sessions", "events_t", ("session_id",)),
    ("event_products", "events_t", ("product_id",)),
):
    oracle(
        f"dq_distinct_count_{_name}",
        "select " + ", ".join(f"count(distinct {c}) as {c}" for c in _columns) + f" from {_table}",
        _table,
    )
for _name, _fact, _dim, _key in (
    ("transaction_customer", "transactions_t", "customers_t", "customer_id"),
    ("transaction_product", "transactions_t", "products_t", "product_id"),
    ("transaction_campaign", "transactions_t", "campaigns_t", "campaign_id"),
    ("event_customer", "events_t", "customers_t", "customer_id"),
    ("event_product", "events_t", "products_t", "product_id"),
    ("event_campaign", "events_t", "campaigns_t", "campaign_id"),
    ("default_campaign", "transactions_k", "campaigns_t", "campaign_id"),
):
    oracle(
        f"dq_orphan_keys_{_name}",
        f"select f.{_key}::bigint as {_key}, count(*) as n_rows from {_fact} f"
        f" where f.{_key} is not null"
        f" and not exists (select 1 from {_dim} d where d.{_key} = f.{_key}) group by f.{_key}",
        _fact,
        _dim,
    )
oracle(
    "dq_co_missing_transactions",
    "select (product_id is null)::bigint as product_id_missing,"
    " (gross_revenue is null)::bigint as gross_revenue_missing, count(*) as n_rows"
    " from transactions_t group by 1, 2",
    "transactions_t",
)
oracle(
    "dq_row_with_global_stats_campaigns",
    "select campaign_id::bigint as campaign_id, start_date, campaigns_duration, end_date,"
    " (sum(campaigns_duration) over () // count(campaigns_duration) over ())::bigint"
    "  as avg_campaigns_duration,"
    " min(campaigns_duration) over () as min_campaigns_duration,"
    " max(campaigns_duration) over () as max_campaigns_duration"
    " from (select *, datediff('day', start_date, end_date) as campaigns_duration"
    "  from campaigns_t) t",
    "campaigns_t",
)
oracle(
    "dq_group_count_extremes_product",
    "select product_id::bigint as product_id, count(*) as products_count,"
    " max(count(*)) over () as max_products_count, min(count(*)) over () as min_products_count"
    " from transactions_t t where t.product_id is not null group by t.product_id",
    "transactions_t",
)

# Cleaning
oracle(
    "cl_strip_prefix",
    "select replace(Transaction_ID, 'TXN_', '') as Transaction_ID from cafe_raw",
    "cafe_raw",
)
oracle(
    "cl_after_first",
    "select product_id::bigint as product_id, substr(brand, instr(brand, '#') + 1) as brand"
    " from products_t",
    "products_t",
)
oracle(
    "cl_after_last",
    "select event_id::bigint as event_id, regexp_replace(event_type, '^.*_', '') as event_type"
    " from events_t",
    "events_t",
)


def _label(column: str) -> str:
    return (
        f"case when {column} is null or {column} in ('ERROR', 'UNKNOWN') then 'NA'"
        f" else {column} end as {column}"
    )


oracle(
    "cl_sentinels_to_label",
    f"select Transaction_ID, {_label('Item')}, {_label('Payment_Method')}, {_label('Location')}"
    " from cafe_raw",
    "cafe_raw",
)
oracle(
    "cl_sentinel_to_null",
    "select transaction_id::bigint as transaction_id, nullif(product_id, 0)::bigint as product_id,"
    " nullif(campaign_id, 0)::bigint as campaign_id from (select transaction_id,"
    " coalesce(product_id, 0) as product_id, coalesce(campaign_id, 0) as campaign_id"
    " from transactions_t)",
    "transactions_t",
)
_ITEM_PRICE = "select Transaction_ID, Item, Price_Per_Unit::double as Price_Per_Unit from "
oracle("cl_fill_from_lookup", _ITEM_PRICE + "cafe_items", "cafe_items")
oracle("cl_fill_from_lookup_parity", _ITEM_PRICE + "cafe_items_parity", "cafe_items_parity")
oracle(
    "cl_derive_mapping",
    "select Item, min(Price_Per_Unit)::double as Price_Per_Unit from cafe_labelled"
    " where Item <> 'NA' and Price_Per_Unit is not null"
    " group by Item having count(distinct Price_Per_Unit) = 1",
    "cafe_labelled",
)
oracle(
    "cl_derive_mapping_reverse",
    "select Price_Per_Unit::double as Price_Per_Unit, min(Item) as Item from cafe_labelled t"
    " where Item <> 'NA' and Price_Per_Unit is not null"
    " group by t.Price_Per_Unit having count(distinct Item) = 1",
    "cafe_labelled",
)
oracle("cl_fill_from_table", _ITEM_PRICE + "cafe_priced", "cafe_priced")
oracle(
    "cl_fill_by_product",
    "select Transaction_ID, Total_Spent::double as Total_Spent, Quantity::bigint as Quantity,"
    f" Price_Per_Unit::double as Price_Per_Unit from {_filled_raw}",
    _filled_raw,
)
oracle(
    "cl_null_to_default",
    "select event_id::bigint as event_id, coalesce(campaign_id, 0)::bigint as campaign_id"
    " from events_t",
    "events_t",
)
oracle(
    "cl_scale_and_rename",
    "select campaign_id::bigint as campaign_id,"
    " (expected_uplift * 100)::double as expected_uplift_pct from campaigns_t",
    "campaigns_t",
)
oracle(
    "cl_duration_days",
    "select campaign_id::bigint as campaign_id,"
    " datediff('day', start_date, end_date)::bigint as campaigns_duration_days from campaigns_t",
    "campaigns_t",
)
oracle(
    "cl_bin_column",
    "select customer_id::bigint as customer_id, age::bigint as age, age_group from customers_k",
    "customers_k",
)
oracle(
    "cl_validity_flag",
    "select transaction_id::bigint as transaction_id, product_id::bigint as product_id,"
    " gross_revenue::double as gross_revenue,"
    " valid_transaction_flag::bigint as valid_transaction_flag from transactions_k",
    "transactions_k",
)
oracle("cl_cafe_silver", f"select {CAFE_COLUMNS} from gold", "gold")
oracle("cl_cafe_silver_parity", f"select {CAFE_COLUMNS} from gold_parity", "gold_parity")
oracle(
    "cl_ecommerce_silver_campaigns",
    "select campaign_id::bigint as campaign_id, channel, objective, start_date, end_date,"
    " target_segment, expected_uplift_pct::double as expected_uplift_pct,"
    " campaigns_duration_days::bigint as campaigns_duration_days from campaigns_k",
    "campaigns_k",
)
oracle(
    "cl_ecommerce_silver_customers",
    "select customer_id::bigint as customer_id, signup_date, country, age::bigint as age, gender,"
    " loyalty_tier, acquisition_channel, age_group from customers_k",
    "customers_k",
)
oracle(
    "cl_ecommerce_silver_products",
    "select product_id::bigint as product_id, category, brand, base_price::double as base_price,"
    " launch_date, is_premium::bigint as is_premium from products_k",
    "products_k",
)
# Key 0 in the staged files means "missing".
_STAGED_KEY = ("product_id::bigint", "nullif(product_id, 0)::bigint")
oracle(
    "cl_ecommerce_silver_events",
    f"select {EVENT_COLUMNS.replace(*_STAGED_KEY)} from events_k",
    "events_k",
)
oracle(
    "cl_ecommerce_silver_transactions",
    f"select {TRANSACTION_COLUMNS.format(time='transaction_timestamp').replace(*_STAGED_KEY)},"
    " valid_transaction_flag::bigint as valid_transaction_flag from transactions_k",
    "transactions_k",
)

# Gold views
oracle("gv_gold_cafe_sales", f"select {CAFE_COLUMNS} from gold", "gold")
oracle(
    "gv_sales_base",
    "select transaction_date, customer_id::bigint as customer_id, product_id::bigint as product_id,"
    " quantity::bigint as quantity, discount_applied::double as discount_applied,"
    " gross_revenue::double as gross_revenue, campaign_id::bigint as campaign_id, objective"
    " from sales_base",
    "sales_base",
)
oracle(
    "gv_product_performance",
    "select product_id::bigint as product_id, base_price::double as base_price, category,"
    " total_units_sold::bigint as total_units_sold, total_revenue::double as total_revenue"
    " from product_performance",
    "product_performance",
)
oracle(
    "gv_campaign_performance",
    "select campaign_id::bigint as campaign_id, channel, target_segment,"
    " quantity::bigint as quantity, gross_revenue::double as gross_revenue,"
    " campaigns_duration_days::bigint as campaigns_duration_days from campaign_performance",
    "campaign_performance",
)
_TIME = (
    "select transaction_date, sales_year::bigint as sales_year,"
    " sales_month::bigint as sales_month, total_transactions,"
    " total_units_sold::bigint as total_units_sold, total_revenue::double as total_revenue"
)
oracle("gv_time_sales", f"{_TIME} from time_sales", "time_sales")
oracle(
    "gv_time_sales_no_refunds",
    f"{_TIME} from (select cast(transaction_timestamp as date) as transaction_date,"
    " year(transaction_timestamp) as sales_year, month(transaction_timestamp) as sales_month,"
    " count(*) as total_transactions, sum(quantity) as total_units_sold,"
    " sum(gross_revenue) as total_revenue from transactions_k"
    " where gross_revenue is not null and refund_flag = 0 group by 1, 2, 3)",
    "transactions_k",
)
oracle(
    "gv_customer_behavior",
    "select customer_id::bigint as customer_id, country, age_group, total_orders,"
    " total_spent::double as total_spent, avg_order_value::double as avg_order_value"
    " from customer_behavior",
    "customer_behavior",
)
oracle(
    "gv_event_behavior",
    "select event_id::bigint as event_id, customer_id::bigint as customer_id,"
    " campaign_id::bigint as campaign_id, age_group, channel,"
    " session_duration_sec::double as session_duration_sec, event_type from event_behavior",
    "event_behavior",
)

# Cafe analyses
oracle(
    "item_price_range",
    "select Item, max(Price_Per_Unit)::double as Max_Price,"
    " min(Price_Per_Unit)::double as Min_Price from gold group by Item",
    "gold",
)
oracle(
    "item_spend_range",
    "select Item, max(Total_Spent)::double as Max_Spent,"
    " min(Total_Spent)::double as Min_Spent from gold group by Item",
    "gold",
)
oracle("avg_price", f"select {mean('Price_Per_Unit')} as Avg_Price from gold", "gold")
oracle("avg_spend", f"select {mean('Total_Spent')} as Avg_Spend from gold", "gold")
for _name, _source, _direction in (
    ("top_items_by_quantity", "gold", "desc"),
    ("bottom_items_by_quantity", "gold", "asc"),
    ("top_items_by_quantity_parity", "gold_parity", "desc"),
):
    oracle(
        _name,
        "select Item, sum(Quantity)::bigint as Total_Quantity_Sold,"
        f" sum(Total_Spent)::double as Total_Spent_all from {_source} group by Item"
        f" order by sum(Quantity) {_direction}, Item limit 3",
        _source,
    )
oracle(
    "orders_by_payment",
    "select Payment_Method, count(*) as num_of_orders from gold group by Payment_Method",
    "gold",
)
oracle(
    "orders_by_location",
    "select Location, count(*) as num_of_orders from gold group by Location",
    "gold",
)
oracle(
    "payment_by_location",
    "select Payment_Method, Location, count(*) as number_of_orders from gold"
    " where Payment_Method <> 'NA' and Location <> 'NA' group by Payment_Method, Location",
    "gold",
)
oracle(
    "top_items_by_revenue",
    "select Item, sum(Total_Spent)::double as total_spent_sum from gold where Item <> 'NA'"
    " group by Item order by sum(Total_Spent) desc, Item limit 3",
    "gold",
)
oracle(
    "monthly_running_total",
    "select Sales_Month, strftime(Sales_Month, '%b') as Month_Name,"
    " Monthly_Revenue::double as Monthly_Revenue, Transactions,"
    " (sum(Monthly_Revenue) over (order by Sales_Month))::double as Running_Total from monthly",
    "monthly",
)
oracle(
    "monthly_contribution",
    "select Sales_Month, Monthly_Cont, Running_Cont,"
    " format('{:,.2f}', Monthly_Cont) || ' %' as Monthly_Cont_Pct,"
    " format('{:,.2f}', Running_Cont) || ' %' as Running_Cont_Pct"
    f" from (select Sales_Month, {share('r', 'w')} as Monthly_Cont,"
    f" {share('u', 'w')} as Running_Cont from (select Sales_Month, Monthly_Revenue as r,"
    " sum(Monthly_Revenue) over (order by Sales_Month) as u,"
    " sum(Monthly_Revenue) over () as w from monthly))",
    "monthly",
)
oracle(
    "weekday_sales",
    "select dayname(Transaction_Date) as Days_of_week, sum(Total_Spent)::double as Total_Spent,"
    " count(*) as Total_Transactions from gold t"
    " where t.Total_Spent is not null and Transaction_Date is not null group by 1",
    "gold",
)
_AOV = half_away(cents("Total_Spent"), "100 * count(*)", 2)
oracle(
    "overall_aov",
    f"select {half_away(cents('Total_Spent'), '100 * count(*)', 1)} as AOV from gold"
    " where Total_Spent is not null",
    "gold",
)
oracle(
    "monthly_aov",
    "select cast(date_trunc('month', Transaction_Date) as date) as Sales_Month,"
    f" {_AOV} as Monthly_AOV from gold"
    " where Total_Spent is not null and Transaction_Date is not null group by 1",
    "gold",
)
oracle(
    "location_aov",
    f"select Location as Channel, {_AOV} as AOV from gold"
    " where Total_Spent is not null and Location <> 'NA' group by Location",
    "gold",
)
oracle(
    "payment_aov",
    f"select Payment_Method, {_AOV} as AOV from gold"
    " where Total_Spent is not null and Payment_Method <> 'NA' group by Payment_Method",
    "gold",
)
_PARETO = (
    "select Item, Item_Revenue::double as Item_Revenue,"
    f" {share('Item_Revenue', 'all_revenue')} as Revenue_Pct,"
    f" {share('upto', 'all_revenue')} as Cumulative_Revenue_Pct"
)
oracle("item_pareto", f"{_PARETO} from item_run", "item_run")
oracle("item_pareto_parity", f"{_PARETO} from item_run_parity", "item_run_parity")
oracle(
    "item_pareto_80",
    f"{_PARETO} from item_run where 100 * (upto - ties) < 80 * all_revenue",
    "item_run",
)
oracle(
    "payment_revenue_share",
    f"select Payment_Method, r::double as Payment_Revenue, {share('r', 'w')} as Revenue_Pct"
    " from (select Payment_Method, sum(Total_Spent) as r, sum(sum(Total_Spent)) over () as w"
    " from gold where Total_Spent is not null and Payment_Method <> 'NA' group by Payment_Method)",
    "gold",
)
oracle(
    "spend_buckets",
    "select Spend_Category, n as Transactions, r::double as Revenue,"
    f" {count_share('n', 'all_n')} as Transaction_Pct, {share('r', 'w')} as Revenue_Pct"
    " from (select case when Total_Spent < 5 then 'Low' when Total_Spent <= 15 then 'Medium'"
    "  else 'High' end as Spend_Category, count(*) as n, sum(Total_Spent) as r,"
    "  sum(count(*)) over () as all_n, sum(sum(Total_Spent)) over () as w"
    "  from gold where Total_Spent is not null group by 1)",
    "gold",
)

# E-commerce analyses
oracle(
    "top_transactions",
    "select transaction_date, customer_id::bigint as customer_id,"
    " product_id::bigint as product_id, quantity::bigint as quantity,"
    " gross_revenue::double as gross_revenue, revenue_rank from (select *,"
    " rank() over (order by gross_revenue desc nulls last) as revenue_rank from sales_base)"
    " where revenue_rank <= 10",
    "sales_base",
)
oracle(
    "products_by_price",
    "select base_price::double as base_price, product_id::bigint as product_id"
    " from product_performance",
    "product_performance",
)
for _name, _none, _some in (
    ("discount_impact", "No", "Yes"),
    ("discount_impact_parity", "Yes", "No"),
):
    oracle(
        _name,
        f"select case when discount_applied = 0 then '{_none}' else '{_some}' end"
        " as discount_status, count(*) as Total_transactions,"
        " sum(quantity)::bigint as total_quantity, sum(gross_revenue)::double as total_revenue,"
        f" {mean('gross_revenue')} as avg_order_revenue from sales_base group by 1",
        "sales_base",
    )
_SALES = (
    "count(*) as total_transactions, sum(quantity)::bigint as total_units_sold,"
    " sum(gross_revenue)::double as total_revenue,"
    f" {mean('gross_revenue')} as avg_order_value"
)
oracle(
    "discount_buckets",
    f"select discount_applied::double as discount_applied, {_SALES} from sales_base t"
    " group by t.discount_applied",
    "sales_base",
)
for _name, _control, _treated in (
    ("campaign_ab", "Control - No Campaign", "Treatment - Campaign"),
    ("campaign_ab_parity", "Control - No Campaing", "Treatment - Campaing"),
):
    oracle(
        _name,
        f"select case when campaign_id = 0 then '{_control}' else '{_treated}' end"
        " as campaign_group_test, case when discount_applied = 0 then 'No Discount'"
        f" else 'Yes Discount' end as discount_status, {_SALES} from sales_base group by 1, 2",
        "sales_base",
    )
_DISCOUNTED = "count(*) filter (where discount_applied > 0)"
oracle(
    "kpi_dashboard",
    "select count(*) as total_transactions, count(distinct customer_id) as total_customers,"
    " sum(quantity)::bigint as total_units_sold, sum(gross_revenue)::double as total_revenue,"
    f" {mean('gross_revenue')} as avg_order_value,"
    " sum(quantity)::double / count(quantity) as avg_units_per_order,"
    f" {_DISCOUNTED} as discounted_orders,"
    f" {half_away(f'100 * {_DISCOUNTED}', 'count(*)', 2)} as discount_penetration_pct"
    " from sales_base",
    "sales_base",
)
oracle(
    "top_products",
    "select product_id::bigint as product_id, category, total_revenue::double as total_revenue,"
    " total_units_sold::bigint as total_units_sold, revenue_rank from (select *,"
    " dense_rank() over (order by total_revenue desc nulls last) as revenue_rank"
    " from product_performance) order by revenue_rank, product_id limit 10",
    "product_performance",
)
oracle(
    "category_performance",
    "select category, count(product_id) as number_of_products,"
    " sum(total_units_sold)::bigint as units_sold, sum(total_revenue)::double as total_revenue,"
    f" {mean('total_revenue', scale=1)} as avg_product_revenue"
    " from product_performance group by category",
    "product_performance",
)
oracle(
    "category_share",
    f"select category, r::double as total_revenue, {share('r', 'w')} as revenue_share_pct from"
    " (select category, sum(total_revenue) as r, sum(sum(total_revenue)) over () as w"
    " from product_performance group by category)",
    "product_performance",
)
oracle(
    "price_segments",
    "select case when base_price < 50 then 'Low Price' when base_price <= 100 then 'Mid Price'"
    " when base_price <= 200 then 'High Price' else 'Extreme High Price' end as price_segment,"
    " count(product_id) as products, sum(total_units_sold)::bigint as units_sold,"
    " sum(total_revenue)::double as total_revenue from product_performance group by 1",
    "product_performance",
)
oracle(
    "top_campaigns",
    "select campaign_id::bigint as campaign_id, r::double as total_revenue, revenue_rank from"
    " (select campaign_id, sum(gross_revenue) as r,"
    " rank() over (order by sum(gross_revenue) desc) as revenue_rank"
    " from campaign_performance group by campaign_id) order by revenue_rank, campaign_id limit 10",
    "campaign_performance",
)
_CHANNELS = (
    "select channel, count(*) as campaigns, count(distinct campaign_id) as distinct_campaigns,"
    " sum(gross_revenue) as r, sum(sum(gross_revenue)) over () as w"
    " from campaign_performance group by channel"
)
oracle(
    "channel_share",
    "select channel, campaigns, r::double as total_revenue,"
    f" {raw_share('r', 'w')} as revenue_share_pct from ({_CHANNELS})",
    "campaign_performance",
)
oracle(
    "channel_share_distinct",
    "select channel, campaigns, r::double as total_revenue,"
    f" {raw_share('r', 'w')} as revenue_share_pct, distinct_campaigns from ({_CHANNELS})",
    "campaign_performance",
)
oracle(
    "objective_performance",
    "select objective, transactions, units_sold, r::double as total_revenue,"
    f" {raw_share('r', 'w')} as revenue_share_pct, avg_order_value from (select objective,"
    " count(*) as transactions, sum(quantity)::bigint as units_sold, sum(gross_revenue) as r,"
    f" sum(sum(gross_revenue)) over () as w, {mean('gross_revenue')} as avg_order_value"
    " from sales_base group by objective)",
    "sales_base",
)
oracle(
    "segment_performance",
    "select target_segment, count(*) as transactions, sum(quantity)::bigint as units_sold,"
    " sum(gross_revenue)::double as total_revenue,"
    " sum(gross_revenue)::double / count(*) as avg_order_value"
    " from campaign_performance group by target_segment",
    "campaign_performance",
)
oracle(
    "campaign_efficiency",
    "select campaign_id::bigint as campaign_id, channel,"
    " campaigns_duration_days::bigint as campaigns_duration_days,"
    " r::double as total_revenue, revenue_per_day, channel_rank from (select *,"
    f" {half_away('(r * 100)::bigint', '100 * campaigns_duration_days', 2)} as revenue_per_day,"
    " rank() over (partition by channel order by"
    "  r::double / campaigns_duration_days desc nulls last) as channel_rank from"
    " (select campaign_id, channel, campaigns_duration_days, sum(gross_revenue) as r"
    "  from campaign_performance group by all)) where channel_rank <= 3",
    "campaign_performance",
)
for _name, _key, _prefix in (
    ("seasonality_month", "sales_month", "monthly"),
    ("yearly_trend", "sales_year", "yearly"),
):
    oracle(
        _name,
        f"select {_key}::bigint as {_key}, r::double as {_prefix}_revenue,"
        f" n::bigint as {_prefix}_transactions, u::bigint as {_prefix}_units,"
        f" {share('r', 'w')} as revenue_pct from (select {_key}, sum(total_revenue) as r,"
        " sum(total_transactions) as n, sum(total_units_sold) as u,"
        f" sum(sum(total_revenue)) over () as w from time_sales group by {_key})",
        "time_sales",
    )
CTES["month_revenue"] = (
    ("time_sales",),
    "select cast(date_trunc('month', transaction_date) as date) as month,"
    " sum(total_revenue) as r from time_sales group by 1",
)
CTES["month_revenue_filled"] = (
    ("month_revenue",),
    "select cast(m.generate_series as date) as month, r.r from"
    " (select unnest(generate_series((select min(month) from month_revenue),"
    "  (select max(month) from month_revenue), interval 1 month)) as generate_series) m"
    " left join month_revenue r on r.month = cast(m.generate_series as date)",
)
for _name, _source in (
    ("month_over_month", "month_revenue"),
    ("month_over_month_filled", "month_revenue_filled"),
):
    oracle(
        _name,
        "select year(month)::bigint as sales_year, month(month)::bigint as sales_month,"
        " r::double as monthly_revenue, p::double as previous_month_revenue,"
        f" {half_away('((r - p) * 100)::bigint * 100', '(p * 100)::bigint', 2)}"
        " as revenue_change_pct"
        f" from (select *, lag(r) over (order by month) as p from {_source})",
        _source,
    )
oracle(
    "quarterly_demand",
    "select sales_year::bigint as sales_year, quarter(transaction_date)::bigint as sales_quarter,"
    " sum(total_transactions)::bigint as quarterly_transactions,"
    " sum(total_units_sold)::bigint as quarterly_units from time_sales t"
    " group by t.sales_year, quarter(transaction_date)",
    "time_sales",
)
oracle(
    "customer_segments",
    "select case when t.total_spent < 100 then 'Low Value' when t.total_spent <= 300"
    " then 'Medium Value' else 'High Value' end as customer_segment, count(*) as customers,"
    f" {mean('t.total_spent')} as avg_spending, sum(t.total_spent)::double as total_spent"
    " from customer_behavior t where t.total_spent > 0 group by 1",
    "customer_behavior",
)
oracle(
    "top_customers",
    "select customer_id::bigint as customer_id, country, age_group,"
    " total_spent::double as total_spent, spending_rank from (select *,"
    " rank() over (order by total_spent desc) as spending_rank from customer_behavior) t"
    " order by spending_rank, t.customer_id limit 10",
    "customer_behavior",
)
_AOV_OF_AOV = mean("t.avg_order_value")
oracle(
    "country_performance",
    "select country, count(*) as customers, sum(total_orders)::bigint as total_orders,"
    f" sum(total_spent)::double as total_revenue, {_AOV_OF_AOV} as avg_order_value"
    " from customer_behavior t group by country",
    "customer_behavior",
)
oracle(
    "age_group_spend",
    "select age_group, count(*) as customers, sum(total_spent)::double as total_revenue,"
    f" {_AOV_OF_AOV} as avg_order_value from customer_behavior t group by age_group",
    "customer_behavior",
)
oracle(
    "event_distribution",
    f"select event_type, n as total_events, {count_share('n', 'w')} as event_pct from"
    " (select event_type, count(*) as n, sum(count(*)) over () as w"
    " from event_behavior group by event_type)",
    "event_behavior",
)
oracle(
    "channel_funnel_counts",
    "select channel, event_type, count(*) as events from event_behavior"
    " group by channel, event_type",
    "event_behavior",
)
oracle(
    "funnel_conversion",
    "select views, clicks, carts, purchases,"
    f" {count_share('clicks', 'views')} as view_to_click_rate_pct,"
    f" {count_share('carts', 'clicks')} as click_to_cart_rate_pct,"
    f" {count_share('purchases', 'carts')} as cart_to_purchase_rate_pct from (select"
    " count(*) filter (where event_type = 'view') as views,"
    " count(*) filter (where event_type = 'click') as clicks,"
    " count(*) filter (where event_type = 'cart') as carts,"
    " count(*) filter (where event_type = 'purchase') as purchases from event_behavior)",
    "event_behavior",
)
_DURATION = mean("session_duration_sec")
oracle(
    "session_duration_by_event",
    f"select event_type, count(*) as events, {_DURATION} as avg_session_duration_sec"
    " from event_behavior group by event_type",
    "event_behavior",
)
oracle(
    "engagement_by_channel",
    f"select channel, count(*) as events, {_DURATION} as avg_session_duration_sec"
    " from event_behavior group by channel",
    "event_behavior",
)
oracle(
    "session_duration_by_age",
    f"select age_group, {_DURATION} as avg_session_duration from event_behavior group by age_group",
    "event_behavior",
)
_FACT = "from lineitem join orders on l_orderkey = o_orderkey"
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
    oracle(f"{_name}_no_refunds", _ORACLE[_name].replace(_FACT, f"{_FACT} where l_returnflag <> 'R'"))
oracle(
    "funnel_by_device",
    "select device_type, views, clicks, carts, purchases,"
    f" {count_share('clicks', 'views')} as view_to_click_rate_pct,"
    f" {count_share('carts', 'clicks')} as click_to_cart_rate_pct,"
    f" {count_share('purchases', 'carts')} as cart_to_purchase_rate_pct from (select device_type,"
    " count(*) filter (where event_type = 'view') as views,"
    " count(*) filter (where event_type = 'click') as clicks,"
    " count(*) filter (where event_type = 'cart') as carts,"
    " count(*) filter (where event_type = 'purchase') as purchases"
    " from events_k group by device_type)",
    "events_k",
)
oracle(
    "top_products_by_category",
    "select category, product_id::bigint as product_id,"
    " total_units_sold::bigint as total_units_sold, rank from (select *, dense_rank() over"
    " (partition by category order by total_units_sold desc nulls last) as rank"
    " from product_performance) where rank <= 2",
    "product_performance",
)
oracle(
    "customer_pareto",
    f"select customer_id::bigint as customer_id, r::double as total, {share('r', 'w')} as share_pct,"
    f" {share('c', 'w')} as cumulative_pct from (select *, sum(r) over (order by r desc) as c,"
    " sum(r) over () as w from (select customer_id, sum(gross_revenue) as r from transactions_k"
    " group by customer_id having sum(gross_revenue) is not null))",
    "transactions_k",
)

# Profiles in one scan
for _table in ("campaigns", "customers", "products", "events", "transactions"):
    _parts = [
        f"select '{_name}' as column_name, cast({_column} as varchar) as value, count(*) as n_rows from {_from} t {_where}"
        f" group by t.{_column}"
        for _name, (_from, _column, _where) in _FREQUENCIES.items()
        if _from == f"{_table}_t"
    ]
    oracle(f"dq_profile_frequencies_{_table}", " union all ".join(_parts), f"{_table}_t")
_DATES = {"start_date", "end_date", "signup_date", "launch_date"}
_TIMES = {"transaction_timestamp", "events_timestamp"}


def _as_text(column: str) -> str:
    """A value as Spark shows it: times without a fraction of zeros."""
    if column in _TIMES:
        return f"regexp_replace(regexp_replace(strftime({column}, '%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '\\.$', '')"
    return f"cast({column} as varchar)"


for _table, _names in {
    "campaigns": "campaign_id channel objective start_date end_date target_segment expected_uplift",
    "customers": "customer_id signup_date country age gender loyalty_tier acquisition_channel",
    "products": "product_id category brand base_price launch_date is_premium",
    "events": "event_id events_timestamp customer_id session_id event_type product_id device_type traffic_source"
    " campaign_id page_category session_duration_sec experiment_group",
    "transactions": "transaction_id transaction_timestamp customer_id product_id quantity discount_applied gross_revenue"
    " campaign_id refund_flag",
}.items():
    _parts = [
        f"select '{_column}' as column_name, {_as_text(_column)} as value, count(*) as n from {_table}_t group by {_column}"
        for _column in _names.split()
    ]
    oracle(
        f"dq_profile_{_table}",
        "select column_name, sum(n)::bigint as total_rows, coalesce(sum(n) filter (where value is null), 0)::bigint"
        " as missing, count(value) as distinct_values,"
        " (arg_min(value, struct_pack(a := -n, b := value)) filter (where value is not null)) as top_value,"
        " (max(n) filter (where value is not null))::bigint as top_rows"
        f" from ({' union all '.join(_parts)}) group by column_name",
        f"{_table}_t",
    )
oracle(
    "dq_sketch_customers_by_month",
    "select month, customer_id, product_id, 1::bigint as customer_id_near, 1::bigint as product_id_near from ("
    " select cast(date_trunc('month', transaction_timestamp) as date) as month,"
    "  count(distinct customer_id) as customer_id, count(distinct product_id) as product_id"
    "  from transactions_t group by grouping sets ((1), ()))",
    "transactions_t",
)
oracle(
    "in_csv_reject_reasons",
    "select reason, count(*) as n_rows, (case when reason = 'good' then 0 else count(*) end)::bigint as n_placed from ("
    " select case when transaction_id % 101 = 0 then 'number of fields'"
    "  when refund_flag = 1 then 'quantity: ' || quantity::varchar || ' pcs' else 'good' end as reason"
    " from transactions_t) group by reason",
    "transactions_t",
)

# Checks on tables with faults
oracle(
    "dq_duplicate_keys_cafe_repeated",
    "select Transaction_ID, 2::bigint as duplicate_count, 0::bigint as null_key from cafe_raw"
    " where Transaction_ID like '%7'",
    "cafe_raw",
)
for _table, _key in (("campaigns", "campaign_id"), ("events", "event_id")):
    oracle(
        f"dq_duplicate_keys_{_table}_repeated",
        f"select {_key}::bigint as {_key}, 2::bigint as duplicate_count, 0::bigint as null_key from {_table}_t"
        f" where {_key} % 7 = 0",
        f"{_table}_t",
    )
for _table, _key in (("customers", "customer_id"), ("products", "product_id")):
    oracle(
        f"dq_duplicate_rows_{_table}_repeated",
        f"select {_key}::bigint as {_key}, 2::bigint as duplicate_count from {_table}_t, range(2) where {_key} % 7 = 0",
        f"{_table}_t",
    )
for _name in ("transaction_customer", "transaction_product", "transaction_campaign", "event_customer", "event_product", "event_campaign"):
    _from, _key = f"{_name.split('_')[0]}s_t", f"{_name.split('_')[1]}_id"
    _dim = f"{_name.split('_')[1]}s_t"
    oracle(
        f"dq_orphan_keys_{_name}_lacking",
        f"select f.{_key}::bigint as {_key}, count(*) as n_rows from {_from} f where f.{_key} is not null"
        f" and f.{_key} not in (select {_key} from {_dim} where {_key} % 5 <> 0) group by f.{_key}",
        _from,
        _dim,
    )

# Text under the server's collation: letter case and trailing blanks do not count
_KNOWN = "(select * replace (lower(channel) as channel) from campaign_performance where campaign_id % 10 <> 7)"
oracle(
    "gv_campaign_performance_collated",
    _ORACLE["gv_campaign_performance"] .replace("from campaign_performance", f"from {_KNOWN}"),
)
oracle(
    "channel_share_collated",
    "select channel, campaigns, r::double as total_revenue,"
    f" {raw_share('r', 'w')} as revenue_share_pct from ({_CHANNELS.replace('from campaign_performance', f'from {_KNOWN}')})",
    "campaign_performance",
)
oracle("funnel_conversion_collated", _ORACLE["funnel_conversion"])
oracle(
    "cl_cafe_silver_collated",
    f"select * replace (lower(Item) as Item, lower(Location) as Location) from (select {CAFE_COLUMNS} from gold)",
    "gold",
)
oracle("payment_by_location_collated", f"select * replace (lower(Location) as Location) from ({_ORACLE['payment_by_location']})")
oracle("location_aov_collated", f"select * replace (lower(Channel) as Channel) from ({_ORACLE['location_aov']})")
