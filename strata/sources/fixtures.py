"""Retail-shaped views over the driver's TPC-H-like test tables.

The test tables have no SCD history, no CDC log, no NULLs and no zero-order
customers, so these views derive them.  Every view reads its *whole* base
table; the ``%`` expressions below derive attributes (which rows carry
history, a NULL, a later create time) and never subset the work.

The same SQL text runs in Spark and in DuckDB (the oracle), which keeps the
two sides' inputs identical.  ``{TS}`` is the typed-literal prefix of a
time-zone-free timestamp: ``timestamp_ntz`` in Spark, ``timestamp`` in DuckDB.
Money is integer cents.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .tables import register_tables

FIXTURE_SQL: dict[str, str] = {
    # open versions for every customer + a closed history row for every 5th
    "fx_customers_scd2": """
select c_custkey as customer_id, c_name as first_name, 'L' || cast(c_custkey % 97 as string) as last_name,
  lower(c_name) || '@example.com' as email, c_mktsegment as loyalty_tier,
  n_name || '-' || cast(c_custkey % 13 as string) as city, 'S' || cast(c_custkey % 7 as string) as state,
  n_name as country, cast({TS}'1994-01-01 00:00:00' as date) + cast(c_custkey % 365 as int) as registration_date,
  {TS}'1995-01-01 00:00:00' as valid_from, {TS}'9999-12-31 00:00:00' as valid_to
from customer join nation on c_nationkey = n_nationkey
union all
select c_custkey, c_name, 'L' || cast(c_custkey % 97 as string), lower(c_name) || '@example.com', 'OLD',
  n_name || '-' || cast(c_custkey % 13 as string), 'S' || cast(c_custkey % 7 as string), n_name,
  cast({TS}'1994-01-01 00:00:00' as date) + cast(c_custkey % 365 as int),
  {TS}'1990-01-01 00:00:00', {TS}'1995-01-01 00:00:00'
from customer join nation on c_nationkey = n_nationkey where c_custkey % 5 = 0""",
    # every order; orders of customers with key % 10 = 3 are closed history
    # (so those customers have no current order); NULL discount for key % 7 = 0
    "fx_orders_scd2": """
select o_orderkey as order_id, o_custkey as customer_id,
  case o_orderstatus when 'F' then 'delivered' when 'P' then 'shipped' else 'placed' end as order_status,
  cast(o_orderdate as date) as order_date,
  cast(o_orderdate as date) + cast(o_orderkey % 11 as int) as updated_at,
  cast(round(o_totalprice * 100, 0) as bigint) as total_cents,
  case when o_orderkey % 7 = 0 then null
       else cast(round(o_totalprice, 0) as bigint) * (o_orderkey % 5) end as discount_cents,
  r_name as shipping_country, n_name as shipping_state,
  n_name || '-' || cast(o_custkey % 13 as string) as shipping_city,
  case when o_custkey % 10 = 3 then {TS}'2002-01-01 00:00:00'
       else {TS}'9999-12-31 00:00:00' end as valid_to
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey""",
    # (order_id, line_no) repeats, so it doubles as an update feed; NULL flags
    "fx_order_items": """
select l_orderkey as order_id, l_partkey as product_id, l_suppkey as warehouse_id,
  l_linenumber as line_no, cast(l_quantity as bigint) as quantity,
  cast(round(l_extendedprice * 100, 0) as bigint) as line_cents,
  case l_returnflag when 'R' then true when 'A' then false else null end as return_requested,
  case when l_returnflag = 'R' and l_linenumber % 2 = 0 then 'damaged' else null end as return_reason,
  l_shipdate as ts
from lineitem""",
    # every 11th product has a category that no category row has, so the
    # category inner join drops its lines
    "fx_products": """
select p_partkey as product_id, p_name as product_name, p_brand as brand,
  case when p_partkey % 11 = 0 then 'NONE-' || p_type else p_type end as category_id,
  cast(round(p_retailprice * 100, 0) as bigint) as retail_cents
from part""",
    "fx_categories": """
select distinct p_type as category_id, lower(p_type) as category_name from part""",
    # stock rows of every 9th product carry an id no product has, so those
    # products have no stock (current_stock defaults to 0)
    "fx_inventory": """
select case when l_partkey % 9 = 0 then -l_partkey else l_partkey end as product_id,
  l_suppkey as warehouse_id, cast(l_shipdate as date) as snapshot_date,
  cast(l_quantity as bigint) as quantity_available, l_orderkey, l_linenumber
from lineitem""",
    # NULL referrer for every 5th event; a session can have several referrers
    "fx_clickstream": """
select event_id, cast(user_id as string) || '-' || cast(cast(ts as date) as string) as session_id,
  user_id as customer_id, event_type, ts as event_timestamp,
  case event_id % 5 when 0 then null when 1 then 'google' when 2 then 'email'
    when 3 then 'social' else 'affiliate' end as referrer
from events""",
    # CDC log: create (late create for key % 4 = 1), update, no-op update,
    # tied update, delete with a NULL row image, re-create after delete
    "fx_orders_cdc": """
select o_orderkey as pk, 'c' as op, case when o_orderkey % 4 = 1 then 2500 else 1000 end as ts_ms,
  o_orderstatus as st, o_custkey as cust from orders
union all select o_orderkey, 'u', 2000, 'X', o_custkey from orders where o_orderkey % 3 = 0
union all select o_orderkey, 'u', 3000, 'X', o_custkey from orders where o_orderkey % 6 = 0
union all select o_orderkey, 'u', 3000, 'Y', o_custkey from orders where o_orderkey % 12 = 0
union all select o_orderkey, 'd', 4000, cast(null as string), cast(null as bigint) from orders
  where o_orderkey % 10 = 0
union all select o_orderkey, 'c', 5000, 'X', o_custkey from orders where o_orderkey % 20 = 0""",
}

# Change batch used by the incremental-maintenance checks: 1 % of orders get a
# new status and move one day later (the old date must be recomputed too).
FIXTURE_SQL["fx_orders_scd2_after"] = """
select order_id, customer_id,
  case when order_id % 100 = 7 then 'delivered' else order_status end as order_status,
  case when order_id % 100 = 7 then order_date + 1 else order_date end as order_date,
  updated_at, total_cents, discount_cents, shipping_country, shipping_state, shipping_city, valid_to
from fx_orders_scd2"""
# ... and 1 % of order items change quantity and amount.
FIXTURE_SQL["fx_order_items_after"] = """
select order_id, product_id, warehouse_id, line_no,
  case when order_id % 100 = 7 then quantity + 1 else quantity end as quantity,
  case when order_id % 100 = 7 then line_cents + 100 else line_cents end as line_cents,
  return_requested, return_reason, ts
from fx_order_items"""
FIXTURE_SQL["fx_clickstream_after"] = """
select event_id, session_id, customer_id,
  case when event_id % 100 = 7 then 'purchase' else event_type end as event_type,
  event_timestamp,
  case when event_id % 100 = 8 then 'google' else referrer end as referrer
from fx_clickstream"""

# ... and 1 % of customers change loyalty tier: the open row closes and a new
# open row starts (profile-only changes must reach customer 360 too).
FIXTURE_SQL["fx_customers_scd2_after"] = """
select customer_id, first_name, last_name, email, loyalty_tier, city, state, country, registration_date, valid_from,
  case when customer_id % 100 = 7 and valid_to >= {TS}'9999-12-31 00:00:00'
       then {TS}'2001-01-01 00:00:00' else valid_to end as valid_to
from fx_customers_scd2
union all
select customer_id, first_name, last_name, email, 'PLATINUM', city, state, country, registration_date, {TS}'2001-01-01 00:00:00', valid_to
from fx_customers_scd2 where customer_id % 100 = 7 and valid_to >= {TS}'9999-12-31 00:00:00'"""
# ... and stock snapshots of 1 % of products get a newer, larger count.
FIXTURE_SQL["fx_inventory_after"] = """
select * from fx_inventory
union all
select product_id, warehouse_id, snapshot_date + 1, quantity_available + 7, l_orderkey, l_linenumber
from fx_inventory where product_id % 100 = 7"""

# order items with a unit price and a line total; every fifth order's third
# line is off by one
PRICED = """cast(line_cents as double) / 100 / quantity as unit_price,
  cast(line_cents as double) / 100 + case when line_no = 3 and order_id % 5 = 0 then 1 else 0 end as line_total"""
FIXTURE_SQL["fx_order_items_priced"] = f"select *, {PRICED} from fx_order_items"

# Clickstream as Bronze keeps it, every field a string, some of which no cast takes.
FIXTURE_SQL["fx_clickstream_raw"] = """
select cast(event_id as string) as event_id, session_id,
  case when event_id % 70 = 5 then 'u' || cast(customer_id as string) else cast(customer_id as string) end as customer_id,
  event_type, case when event_id % 50 = 3 then 'day ' || cast(event_id as string)
                   else cast(event_timestamp as string) end as event_timestamp, referrer
from fx_clickstream"""
# One table a source, with rows that break each of its quality rules.
FIXTURE_SQL |= {
    "fx_dq_orders": """
select case when order_id % 97 = 0 then null else order_id end as order_id,
  case when order_id % 89 = 0 then null else customer_id end as customer_id,
  case when order_id % 79 = 0 then null when order_id % 83 = 0 then -1.0
       else cast(total_cents as double) / 100 end as total_amount
from fx_orders_scd2""",
    "fx_dq_products": """
select case when product_id % 31 = 0 then null else product_id end as product_id,
  case when product_id % 13 = 0 then null else product_name end as sku,
  case when product_id % 17 = 0 then null when product_id % 7 = 0 then 0.0
       else cast(retail_cents as double) / 100 end as retail_price
from fx_products""",
    "fx_dq_order_items": """
select case when order_id % 53 = 0 then null else order_id * 10 + line_no end as order_item_id,
  case when order_id % 47 = 0 then null else order_id end as order_id,
  case when product_id % 59 = 0 then null else product_id end as product_id,
  case when order_id % 61 = 0 then null when order_id % 43 = 0 then cast(0 as bigint) else quantity end as quantity
from fx_order_items""",
    "fx_dq_customers": """
select case when customer_id % 37 = 0 then null else customer_id end as customer_id,
  case when customer_id % 11 = 0 then null else email end as email,
  case when customer_id % 9 = 0 then 'none' when customer_id % 7 = 0 then null else 'gold' end as loyalty_tier
from fx_customers_scd2""",
    "fx_dq_categories": """
select case when category_id like 'S%' then null else category_id end as category_id,
  case when category_id like '%L' then null else category_name end as category_name
from fx_categories""",
    "fx_dq_clickstream": """
select case when event_id % 41 = 0 then null else event_id end as event_id,
  case when event_id % 17 = 0 then null else event_type end as event_type,
  case when event_id % 19 = 0 then null else event_timestamp end as event_timestamp
from fx_clickstream""",
    "fx_dq_inventory": """
select case when l_orderkey % 23 = 0 then null else l_orderkey end as snapshot_id,
  case when l_orderkey % 29 = 0 then null else product_id end as product_id,
  case when l_orderkey % 67 = 0 then null when l_orderkey % 71 = 0 then cast(-5 as bigint)
       else quantity_available end as quantity_on_hand
from fx_inventory""",
}

SPARK_TS = "timestamp_ntz"
DUCKDB_TS = "timestamp"


def fixture_text(name: str, ts_prefix: str) -> str:
    return FIXTURE_SQL[name].replace("{TS}", ts_prefix)


def referenced_fixtures(sql: str) -> list[str]:
    """Fixture names a SQL text needs, dependencies first."""
    seen: list[str] = []

    def visit(n: str) -> None:
        for dep in re.findall(r"\bfx_[a-z0-9_]+\b", FIXTURE_SQL[n]):
            if dep != n and dep in FIXTURE_SQL:
                visit(dep)
        if n not in seen:
            seen.append(n)

    for name in re.findall(r"\bfx_[a-z0-9_]+\b", sql):
        if name in FIXTURE_SQL:
            visit(name)
    return seen


def with_fixtures(sql: str, ts_prefix: str = DUCKDB_TS) -> str:
    """Prefix ``sql`` with a WITH clause defining every fixture it uses."""
    names = referenced_fixtures(sql)
    if not names:
        return sql
    ctes = ",\n".join(f"{n} as ({fixture_text(n, ts_prefix)})" for n in names)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


class Fixtures:
    """Lazy fixture DataFrames over one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}
        register_tables(spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            for dep in referenced_fixtures(FIXTURE_SQL[name]):
                if dep != name and dep not in self._cache:
                    self[dep]
            for dep, df in self._cache.items():
                df.createOrReplaceTempView(dep)
            self._cache[name] = self.spark.sql(fixture_text(name, SPARK_TS))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return self[name]
        raise AttributeError(name)

# Distinct ``ts_ms`` values of ``fx_orders_cdc`` in time order (one landing
# file per wave in the streaming SCD2 check).
CDC_WAVES = (1000, 2000, 2500, 3000, 4000, 5000)
