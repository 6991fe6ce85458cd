"""Independent DuckDB SQL for each named query (same output column names).

Written from the operator *specifications*, not from the Spark code: plain
joins, ``row_number``/``lag``/``lead`` windows, ``EXCEPT ALL`` and integer
arithmetic (``//`` is DuckDB's integral division).  ``with_fixtures`` adds
the fixture views each text uses.
"""

from __future__ import annotations

from ..sources.fixtures import with_fixtures

OPEN = "timestamp '9999-12-31 00:00:00'"
CUR = f"valid_to >= {OPEN}"


def _customer_360(orders: str, customers: str = "fx_customers_scd2") -> str:
    return f"""
with o as (select customer_id, sum(total_cents) as c, count(order_id) as n, max(order_date) as last_d
           from {orders} where {CUR} group by customer_id)
select c.customer_id, c.first_name, c.last_name, c.email, c.loyalty_tier, c.city, c.state, c.country,
  c.registration_date,
  cast(o.c as double) / 100 as lifetime_value, o.n as order_count, o.last_d as last_order_date,
  cast(date_diff('day', o.last_d, date '2001-08-02') as bigint) as days_since_last_order
from {customers} c left join o on c.customer_id = o.customer_id
where c.{CUR}"""


def _daily_revenue(orders: str, items: str) -> str:
    return f"""
with cur as (select * from {orders} where {CUR}),
sub as (select order_id, sum(line_cents) as subtotal_cents from {items} group by order_id),
alloc as (
  select cast(o.order_date as date) as order_date, i.order_id, i.product_id, i.quantity,
    i.line_cents,
    case when s.subtotal_cents > 0
         then (2 * i.line_cents * coalesce(o.discount_cents, 0) + s.subtotal_cents)
              // (2 * s.subtotal_cents)
         else 0 end as allocated_cents,
    o.shipping_country, o.shipping_state, o.shipping_city
  from {items} i join sub s on i.order_id = s.order_id join cur o on i.order_id = o.order_id)
select a.order_date, p.category_id, c.category_name, a.shipping_country, a.shipping_state,
  a.shipping_city,
  cast(sum(a.line_cents) as double) / 100 as gross_revenue,
  cast(sum(a.allocated_cents) as double) / 100 as total_discount,
  cast(sum(a.line_cents) - sum(a.allocated_cents) as double) / 100 as net_revenue,
  count(distinct a.order_id) as order_count, cast(sum(a.quantity) as bigint) as total_units_sold
from alloc a join fx_products p on a.product_id = p.product_id
  join fx_categories c on p.category_id = c.category_id
group by a.order_date, p.category_id, c.category_name, a.shipping_country, a.shipping_state,
  a.shipping_city"""


def _fulfillment(orders: str) -> str:
    return f"""
with d as (
  select cast(order_date as date) as order_date, shipping_state as region,
    count(order_id) as delivered_orders,
    count(*) filter (where date_diff('day', cast(order_date as date), cast(updated_at as date)) <= 5)
      as within_sla_orders
  from {orders} where {CUR} and order_status = 'delivered'
  group by cast(order_date as date), shipping_state)
select order_date, region, delivered_orders, within_sla_orders,
  case when delivered_orders > 0
       then cast((2 * within_sla_orders * 10000 + delivered_orders) // (2 * delivered_orders)
                 as double) / 10000
       else 0.0 end as sla_compliance_rate
from d"""


def _funnel(clicks: str) -> str:
    return f"""
with s as (select session_id, coalesce(referrer, 'direct') as referrer,
             max(case when event_type = 'purchase' then 1 else 0 end) as converted
           from {clicks} group by session_id, coalesce(referrer, 'direct')),
r as (select referrer, count(session_id) as total_sessions,
        cast(sum(converted) as bigint) as converted_sessions from s group by referrer)
select referrer, total_sessions, converted_sessions,
  case when total_sessions > 0
       then cast((2 * (100 * converted_sessions) * 100 + total_sessions) // (2 * total_sessions)
                 as double) / 100
       else 0.0 end as conversion_rate_percentage
from r"""


def _product_performance(items: str, inventory: str = "fx_inventory") -> str:
    return f"""
with sales as (select product_id, cast(sum(quantity) as bigint) as units_sold,
                 sum(line_cents) as rc from {items} group by product_id),
inv as (select *, row_number() over (partition by product_id, warehouse_id
          order by snapshot_date desc nulls last, quantity_available desc nulls last,
                   l_orderkey desc nulls last, l_linenumber desc nulls last) as rn
        from {inventory}),
stock as (select product_id, cast(sum(quantity_available) as bigint) as st
          from inv where rn = 1 group by product_id)
select p.product_id, p.product_name, p.brand, s.units_sold,
  cast(s.rc as double) / 100 as revenue,
  coalesce(st.st, 0) as current_stock, coalesce(st.st, 0) < 20 as stockout_risk
from fx_products p left join sales s on p.product_id = s.product_id
  left join stock st on p.product_id = st.product_id"""


ITEM_PRED = ("coalesce((not (return_requested = true and return_reason is null))"
             " and (quantity is null or quantity > 0), false)")

ITEM_LATEST_ORDER = ("ts desc nulls last, product_id desc nulls last, "
                     "warehouse_id desc nulls last, quantity desc nulls last, "
                     "line_cents desc nulls last, return_requested desc nulls last, "
                     "return_reason desc nulls last")
ITEM_COLS = ("order_id, line_no, product_id, warehouse_id, quantity, line_cents, "
             "return_requested, return_reason, ts")


def _latest_items(where: str) -> str:
    return f"""(select {ITEM_COLS} from (
  select *, row_number() over (partition by order_id, line_no order by {ITEM_LATEST_ORDER}) as rn
  from fx_order_items where {where}) where rn = 1)"""


BASE_ITEMS = _latest_items("ts < timestamp '1998-01-01 00:00:00'")
BATCH_ITEMS = _latest_items("ts >= timestamp '1998-01-01 00:00:00'")

CDC_EV = "(select pk, op, cast(ts_ms as bigint) as ts_ms, st, cust from fx_orders_cdc)"
CDC_LATEST_ORDER = "ts_ms desc nulls last, op desc nulls last, st desc nulls last, cust desc nulls last"


def _cdc_latest(where: str) -> str:
    return f"""(select pk, op, ts_ms, st, cust from (
  select *, row_number() over (partition by pk order by {CDC_LATEST_ORDER}) as rn
  from {CDC_EV} e where {where}) where rn = 1)"""


CLASSIFIED = f"""(select b2.pk, b2.op, b2.ts_ms, b2.st, b2.cust,
  case when b2.op = 'd' then 'delete' when t.pk is null then 'new'
       when b2.st is distinct from t.st or b2.cust is distinct from t.cust then 'changed'
       else 'noop' end as action
from {_cdc_latest('ts_ms > 2000')} b2
  left join (select * from {_cdc_latest('ts_ms <= 2000')} x where op <> 'd') t on b2.pk = t.pk)"""


def _scd2_step(target: str, batch_where: str) -> str:
    """One SCD2 apply of the latest event per key of a batch onto ``target``."""
    return f"""(with tgt as (select * from {target}),
b as (select pk, op, epoch_ms(ts_ms) as ts, st, cust from {_cdc_latest(batch_where)} z),
j as (select b.*, t.valid_from as t_from, t.pk is not null as has_open,
        case when t.pk is not null and b.ts <= t.valid_from then 'late'
             when b.op = 'd' and t.pk is not null then 'delete'
             when b.op = 'd' then 'noop'
             when t.pk is null then 'new'
             when b.st is distinct from t.st or b.cust is distinct from t.cust then 'changed'
             else 'noop' end as action
      from b left join (select * from tgt where {CUR}) t on b.pk = t.pk),
retired as (select g.pk, g.st, g.cust, g.valid_from,
              case when r.pk is not null then r.ts else g.valid_to end as valid_to
            from tgt g left join (select * from j where action in ('delete', 'changed')) r
              on g.pk = r.pk and g.valid_from = r.t_from and g.{CUR}),
ins as (select pk, st, cust, ts as valid_from, {OPEN} as valid_to from j
        where action in ('new', 'changed')
          and not exists (select 1 from tgt where tgt.pk = j.pk and tgt.valid_from = j.ts))
select * from retired union all select * from ins)"""


EMPTY_SCD2 = (f"(select cast(null as bigint) as pk, cast(null as varchar) as st, "
              f"cast(null as bigint) as cust, cast(null as timestamp) as valid_from, "
              f"cast(null as timestamp) as valid_to where false)")
SCD2_TWO_BATCHES = _scd2_step(_scd2_step(EMPTY_SCD2, "ts_ms <= 2000"), "ts_ms > 2000")

CHANGELOG = f"""(with e as (select pk, op, epoch_ms(ts_ms) as ts, st, cust from (
    select *, row_number() over (partition by pk, ts_ms
              order by op desc nulls last, st desc nulls last, cust desc nulls last) as rn
    from {CDC_EV} x) y where rn = 1),
f as (select *, lag(op) over w as p_op, lag(st) over w as p_st, lag(cust) over w as p_cust,
        lag(pk) over w as p_pk
      from e window w as (partition by pk order by ts)),
k as (select *, (op <> 'd' and (p_pk is null or p_op = 'd' or st is distinct from p_st
                 or cust is distinct from p_cust)) as opens from f),
kk as (select *, lead(ts) over (partition by pk order by ts) as nxt from k
       where opens or op = 'd')
select pk, st, cust, ts as valid_from, coalesce(nxt, {OPEN}) as valid_to from kk where opens)"""

ORDER_CHANGES = """(select * from (select * from fx_orders_scd2 except all select * from fx_orders_scd2_after)
  union all select * from (select * from fx_orders_scd2_after except all select * from fx_orders_scd2))"""

BATCH_METRICS = f"""
with f as (select *, cast(year(ts) * 100 + month(ts) as bigint) as batch_id from fx_order_items),
l as (select * from (select *, row_number() over (partition by order_id, line_no, batch_id
        order by {ITEM_LATEST_ORDER}) as rn from f) where rn = 1),
p as (select batch_id,
        lag(batch_id) over w is not null as had_prev,
        (product_id is distinct from lag(product_id) over w
         or warehouse_id is distinct from lag(warehouse_id) over w
         or quantity is distinct from lag(quantity) over w
         or line_cents is distinct from lag(line_cents) over w
         or return_requested is distinct from lag(return_requested) over w
         or return_reason is distinct from lag(return_reason) over w) as differs
      from l window w as (partition by order_id, line_no order by batch_id))
select batch_id, count(*) filter (where not had_prev) as rows_inserted,
  count(*) filter (where had_prev and differs) as rows_updated,
  count(*) filter (where had_prev and not differs) as rows_unchanged
from p group by batch_id"""

# Each rule by source, as the condition that a good row meets.
BRONZE_RULES = {
    "orders": {"valid_order_id": "order_id is not null", "valid_customer_ref": "customer_id is not null",
               "valid_total_amount": "total_amount is null or total_amount >= 0"},
    "products": {"valid_product_id": "product_id is not null", "valid_sku": "sku is not null",
                 "valid_retail_price": "retail_price is null or retail_price > 0"},
    "order_items": {"valid_order_item_id": "order_item_id is not null", "valid_order_ref": "order_id is not null",
                    "valid_product_ref": "product_id is not null", "valid_quantity": "quantity is null or quantity > 0"},
    "customers": {"valid_customer_id": "customer_id is not null", "valid_email": "email is not null",
                  "valid_loyalty_tier": "loyalty_tier is null or loyalty_tier in ('bronze', 'silver', 'gold', 'platinum')"},
    "categories": {"valid_category_id": "category_id is not null", "valid_category_name": "category_name is not null"},
    "clickstream": {"valid_event_id": "event_id is not null", "valid_event_type": "event_type is not null",
                    "valid_event_timestamp": "event_timestamp is not null"},
    "inventory": {"valid_snapshot_id": "snapshot_id is not null", "valid_product_ref": "product_id is not null",
                  "valid_quantity_on_hand": "quantity_on_hand is null or quantity_on_hand >= 0"},
}
SILVER_RULES = {"return_has_reason": "not (return_requested = true and return_reason is null)",
                "line_total_matches": "abs(line_total - quantity * unit_price) < 0.01"}


def _violations(source: str, table: str, rules: dict[str, str]) -> list[str]:
    return [f"""select '{source}' as source, '{rule}' as rule,
  count(*) filter (where not coalesce({sql}, false)) as violations from {table}""" for rule, sql in rules.items()]


_RAW: dict[str, str] = {
    "customer_360": _customer_360("fx_orders_scd2"),
    "daily_revenue": _daily_revenue("fx_orders_scd2", "fx_order_items"),
    "fulfillment_health": _fulfillment("fx_orders_scd2"),
    "funnel_analysis": _funnel("fx_clickstream"),
    "product_performance": _product_performance("fx_order_items"),
    "order_subtotal": "select order_id, cast(sum(line_cents) as bigint) as subtotal_cents from fx_order_items "
                      "group by order_id",
    "discount_allocation": f"""
with sub as (select order_id, cast(sum(line_cents) as bigint) as subtotal_cents from fx_order_items group by order_id)
select i.order_id, i.line_no, i.product_id, i.line_cents, s.subtotal_cents, o.discount_cents,
  cast(case when s.subtotal_cents > 0
       then (2 * i.line_cents * coalesce(o.discount_cents, 0) + s.subtotal_cents)
            // (2 * s.subtotal_cents) else 0 end as bigint) as allocated_cents
from fx_order_items i join sub s on i.order_id = s.order_id
  join fx_orders_scd2 o on i.order_id = o.order_id and o.{CUR}""",
    "dq_valid_items": f"select * from fx_order_items where {ITEM_PRED}",
    "dq_quarantined_items": f"select * from fx_order_items where not {ITEM_PRED}",
    "dq_rule_violations": """
select 'return_has_reason' as rule, count(*) filter (where not coalesce(
    not (return_requested = true and return_reason is null), false)) as violations
from fx_order_items
union all
select 'valid_quantity', count(*) filter (where not coalesce(quantity is null or quantity > 0, false))
from fx_order_items""",
    "dq_bronze_rules": " union all ".join(
        [q for source, rules in BRONZE_RULES.items() for q in _violations(source, f"fx_dq_{source}", rules)]
        + _violations("silver_order_items", "fx_order_items_priced", SILVER_RULES)),
    "dq_failed_casts": """
select event_id, 'customer_id' as column_name, customer_id as raw_value from fx_clickstream_raw
where try_cast(customer_id as bigint) is null
union all select event_id, 'event_timestamp', event_timestamp from fx_clickstream_raw
where try_cast(event_timestamp as timestamp) is null""",
    "dq_null_violations": """
select 'order_id' as column_name, count(*) filter (where order_id is null) as null_count from fx_orders_scd2
union all select 'customer_id', count(*) filter (where customer_id is null) from fx_orders_scd2
union all select 'order_status', count(*) filter (where order_status is null) from fx_orders_scd2
union all select 'discount_cents', count(*) filter (where discount_cents is null) from fx_orders_scd2""",
    "dq_duplicate_keys": """
select order_id, line_no, count(*) as occurrences from fx_order_items
group by order_id, line_no having count(*) > 1""",
    "layer_counts": " union all ".join(
        f"select '{n}' as table_name, count(*) as row_count from {n}"
        for n in ["fx_customers_scd2", "fx_orders_scd2", "fx_order_items", "fx_products",
                  "fx_categories", "fx_inventory", "fx_clickstream", "fx_orders_cdc"]),
    "latest_order_item": f"select * from {_latest_items('true')} x",
    "latest_order_item_maxby": f"select * from {_latest_items('true')} x",
    "latest_inventory": """
select product_id, warehouse_id, snapshot_date, quantity_available, l_orderkey, l_linenumber
from (select *, row_number() over (partition by product_id, warehouse_id
        order by snapshot_date desc nulls last, quantity_available desc nulls last,
                 l_orderkey desc nulls last, l_linenumber desc nulls last) as rn
      from fx_inventory) where rn = 1""",
    "cdc_flatten": """
select pk as order_id, st as order_status, cust as customer_id, op,
  cast(ts_ms as bigint) as ts_ms, epoch_ms(cast(ts_ms as bigint)) as event_ts
from fx_orders_cdc""",
    "cdc_classify": f"select * from {CLASSIFIED} c",
    "cdc_changed": f"select pk, op, ts_ms, st, cust from {CLASSIFIED} c where action = 'changed'",
    "cdc_new": f"select pk, op, ts_ms, st, cust from {CLASSIFIED} c where action = 'new'",
    "cdc_noop": f"select pk, op, ts_ms, st, cust from {CLASSIFIED} c where action = 'noop'",
    "cdc_deletes": f"select pk, op, ts_ms, st, cust from {CLASSIFIED} c where action = 'delete'",
    "scd1_upsert": f"""
select * from {BASE_ITEMS} t where not exists (
  select 1 from {BATCH_ITEMS} s where s.order_id = t.order_id and s.line_no = t.line_no)
union all select * from {BATCH_ITEMS} s""",
    "scd1_upsert_bucketed": f"""
select * from {BASE_ITEMS} t where not exists (
  select 1 from {BATCH_ITEMS} s where s.order_id = t.order_id and s.line_no = t.line_no)
union all select * from {BATCH_ITEMS} s""",
    "scd1_upsert_changed_only": f"""
with t as {BASE_ITEMS}, s as {BATCH_ITEMS},
j as (select t.order_id as t_order_id, t.line_no as t_line_no, t.product_id as t_product_id,
        t.warehouse_id as t_warehouse_id, t.quantity as t_quantity, t.line_cents as t_line_cents,
        t.return_requested as t_return_requested, t.return_reason as t_return_reason, t.ts as t_ts,
        s.*, s.order_id is not null and (t.order_id is null
          or s.product_id is distinct from t.product_id
          or s.warehouse_id is distinct from t.warehouse_id
          or s.quantity is distinct from t.quantity or s.line_cents is distinct from t.line_cents
          or s.return_requested is distinct from t.return_requested
          or s.return_reason is distinct from t.return_reason) as take_s
      from t full outer join s on t.order_id = s.order_id and t.line_no = s.line_no)
select case when take_s then order_id else t_order_id end as order_id,
  case when take_s then line_no else t_line_no end as line_no,
  case when take_s then product_id else t_product_id end as product_id,
  case when take_s then warehouse_id else t_warehouse_id end as warehouse_id,
  case when take_s then quantity else t_quantity end as quantity,
  case when take_s then line_cents else t_line_cents end as line_cents,
  case when take_s then return_requested else t_return_requested end as return_requested,
  case when take_s then return_reason else t_return_reason end as return_reason,
  case when take_s then ts else t_ts end as ts
from j""",
    "scd1_merge_metrics": f"""
with t as {BASE_ITEMS}, s as {BATCH_ITEMS},
j as (select s.order_id is not null as s_here, t.order_id is not null as t_here,
        (s.product_id is distinct from t.product_id or s.warehouse_id is distinct from t.warehouse_id
         or s.quantity is distinct from t.quantity or s.line_cents is distinct from t.line_cents
         or s.return_requested is distinct from t.return_requested
         or s.return_reason is distinct from t.return_reason) as differs
      from s full outer join t on s.order_id = t.order_id and s.line_no = t.line_no)
select count(*) filter (where s_here and not t_here) as rows_inserted,
  count(*) filter (where s_here and t_here and differs) as rows_updated,
  count(*) filter (where s_here and t_here and not differs) as rows_unchanged,
  cast(0 as bigint) as rows_deleted,
  count(*) filter (where not s_here and t_here) as rows_copied
from j""",
    "scd1_action_counts": f"""
with t as {BASE_ITEMS}, s as {BATCH_ITEMS},
j as (select s.order_id is not null as s_here, t.order_id is not null as t_here,
        (s.product_id is distinct from t.product_id or s.warehouse_id is distinct from t.warehouse_id
         or s.quantity is distinct from t.quantity or s.line_cents is distinct from t.line_cents
         or s.return_requested is distinct from t.return_requested
         or s.return_reason is distinct from t.return_reason) as differs
      from s full outer join t on s.order_id = t.order_id and s.line_no = t.line_no)
select count(*) filter (where s_here and not t_here) as rows_inserted,
  count(*) filter (where s_here and t_here and differs) as rows_updated,
  count(*) filter (where s_here and t_here and not differs) as rows_unchanged,
  cast(0 as bigint) as rows_deleted,
  count(*) filter (where not s_here and t_here) as rows_copied
from j""",
    "scd1_batch_metrics": BATCH_METRICS,
    "topk_batches": f"select * from ({BATCH_METRICS}) m order by batch_id desc limit 10",
    "scd2_apply": f"""select pk, st, cust, valid_from,
  case when valid_to < {OPEN} then valid_to end as valid_to from {SCD2_TWO_BATCHES} s""",
    "scd2_late_after_delete": f"""select pk, st, cust, valid_from,
  case when valid_to < {OPEN} then valid_to end as valid_to from {SCD2_TWO_BATCHES} s""",
    "scd2_replay": f"""select pk, st, cust, valid_from,
  case when valid_to < {OPEN} then valid_to end as valid_to from {SCD2_TWO_BATCHES} s""",
    "scd2_from_changelog": f"""select pk, st, cust, valid_from,
  case when valid_to < {OPEN} then valid_to end as valid_to from {CHANGELOG} c""",
    "scd2_merge_history": f"""select pk, st, cust, valid_from,
  case when valid_to < {OPEN} then valid_to end as valid_to from {CHANGELOG} c""",
    "current_customers": f"""select * replace (cast(null as timestamp) as valid_to)
  from fx_customers_scd2 where {CUR}""",
    "append_conform_events": """select event_id, session_id, customer_id, event_type,
  event_timestamp, referrer from fx_clickstream""",
    "affected_keys": f"select distinct cast(order_date as date) as order_date from {ORDER_CHANGES} c",
    "scope_semi": f"""select * from fx_order_items where order_id in
  (select order_id from {ORDER_CHANGES} c)""",
    "replace_keys": "select * from fx_order_items_after",
    "incr_customer_360": _customer_360("fx_orders_scd2_after"),
    "incr_daily_revenue": _daily_revenue("fx_orders_scd2_after", "fx_order_items_after"),
    "incr_fulfillment_health": _fulfillment("fx_orders_scd2_after"),
    "incr_funnel": _funnel("fx_clickstream_after"),
    "incr_product_performance": _product_performance("fx_order_items_after"),
    "delta_fulfillment_health": _fulfillment("fx_orders_scd2_after"),
    "delta_funnel": _funnel("fx_clickstream_after"),
    "delta_product_performance": _product_performance("fx_order_items_after", "fx_inventory_after"),
    "delta_customer_360": _customer_360("fx_orders_scd2_after", "fx_customers_scd2_after"),
    "delta_daily_revenue": _daily_revenue("fx_orders_scd2_after", "fx_order_items_after"),
    "scd1_from_cdc": f"""
with t as (select pk, st, cust, ts_ms from {_cdc_latest('ts_ms <= 2000')} x where op <> 'd'),
s as (select * from {_cdc_latest('ts_ms > 2000')} y),
j as (select t.pk as t_pk, t.st as t_st, t.cust as t_cust, t.ts_ms as t_ts, s.*,
        s.pk is not null and s.op = 'd' as is_del,
        s.pk is not null and s.op <> 'd' and (t.pk is null or s.st is distinct from t.st
          or s.cust is distinct from t.cust) as take_s
      from t full outer join s on t.pk = s.pk)
select case when take_s then pk else t_pk end as pk, case when take_s then st else t_st end as st,
  case when take_s then cust else t_cust end as cust,
  case when take_s then ts_ms else t_ts end as ts_ms
from j where not is_del""",
    "incr_customer_360_profiles": _customer_360("fx_orders_scd2_after", "fx_customers_scd2_after"),
    "incr_product_performance_inventory": _product_performance("fx_order_items_after",
                                                               "fx_inventory_after"),
}


def oracle_sql() -> dict[str, str]:
    """Name -> self-contained DuckDB SQL (fixture views inlined as CTEs)."""
    return {name: with_fixtures(sql) for name, sql in _RAW.items()}
