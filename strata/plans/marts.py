"""The five business marts as pure DataFrame -> DataFrame functions.

No I/O and no wall clock: ``as_of_date`` and ``sla_days`` are arguments.
Money columns are integer cents and become doubles only at the output.

Scale notes (per mart): every aggregate is a ``groupBy`` whose partial
(map-side) aggregation collapses hot keys before the shuffle; joins are
equi-joins left to Catalyst/AQE, which broadcasts a side only after measuring
it; dimension joins come after aggregation where the semantics allow.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import allocate_pro_rata, cents_to_double, ratio_half_up, to_cents
from ..functions.predicates import current_rows
from ..operators.dedup import latest_per_key
from ..operators.skew import frequent_keys, join_heavy

# Profile columns carried into customer_360; an input without one is an error.
CUSTOMER_PROFILE = ("first_name", "last_name", "email", "loyalty_tier", "city", "state",
                    "country", "registration_date")


def orders_in_cents(orders: DataFrame) -> DataFrame:
    """Silver orders (currency amounts as doubles) with the cents that the
    marts add up, rounded half-up once."""
    return orders.withColumns({"total_cents": to_cents("total_amount"), "discount_cents": to_cents("discount_amount")})


def items_in_cents(items: DataFrame) -> DataFrame:
    """Silver order items with ``line_cents``."""
    return items.withColumn("line_cents", to_cents("line_total"))


def customer_360(customers: DataFrame, orders: DataFrame, as_of_date: _dt.date,
                 amount_cents: str = "total_cents",
                 profile_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per current customer with lifetime order aggregates.

    Both inputs are SCD2 tables and are cut to their open version.  Customers
    without current orders are kept with NULL aggregates.
    """
    profile = list(CUSTOMER_PROFILE if profile_cols is None else profile_cols)
    per_customer = (
        current_rows(orders)
        .groupBy("customer_id")
        .agg(F.sum(amount_cents).alias("_value_cents"),
             F.count("order_id").alias("order_count"),
             F.max("order_date").alias("last_order_date")))
    return (
        current_rows(customers).select("customer_id", *profile)
        .join(per_customer, "customer_id", "left")
        .select("customer_id", *profile,
                cents_to_double("_value_cents").alias("lifetime_value"),
                "order_count", "last_order_date",
                F.datediff(F.lit(as_of_date), F.col("last_order_date"))
                .cast("bigint").alias("days_since_last_order")))


def order_subtotals(items: DataFrame, line_cents: str = "line_cents") -> DataFrame:
    """Per order: sum of line amounts in cents (all items of the order)."""
    return items.groupBy("order_id").agg(F.sum(line_cents).alias("subtotal_cents"))


def discount_allocation(orders: DataFrame, items: DataFrame,
                        line_cents: str = "line_cents",
                        discount_cents: str = "discount_cents",
                        lines: DataFrame | None = None, marks: bool = False) -> DataFrame:
    """Items of current orders with their pro-rata share of the order discount.

    ``allocated_cents = half_up(line * discount / subtotal)``; 0 when the
    subtotal is not positive.  The subtotal covers every item of the order.

    Items meet one row an order, the order with its subtotal, in one join; the
    items of an order that holds a large part of all items are dealt over many
    tasks there (``operators.skew``), and its subtotal is summed up partially
    before the shuffle.  With ``lines``, these get their share instead of the
    items, which the subtotal covers all the same; ``marks`` are ``join_heavy``'s.
    """
    cur = current_rows(orders).drop("valid_from", "valid_to")
    per_order = order_subtotals(items, line_cents).join(cur, "order_id")
    return (
        join_heavy(items if lines is None else lines, per_order, ["order_id"], frequent_keys(items, "order_id"), marks=marks)
        .withColumn("allocated_cents",
                    allocate_pro_rata(line_cents, "subtotal_cents", discount_cents)))


def revenue_lines(orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame,
                  line_cents: str, discount_cents: str, city_col: str) -> DataFrame:
    """Order lines of known products and categories with their group and discount share.

    The categories join the products and these the items, of which few columns
    are left, before the items meet their orders: what is shuffled by product
    is narrow, and an order's lines stay where they are (``join_heavy``'s marks)."""
    goods = (products.select("product_id", "category_id")
             .join(categories.select("category_id", "category_name"), "category_id"))
    known = items.select("order_id", "product_id", "quantity", line_cents).join(goods, "product_id")
    alloc = discount_allocation(orders, items, line_cents, discount_cents, known, marks=True)
    return alloc.select(F.to_date("order_date").alias("order_date"), "order_id", "product_id", "quantity",
                        F.col(line_cents).alias("_line"), "allocated_cents", "category_id", "category_name",
                        "shipping_country", "shipping_state", F.col(city_col).alias("shipping_city"), "_salt", "_heavy")


def daily_revenue(orders: DataFrame, items: DataFrame, products: DataFrame,
                  categories: DataFrame, line_cents: str = "line_cents",
                  discount_cents: str = "discount_cents",
                  city_col: str = "shipping_city") -> DataFrame:
    """Revenue per (order date, category, country, state, city).

    Items whose product or category is unknown drop out (inner joins) while
    still counting in their order's subtotal.  An order's lines are summed
    where they met their order, so each order is one row a group there and is
    counted without a shuffle of its own; those of the few orders that are
    dealt over several tasks are counted by their ids.
    """
    group = ["order_date", "category_id", "category_name", "shipping_country", "shipping_state", "shipping_city"]
    lines = revenue_lines(orders, items, products, categories, line_cents, discount_cents, city_col)
    return (
        lines.groupBy(*group, "order_id", "_salt", "_heavy")
        .agg(F.sum("_line").alias("_gross"), F.sum("allocated_cents").alias("_disc"), F.sum("quantity").alias("_units"))
        .groupBy(*group)
        .agg(F.sum("_gross").alias("_gross"), F.sum("_disc").alias("_disc"),
             (F.count_if(F.col("_heavy").isNull()) + F.size(F.collect_set(F.when(F.col("_heavy"), F.col("order_id")))))
             .alias("order_count"),
             F.sum("_units").cast("bigint").alias("total_units_sold"))
        .select(*group,
                cents_to_double("_gross").alias("gross_revenue"),
                cents_to_double("_disc").alias("total_discount"),
                cents_to_double("_gross - _disc").alias("net_revenue"),
                "order_count", "total_units_sold"))


def fulfillment_health(orders: DataFrame, sla_days: int = 5,
                       region_col: str = "shipping_state") -> DataFrame:
    """Per (order date, region): delivered orders, within-SLA count and rate."""
    delivered = (
        current_rows(orders)
        .filter(F.col("order_status") == "delivered")
        .withColumn("_days", F.datediff(F.to_date("updated_at"), F.to_date("order_date"))))
    return (
        delivered.groupBy(F.to_date("order_date").alias("order_date"),
                          F.col(region_col).alias("region"))
        .agg(F.count("order_id").alias("delivered_orders"),
             F.count_if(F.col("_days") <= sla_days).alias("within_sla_orders"))
        .withColumn("sla_compliance_rate",
                    ratio_half_up("within_sla_orders", "delivered_orders", 4)))


def funnel_analysis(clickstream: DataFrame, purchase_event: str = "purchase",
                    default_referrer: str = "direct") -> DataFrame:
    """Sessions and converted sessions per referrer.

    A NULL referrer counts as ``direct``.  A session seen with two referrers
    counts once under each; a NULL session is not counted in
    ``total_sessions`` but may add to ``converted_sessions``.
    """
    per_session = (
        clickstream
        .withColumn("referrer", F.coalesce("referrer", F.lit(default_referrer)))
        .groupBy("session_id", "referrer")
        .agg(F.max(F.when(F.col("event_type") == purchase_event, 1).otherwise(0))
             .alias("converted")))
    return (
        per_session.groupBy("referrer")
        .agg(F.count("session_id").alias("total_sessions"),
             F.sum("converted").cast("bigint").alias("converted_sessions"))
        .withColumn("conversion_rate_percentage",
                    ratio_half_up("100 * converted_sessions", "total_sessions", 2)))


def product_performance(items: DataFrame, inventory: DataFrame, products: DataFrame,
                        line_cents: str = "line_cents",
                        stock_order: Sequence[str] = ("snapshot_date",),
                        stockout_threshold: int = 20) -> DataFrame:
    """Units, revenue and current stock per product.

    Stock is the sum over warehouses of the latest snapshot per
    (product, warehouse); products without stock rows get 0.
    """
    sales = items.groupBy("product_id").agg(
        F.sum("quantity").cast("bigint").alias("units_sold"),
        F.sum(line_cents).alias("_revenue_cents"))
    latest = latest_per_key(inventory, ["product_id", "warehouse_id"], list(stock_order))
    stock = latest.groupBy("product_id").agg(
        F.sum("quantity_available").cast("bigint").alias("_stock"))
    return (
        products.select("product_id", "product_name", "brand")
        .join(sales, "product_id", "left")
        .join(stock, "product_id", "left")
        .select("product_id", "product_name", "brand", "units_sold",
                cents_to_double("_revenue_cents").alias("revenue"),
                F.coalesce("_stock", F.lit(0).cast("bigint")).alias("current_stock"))
        .withColumn("stockout_risk", F.col("current_stock") < stockout_threshold))
