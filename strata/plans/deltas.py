"""The five marts kept under signed changes, without reading base tables again.

Where ``plans.maintenance`` recomputes the affected keys from their base rows,
here old images subtract and new images add (``operators.delta``).  Each mart
has a state of exact integer counters, one function that makes it from base
tables, one that adds a batch of signed images, and one that shows it as the
mart.  Base tables are read only where a counter can't tell: for a maximum
whose last holder went, and for the lines of orders whose discount is dealt
anew.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import cents_to_double, ratio_half_up
from ..functions.predicates import current_rows
from ..operators.delta import add_counts, latest, present, total, touched_counts, touched_latest, weighted
from ..operators.incremental import WEIGHT, affected_keys, replace_keys, scope
from ..session import written
from . import marts

# ---------------------------------------------------- fulfillment health --
FULFILLMENT = ["n", "delivered_orders", "within_sla_orders"]


def fulfillment_state(orders: DataFrame, sla_days: int = 5, region_col: str = "shipping_state") -> DataFrame:
    """Counters a (date, region); of weighted orders, what they add."""
    orders = orders if WEIGHT in orders.columns else weighted(orders)
    rows = current_rows(orders).where(F.col("order_status") == "delivered")
    days = F.datediff(F.to_date("updated_at"), F.to_date("order_date"))
    return (rows.groupBy(F.to_date("order_date").alias("order_date"), F.col(region_col).alias("region"))
            .agg(F.sum(WEIGHT).alias("n"), present("order_id").alias("delivered_orders"),
                 present(F.coalesce(days <= sla_days, F.lit(False))).alias("within_sla_orders")))


def fulfillment_next(state: DataFrame, order_images: DataFrame, sla_days: int = 5, **kw) -> DataFrame:
    return add_counts(state, fulfillment_state(order_images, sla_days, **kw), ["order_date", "region"], FULFILLMENT, "n")


def fulfillment_view(state: DataFrame) -> DataFrame:
    return state.select("order_date", "region", "delivered_orders", "within_sla_orders",
                        ratio_half_up("within_sla_orders", "delivered_orders", 4).alias("sla_compliance_rate"))


# ---------------------------------------------------------------- funnel --
SESSION, FUNNEL = ["events", "purchases"], ["n", "total_sessions", "converted_sessions"]


def session_state(clicks: DataFrame, purchase_event: str = "purchase", default_referrer: str = "direct") -> DataFrame:
    """Events and purchases of each session under each referrer."""
    clicks = clicks if WEIGHT in clicks.columns else weighted(clicks)
    bought = F.coalesce(F.col("event_type") == purchase_event, F.lit(False))
    return (clicks.withColumn("referrer", F.coalesce("referrer", F.lit(default_referrer)))
            .groupBy("session_id", "referrer").agg(F.sum(WEIGHT).alias("events"), present(bought).alias("purchases")))


def _funnel_counts(sessions: DataFrame) -> DataFrame:
    """What sessions with counters before (``old_``) and after change of their referrers' counters."""
    def change(flag):
        return F.sum(flag("").cast("long") - flag("old_").cast("long"))
    here = lambda x: F.col(f"{x}events") > 0
    return sessions.groupBy("referrer").agg(
        change(here).alias("n"), change(lambda x: here(x) & F.col("session_id").isNotNull()).alias("total_sessions"),
        change(lambda x: here(x) & (F.col(f"{x}purchases") > 0)).alias("converted_sessions"))


def funnel_state(sessions: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    return _funnel_counts(sessions.withColumns({"old_events": zero, "old_purchases": zero}))


def funnel_next(sessions: DataFrame, state: DataFrame, click_images: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """(sessions that changed, with counters before and after; next referrer
    counters).  A session counts anew, or no more, when its events cross zero."""
    moved = touched_counts(sessions, session_state(click_images, **kw), ["session_id", "referrer"], SESSION)
    return moved, add_counts(state, _funnel_counts(moved), ["referrer"], FUNNEL, "n")


def funnel_view(state: DataFrame) -> DataFrame:
    return state.select("referrer", "total_sessions", "converted_sessions",
                        ratio_half_up("100 * converted_sessions", "total_sessions", 2)
                        .alias("conversion_rate_percentage"))


def replaced(state: DataFrame, moved: DataFrame, keys: Sequence[str], alive: str) -> DataFrame:
    """A side table after ``moved`` (its touched keys and their counters now)."""
    return replace_keys(state, moved.where(F.col(alive) > 0), moved.select(*keys), keys)


# --------------------------------------------------- product performance --
SALES = ["n", "units", "unit_rows", "cents", "cent_rows"]
STOCK_KEYS = ["product_id", "warehouse_id"]


def sales_state(items: DataFrame, line_cents: str = "line_cents") -> DataFrame:
    items = items if WEIGHT in items.columns else weighted(items)
    return items.groupBy("product_id").agg(
        F.sum(WEIGHT).alias("n"), total("quantity").alias("units"), present("quantity").alias("unit_rows"),
        total(line_cents).alias("cents"), present(line_cents).alias("cent_rows"))


def _stock_order(inventory: DataFrame, stock_order: Sequence[str]) -> list[str]:
    skip = {*STOCK_KEYS, *stock_order, WEIGHT}
    return [*stock_order, *[c for c in inventory.columns if c not in skip]]


def stock_state(inventory: DataFrame, stock_order: Sequence[str] = ("snapshot_date",)) -> DataFrame:
    """The latest snapshot of each product and warehouse, and how many rows hold it."""
    return latest(weighted(inventory), STOCK_KEYS, _stock_order(inventory, stock_order), whole=True)


def _performance(products: DataFrame, sales: DataFrame, stock: DataFrame, stockout_threshold: int) -> DataFrame:
    return (products.select("product_id", "product_name", "brand").join(sales.where("n > 0"), "product_id", "left")
            .join(stock, "product_id", "left")
            .select("product_id", "product_name", "brand", F.when(F.col("unit_rows") > 0, F.col("units")).alias("units_sold"),
                    F.when(F.col("cent_rows") > 0, cents_to_double("cents")).alias("revenue"),
                    F.coalesce("_stock", F.lit(0).cast("bigint")).alias("current_stock"))
            .withColumn("stockout_risk", F.col("current_stock") < stockout_threshold))


def product_performance_next(mart: DataFrame, sales: DataFrame, stock: DataFrame, products: DataFrame,
                             item_images: DataFrame, inventory_images: DataFrame, inventory_now: DataFrame,
                             product_images: Sequence[DataFrame] = (),
                             stock_order: Sequence[str] = ("snapshot_date",), stockout_threshold: int = 20
                             ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sales that changed, stock that changed, next mart).

    Items are not read again.  Inventory is, for a product and warehouse whose
    latest snapshot was removed."""
    moved = touched_counts(sales, sales_state(item_images), ["product_id"], SALES)
    shelves = touched_latest(stock, inventory_images, inventory_now, STOCK_KEYS, _stock_order(inventory_now, stock_order))
    keys = affected_keys([moved, shelves, *product_images], {"product_id": "product_id"})
    here = (scope(stock, keys, ["product_id"], prune=False).select(*STOCK_KEYS, "best", F.lit(1).alias("sign"))
            .unionByName(shelves.where("old_best is not null").select(*STOCK_KEYS, F.col("old_best").alias("best"), F.lit(-1).alias("sign")))
            .unionByName(shelves.select(*STOCK_KEYS, "best", F.lit(1).alias("sign"))))
    amounts = here.groupBy("product_id").agg(
        F.sum(F.col("best.quantity_available") * F.col("sign")).cast("bigint").alias("_stock"))
    now = (replaced(scope(sales, keys, ["product_id"], prune=False), moved.select("product_id", *SALES), ["product_id"], "n")
           .select("product_id", *SALES))
    result = _performance(scope(products, keys, ["product_id"], prune=False), now, amounts, stockout_threshold)
    return moved, shelves, replace_keys(mart, result, keys, ["product_id"])


# ----------------------------------------------------------- customer 360 --
BOUGHT = ["n", "cents", "cent_rows", "order_count"]


def bought_state(orders: DataFrame, amount_cents: str = "total_cents") -> DataFrame:
    """Counters of a customer's current orders."""
    orders = orders if WEIGHT in orders.columns else weighted(orders)
    return current_rows(orders).groupBy("customer_id").agg(
        F.sum(WEIGHT).alias("n"), total(amount_cents).alias("cents"), present(amount_cents).alias("cent_rows"),
        present("order_id").alias("order_count"))


def last_order_state(orders: DataFrame) -> DataFrame:
    """A customer's last order date, and how many current orders have it."""
    return latest(weighted(current_rows(orders).where("order_date is not null")), ["customer_id"], ["order_date"])


def customer_360_next(mart: DataFrame, bought: DataFrame, last: DataFrame, customers: DataFrame,
                      customer_images: Sequence[DataFrame], order_images: DataFrame, orders_now: DataFrame,
                      as_of_date: _dt.date, profile_cols: Sequence[str] | None = None
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counters that changed, last dates that changed, next mart).

    Orders are read again only for customers whose last order date lost its
    last order.  ``days_since_last_order`` is counted anew for every customer:
    it changes with the date, touched or not."""
    profile = list(marts.CUSTOMER_PROFILE if profile_cols is None else profile_cols)
    moved = touched_counts(bought, bought_state(order_images), ["customer_id"], BOUGHT)
    dates = touched_latest(last, current_rows(order_images).where("order_date is not null"),
                           current_rows(orders_now).where("order_date is not null"), ["customer_id"], ["order_date"])
    keys = affected_keys([moved, dates, *customer_images], {"customer_id": "customer_id"})
    on = ["customer_id"]
    now = replaced(scope(bought, keys, on, prune=False), moved.select(*on, *BOUGHT), on, "n")
    day = replaced(scope(last, keys, on, prune=False), dates.select(*on, "best", "held"), on, "held")
    result = (scope(current_rows(customers), keys, on, prune=False).select(*on, *profile)
              .join(now.where("n > 0"), on, "left").join(day, on, "left")
              .select(*on, *profile, F.when(F.col("cent_rows") > 0, cents_to_double("cents")).alias("lifetime_value"),
                      "order_count", F.col("best.order_date").alias("last_order_date"),
                      F.lit(None).cast("bigint").alias("days_since_last_order")))
    days = F.datediff(F.lit(as_of_date), F.col("last_order_date")).cast("bigint")
    return moved, dates, replace_keys(mart, result, keys, on).withColumn("days_since_last_order", days)


# ---------------------------------------------------------- daily revenue --
GROUP = ["order_date", "category_id", "category_name", "shipping_country", "shipping_state", "shipping_city"]
REVENUE = ["lines", "gross", "discount", "units", "unit_rows"]


def order_revenue(orders: DataFrame, items: DataFrame, products: DataFrame, categories: DataFrame,
                  line_cents: str = "line_cents", discount_cents: str = "discount_cents",
                  city_col: str = "shipping_city") -> DataFrame:
    """What each order adds to each group of daily revenue, with its lines
    there: the multiplicity that tells whether a group still has the order.

    Lines are summed where they met their order, and that is materialised;
    only the sums of the few orders that are dealt over several tasks are
    shuffled to be added up."""
    lines = marts.revenue_lines(orders, items, products, categories, line_cents, discount_cents, city_col)
    sums = written(lines.groupBy(*GROUP, "order_id", "_salt", "_heavy").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("_line").alias("gross"), F.sum("allocated_cents").alias("discount"),
        F.coalesce(F.sum("quantity").cast("long"), F.lit(0)).alias("units"), F.count("quantity").alias("unit_rows")),
        "order-revenue")
    dealt = sums.where("_heavy").groupBy(*GROUP, "order_id").agg(*[F.sum(c).alias(c) for c in REVENUE])
    return sums.where("_heavy is null").select(*dealt.columns).unionByName(dealt)


def revenue_state(per_order: DataFrame) -> DataFrame:
    """Counters a group; ``orders`` is the number of its orders."""
    sign = F.col(WEIGHT) if WEIGHT in per_order.columns else F.lit(1)
    return per_order.groupBy(*GROUP).agg(*[F.sum(F.col(c) * sign).alias(c) for c in REVENUE],
                                         F.sum(sign.cast("long")).alias("orders"))


def daily_revenue_next(state: DataFrame, per_order: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame,
                       categories: DataFrame, order_images: Sequence[DataFrame] = (),
                       item_images: Sequence[DataFrame] = (), product_images: Sequence[DataFrame] = (),
                       category_images: Sequence[DataFrame] = (), **kw) -> tuple[DataFrame, DataFrame]:
    """(what the affected orders add now, next group counters).

    Discounts are dealt over all lines of an order, so a changed order's old
    contributions are subtracted whole and its new ones computed from its
    lines; an order leaves a group's count when its last line there went, and
    joins it with its first.  Only affected orders' lines are read."""
    touched = [img.select("order_id") for img in (*order_images, *item_images)]
    goods = [img.select("product_id") for img in product_images]
    if category_images:
        groups = affected_keys(category_images, {"category_id": "category_id"})
        goods.append(scope(products, groups, ["category_id"], prune=False).select("product_id"))
    if goods:
        touched.append(scope(items, affected_keys(goods, {"product_id": "product_id"}), ["product_id"], prune=False).select("order_id"))
    keys = affected_keys(touched, {"order_id": "order_id"})
    old = scope(per_order, keys, ["order_id"], prune=False).withColumn(WEIGHT, F.lit(-1).cast("long"))
    now = order_revenue(scope(orders, keys, ["order_id"], prune=False), scope(items, keys, ["order_id"], prune=False), products, categories, **kw)
    signed = old.unionByName(now.withColumn(WEIGHT, F.lit(1).cast("long")))
    return now, add_counts(state, revenue_state(signed), GROUP, [*REVENUE, "orders"], "orders")


def daily_revenue_view(state: DataFrame) -> DataFrame:
    return state.select(
        *GROUP, cents_to_double("gross").alias("gross_revenue"), cents_to_double("discount").alias("total_discount"),
        cents_to_double("gross - discount").alias("net_revenue"), F.col("orders").alias("order_count"),
        F.when(F.col("unit_rows") > 0, F.col("units")).alias("total_units_sold"))
