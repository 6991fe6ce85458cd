"""Incremental maintenance of each mart from change images (C14 pattern).

Each function takes the mart's previous result, the *current* source
tables, and the old/new images of the rows that changed since; it returns
the next mart result, equal to a full recompute.  Only the affected keys'
inputs are read by the recompute (semi joins against the key set).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..functions.predicates import current_rows
from ..operators.incremental import affected_keys, replace_keys, scope
from ..session import written
from . import marts


def maintain_customer_360(prev: DataFrame, customers: DataFrame, orders: DataFrame,
                          customer_images: Sequence[DataFrame],
                          order_images: Sequence[DataFrame], as_of_date: _dt.date,
                          **kw) -> DataFrame:
    """Affected customers: profile changes and both images of order changes."""
    keys = affected_keys([*customer_images, *order_images], {"customer_id": "customer_id"})
    result = marts.customer_360(scope(customers, keys, ["customer_id"], prune=False),
                                scope(orders, keys, ["customer_id"], prune=False), as_of_date, **kw)
    return replace_keys(prev, result, keys, ["customer_id"])


def _order_dates(images: Sequence[DataFrame]) -> DataFrame:
    return affected_keys(images, {"order_date": F.to_date("order_date")})


def _scope_dates(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows whose order date is affected.  A DATE column is matched as is, so
    a table partitioned by ``order_date`` is pruned to the affected
    partitions at runtime (dynamic partition pruning); timestamps are cut to
    their date first."""
    if isinstance(df.schema["order_date"].dataType, DateType):
        return scope(df, dates, ["order_date"])
    return scope(df.withColumn("_d", F.to_date("order_date")),
                 dates.withColumnRenamed("order_date", "_d"), ["_d"]).drop("_d")


def daily_revenue_dates(orders: DataFrame, items: DataFrame, products: DataFrame,
                        order_images: Sequence[DataFrame] = (), item_images: Sequence[DataFrame] = (),
                        product_images: Sequence[DataFrame] = (),
                        category_images: Sequence[DataFrame] = ()) -> DataFrame:
    """Order dates whose revenue a change may affect: both images of changed
    orders; the current dates of orders whose items changed, or that hold an
    item of a product that changed or lies in a category that changed."""
    found = [_order_dates(order_images)] if order_images else []
    goods = [img.select("product_id") for img in product_images]
    if category_images:
        groups = affected_keys(category_images, {"category_id": "category_id"})
        goods.append(scope(products, groups, ["category_id"], prune=False).select("product_id"))
    touched = [img.select("order_id") for img in item_images]
    if goods:
        touched.append(scope(items, affected_keys(goods, {"product_id": "product_id"}), ["product_id"], prune=False).select("order_id"))
    if touched:
        hit = scope(current_rows(orders), affected_keys(touched, {"order_id": "order_id"}), ["order_id"], prune=False)
        found.append(hit.select(F.to_date("order_date").alias("order_date")))
    return reduce(DataFrame.unionByName, found).distinct()


def maintain_daily_revenue(prev: DataFrame, orders: DataFrame, items: DataFrame,
                           products: DataFrame, categories: DataFrame,
                           order_images: Sequence[DataFrame],
                           item_images: Sequence[DataFrame],
                           product_images: Sequence[DataFrame] = (),
                           category_images: Sequence[DataFrame] = (), dates: DataFrame | None = None,
                           **kw) -> DataFrame:
    """Affected dates from changes of any input (``daily_revenue_dates``;
    ``dates`` if the caller has them stored).
    Items are scoped through their orders so each recomputed order keeps its
    full subtotal, by plain equality: an item without an order adds nothing,
    and the others' subtotals need no further shuffle.  The dates are
    stored as files, whose size Spark knows: they are used several times, and
    where they are few, orders and mart meet them without a shuffle."""
    cur = current_rows(orders)
    if dates is None:
        dates = written(daily_revenue_dates(orders, items, products, order_images, item_images, product_images,
                                            category_images), "dates")
    scoped_orders = _scope_dates(cur, dates)
    scoped_items = items.join(scoped_orders.select("order_id"), "order_id", "left_semi")
    result = marts.daily_revenue(scoped_orders, scoped_items, products, categories, **kw)
    return replace_keys(prev, result, dates, ["order_date"])


def maintain_fulfillment_health(prev: DataFrame, orders: DataFrame,
                                order_images: Sequence[DataFrame], sla_days: int = 5,
                                **kw) -> DataFrame:
    """Affected dates from both images of changed orders."""
    dates = _order_dates(order_images)
    scoped = _scope_dates(orders, dates)
    result = marts.fulfillment_health(scoped, sla_days, **kw)
    return replace_keys(prev, result, dates, ["order_date"])


def maintain_funnel(prev: DataFrame, clickstream: DataFrame,
                    event_images: Sequence[DataFrame], default_referrer: str = "direct",
                    **kw) -> DataFrame:
    """Affected referrers (NULL counted as the default) from both images."""
    ref = F.coalesce(F.col("referrer"), F.lit(default_referrer))
    keys = affected_keys(event_images, {"_ref": ref})
    scoped = scope(clickstream.withColumn("_ref", ref), keys, ["_ref"], prune=False).drop("_ref")
    result = marts.funnel_analysis(scoped, default_referrer=default_referrer, **kw)
    return replace_keys(prev, result, keys.withColumnRenamed("_ref", "referrer"), ["referrer"])


def maintain_product_performance(prev: DataFrame, items: DataFrame, inventory: DataFrame,
                                 products: DataFrame, item_images: Sequence[DataFrame],
                                 inventory_images: Sequence[DataFrame] = (),
                                 product_images: Sequence[DataFrame] = (), **kw) -> DataFrame:
    """Affected products from order-item, inventory and product changes."""
    keys = affected_keys([*item_images, *inventory_images, *product_images],
                         {"product_id": "product_id"})
    result = marts.product_performance(scope(items, keys, ["product_id"], prune=False),
                                       scope(inventory, keys, ["product_id"], prune=False),
                                       scope(products, keys, ["product_id"], prune=False), **kw)
    return replace_keys(prev, result, keys, ["product_id"])
