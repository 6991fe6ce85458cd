"""Named queries over the driver's test tables, one per operator.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads the whole test
tables through the fixture views (``strata.sources.fixtures``).  The
matching DuckDB SQL lives in ``oracle_sql.py`` under the same name.
Column names are aliased identically on both sides.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conform import conform, failed_casts
from ..functions.predicates import current_rows, open_end_as_null
from ..operators import cdc, dedup, incremental, quality, scd
from ..session import checkpoint_root, scratch_dir
from ..sources.fixtures import Fixtures
from ..sources.schemas import SOURCES
from . import deltas, maintenance, marts

# Parameters of the named queries.
AS_OF_DATE = _dt.date(2001, 8, 2)
SLA_DAYS = 5
ITEM_KEYS = ["order_id", "line_no"]
ITEM_ORDER = ["ts"]
ITEM_TRACKED = ["product_id", "warehouse_id", "quantity", "line_cents", "return_requested",
                "return_reason"]
SALES_COLUMNS = ["product_id", "quantity", "line_cents"]     # of an order item, in product performance
REVENUE_ORDER_COLUMNS = ["order_id", "order_date", "discount_cents", "shipping_country", "shipping_state",
                         "shipping_city", "valid_to"]          # of an order, in daily revenue
REVENUE_ITEM_COLUMNS = ["order_id", *SALES_COLUMNS]
ITEM_BATCH_SPLIT = "1998-01-01 00:00:00"     # items feed: base before, batch after
CDC_BATCH_SPLIT = 2000                       # orders CDC log: batch 1 <= 2000 < batch 2
CDC_TRACKED = ["st", "cust"]
# Quality rules applied to the order-item fixture: the Silver order-item rule
# and the Bronze order-item quantity rule on the flattened row.
ITEM_RULES = {
    "return_has_reason": quality.SILVER_ORDER_ITEM_RULES["return_has_reason"],
    "valid_quantity": quality.RULES["order_items"]["valid_quantity"].replace("after.", ""),
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _fx(spark: SparkSession, sf_dir: str) -> Fixtures:
    # the queries' epoch-millis conversions are defined in UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return Fixtures(spark, sf_dir)


# ---------------------------------------------------------------- marts ----
@query
def customer_360(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return marts.customer_360(fx.fx_customers_scd2, fx.fx_orders_scd2, AS_OF_DATE)


@query
def daily_revenue(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return marts.daily_revenue(fx.fx_orders_scd2, fx.fx_order_items, fx.fx_products,
                               fx.fx_categories)


@query
def fulfillment_health(spark, sf_dir):
    return marts.fulfillment_health(_fx(spark, sf_dir).fx_orders_scd2, SLA_DAYS)


@query
def funnel_analysis(spark, sf_dir):
    return marts.funnel_analysis(_fx(spark, sf_dir).fx_clickstream)


@query
def product_performance(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return marts.product_performance(fx.fx_order_items, fx.fx_inventory, fx.fx_products)


@query
def order_subtotal(spark, sf_dir):
    return marts.order_subtotals(_fx(spark, sf_dir).fx_order_items)


@query
def discount_allocation(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return (marts.discount_allocation(fx.fx_orders_scd2, fx.fx_order_items)
            .select("order_id", "line_no", "product_id", "line_cents", "subtotal_cents",
                    "discount_cents", "allocated_cents"))


# -------------------------------------------------------------- quality ----
@query
def dq_valid_items(spark, sf_dir):
    return quality.split_by_rules(_fx(spark, sf_dir).fx_order_items, ITEM_RULES)[0]


@query
def dq_quarantined_items(spark, sf_dir):
    return quality.split_by_rules(_fx(spark, sf_dir).fx_order_items, ITEM_RULES)[1]


@query
def dq_rule_violations(spark, sf_dir):
    return quality.rule_violations(_fx(spark, sf_dir).fx_order_items, ITEM_RULES)


@query
def dq_null_violations(spark, sf_dir):
    return quality.null_violations(_fx(spark, sf_dir).fx_orders_scd2,
                                   ["order_id", "customer_id", "order_status", "discount_cents"])


@query
def dq_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(_fx(spark, sf_dir).fx_order_items, ITEM_KEYS)


@query
def layer_counts(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    names = ["fx_customers_scd2", "fx_orders_scd2", "fx_order_items", "fx_products",
             "fx_categories", "fx_inventory", "fx_clickstream", "fx_orders_cdc"]
    return quality.layer_counts({n: fx[n] for n in names})


@query
def dq_bronze_rules(spark, sf_dir):
    """Violations of every rule of the registry, Bronze by source and Silver."""
    fx = _fx(spark, sf_dir)
    out = []
    for source, rules in quality.RULES.items():
        rows = fx[f"fx_dq_{source}"]
        if SOURCES[source].fmt == "cdc":
            rows = rows.select(F.struct(*rows.columns).alias("after"))
        out.append(quality.rule_violations(rows, rules).withColumn("source", F.lit(source)))
    silver = quality.rule_violations(fx["fx_order_items_priced"], quality.SILVER_ORDER_ITEM_RULES)
    return reduce(DataFrame.unionByName, [*out, silver.withColumn("source", F.lit("silver_order_items"))])


@query
def dq_failed_casts(spark, sf_dir):
    """The raw text of every value that the Silver casts would lose."""
    raw = _fx(spark, sf_dir)["fx_clickstream_raw"]
    casts = {"event_id": "bigint", "customer_id": "bigint", "event_timestamp": "timestamp_ntz"}
    return raw.select("event_id", F.explode(failed_casts(casts)).alias("column_name", "raw_value"))


# ---------------------------------------------------------------- dedup ----
@query
def latest_order_item(spark, sf_dir):
    return dedup.latest_per_key(_fx(spark, sf_dir).fx_order_items, ITEM_KEYS, ITEM_ORDER,
                                method="window")


@query
def latest_order_item_maxby(spark, sf_dir):
    return dedup.latest_per_key(_fx(spark, sf_dir).fx_order_items, ITEM_KEYS, ITEM_ORDER,
                                method="agg")


@query
def latest_inventory(spark, sf_dir):
    return dedup.latest_per_key(_fx(spark, sf_dir).fx_inventory,
                                ["product_id", "warehouse_id"], ["snapshot_date"])


# ------------------------------------------------------------------ CDC ----
def orders_cdc_events(fx: Fixtures) -> DataFrame:
    """The orders CDC log with ``ts_ms`` as bigint."""
    return fx.fx_orders_cdc.withColumn("ts_ms", F.col("ts_ms").cast("bigint"))


def orders_cdc_envelope(fx: Fixtures) -> DataFrame:
    """The orders CDC log in envelope form ``{op, ts_ms, before, after}``:
    deletes carry ``after = NULL`` and only the key in ``before``."""
    ev = orders_cdc_events(fx)
    row = F.struct(F.col("pk").alias("order_id"), F.col("st").alias("order_status"),
                   F.col("cust").alias("customer_id"))
    key_only = F.struct(F.col("pk").alias("order_id"),
                        F.lit(None).cast("string").alias("order_status"),
                        F.lit(None).cast("bigint").alias("customer_id"))
    return ev.select("op", "ts_ms",
                     F.when(F.col("op") == cdc.OP_DELETE, key_only).alias("before"),
                     F.when(F.col("op") != cdc.OP_DELETE, row).alias("after"))


def _flat_out(df: DataFrame) -> DataFrame:
    return df.select("order_id", "order_status", "customer_id", "op", "ts_ms",
                     F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))


@query
def cdc_flatten(spark, sf_dir):
    return _flat_out(cdc.flatten_cdc(orders_cdc_envelope(_fx(spark, sf_dir)), "order_id"))


def _cdc_batches(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    ev = orders_cdc_events(fx)
    return (ev.filter(F.col("ts_ms") <= CDC_BATCH_SPLIT),
            ev.filter(F.col("ts_ms") > CDC_BATCH_SPLIT))


def _classified(spark, sf_dir) -> DataFrame:
    b1, b2 = _cdc_batches(_fx(spark, sf_dir))
    target_open = (dedup.latest_per_key(b1, ["pk"], ["ts_ms"])
                   .filter(F.col("op") != cdc.OP_DELETE))
    latest = dedup.latest_per_key(b2, ["pk"], ["ts_ms"])
    return cdc.classify_changes(latest, target_open, "pk", CDC_TRACKED)


@query
def cdc_classify(spark, sf_dir):
    return _classified(spark, sf_dir)


def _bucket(action: str) -> Query:
    def run(spark, sf_dir):
        return _classified(spark, sf_dir).filter(F.col("action") == action).drop("action")
    return run


for _name, _action in [("cdc_changed", "changed"), ("cdc_new", "new"), ("cdc_noop", "noop"),
                       ("cdc_deletes", "delete")]:
    QUERIES[_name] = _bucket(_action)


# ------------------------------------------------------------------ SCD ----
def _item_batches(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    items = fx.fx_order_items
    split = F.lit(ITEM_BATCH_SPLIT).cast("timestamp_ntz")
    base = dedup.latest_per_key(items.filter(F.col("ts") < split), ITEM_KEYS, ITEM_ORDER)
    batch = dedup.latest_per_key(items.filter(F.col("ts") >= split), ITEM_KEYS, ITEM_ORDER)
    return base, batch


@query
def scd1_upsert(spark, sf_dir):
    base, batch = _item_batches(_fx(spark, sf_dir))
    return scd.upsert(base, batch, ITEM_KEYS)


@query
def scd1_upsert_bucketed(spark, sf_dir):
    """The upsert into a table bucketed by the key."""
    base, batch = _item_batches(_fx(spark, sf_dir))
    path = scratch_dir(spark, "bucketed")
    name = "strata_" + path.rsplit("-", 1)[1]
    scd.save_bucketed(base, name, ITEM_KEYS, int(spark.conf.get("spark.sql.shuffle.partitions")), f"{path}/{name}")
    return scd.upsert(spark.table(name), batch, ITEM_KEYS)


@query
def scd1_upsert_changed_only(spark, sf_dir):
    base, batch = _item_batches(_fx(spark, sf_dir))
    return scd.upsert_changed_only(base, batch, ITEM_KEYS, ITEM_TRACKED)


@query
def scd1_merge_metrics(spark, sf_dir):
    base, batch = _item_batches(_fx(spark, sf_dir))
    return scd.merge_metrics(base, batch, ITEM_KEYS, ITEM_TRACKED)


@query
def scd1_action_counts(spark, sf_dir):
    """The same counts from the rows that the merge wrote, without a join of their own."""
    base, batch = _item_batches(_fx(spark, sf_dir))
    return scd.action_counts(scd.merge_actions(base, batch, ITEM_KEYS, ITEM_TRACKED))


def _batch_metrics(spark, sf_dir) -> DataFrame:
    items = _fx(spark, sf_dir).fx_order_items.withColumn(
        "batch_id", (F.year("ts") * 100 + F.month("ts")).cast("bigint"))
    return scd.change_metrics_by_batch(items, ITEM_KEYS, ITEM_TRACKED, "batch_id", ITEM_ORDER)


@query
def scd1_batch_metrics(spark, sf_dir):
    return _batch_metrics(spark, sf_dir)


@query
def topk_batches(spark, sf_dir):
    """The ten newest batches' metrics (a top-k report: the limit is the feature)."""
    return _batch_metrics(spark, sf_dir).orderBy(F.col("batch_id").desc()).limit(10)


def _scd2_rows(events: DataFrame) -> DataFrame:
    return events.select("pk", "st", "cust", "op",
                         F.timestamp_millis("ts_ms").cast("timestamp_ntz").alias("event_ts"))


def _empty_scd2(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "pk bigint, st string, cust bigint, valid_from timestamp_ntz, valid_to timestamp_ntz")


def _scd2_after_two_batches(spark, sf_dir, replay: bool = False, late: bool = False) -> DataFrame:
    checkpoint_root(spark)
    b1, b2 = _cdc_batches(_fx(spark, sf_dir))
    # each applied batch is materialised (as a published version would be);
    # checkpoint() cuts the lineage into the session's checkpoint dir
    state = scd.scd2_apply(_empty_scd2(spark), _scd2_rows(b1), "pk", CDC_TRACKED).checkpoint()
    state = scd.scd2_apply(state, _scd2_rows(b2), "pk", CDC_TRACKED)
    if replay:
        state = scd.scd2_apply(state.checkpoint(), _scd2_rows(b2), "pk", CDC_TRACKED)
    if late:        # an update of every deleted key, older than its delete
        state = state.checkpoint()
        ended = state.groupBy("pk").agg(F.max("valid_to").alias("ended")).where(
            F.col("ended") < F.lit("9999-12-31").cast("timestamp_ntz"))
        old = ended.select("pk", F.lit("late").alias("st"), F.lit(0).cast("bigint").alias("cust"),
                           F.lit("u").alias("op"),
                           (F.col("ended") - F.expr("interval 500 milliseconds")).alias("event_ts"))
        state = scd.scd2_apply(state, old, "pk", CDC_TRACKED)
    return open_end_as_null(state)


@query
def scd2_apply(spark, sf_dir):
    return _scd2_after_two_batches(spark, sf_dir)


@query
def scd2_replay(spark, sf_dir):
    """Applying the same batch twice equals applying it once."""
    return _scd2_after_two_batches(spark, sf_dir, replay=True)


@query
def scd2_late_after_delete(spark, sf_dir):
    """A late event after a delete opens nothing."""
    return _scd2_after_two_batches(spark, sf_dir, late=True)


@query
def scd2_from_changelog(spark, sf_dir):
    ev = _scd2_rows(orders_cdc_events(_fx(spark, sf_dir)))
    return open_end_as_null(scd.scd2_from_changelog(ev, "pk", CDC_TRACKED,
                                                    end_like="timestamp_ntz"))


@query
def scd2_merge_history(spark, sf_dir):
    """The whole log in two batches that each hold early and late events of
    the same keys, several per key: the history of the log in order."""
    checkpoint_root(spark)
    ev = _scd2_rows(orders_cdc_events(_fx(spark, sf_dir)))
    late = F.pmod(F.xxhash64("pk", "event_ts"), F.lit(2)) == 0
    first = scd.scd2_history(ev.where(~late), "pk", CDC_TRACKED, end_like="timestamp_ntz").checkpoint()
    return open_end_as_null(scd.versions(scd.scd2_merge(first, ev.where(late), "pk", CDC_TRACKED)))


@query
def current_customers(spark, sf_dir):
    return open_end_as_null(current_rows(_fx(spark, sf_dir).fx_customers_scd2))


# --------------------------------------------------------------- conform ----
@query
def append_conform_events(spark, sf_dir):
    """Bronze keeps every clickstream field as a string; Silver casts back."""
    clicks = _fx(spark, sf_dir).fx_clickstream
    bronze = clicks.select(*[F.col(c).cast("string").alias(c) for c in clicks.columns])
    return conform(bronze, {"event_id": "bigint", "customer_id": "bigint",
                            "event_timestamp": "timestamp_ntz"})


# ----------------------------------------------------------- incremental ----
def _order_changes(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    return incremental.changed_images(fx.fx_orders_scd2, fx.fx_orders_scd2_after)


@query
def affected_keys(spark, sf_dir):
    old, new = _order_changes(_fx(spark, sf_dir))
    return incremental.affected_keys([old, new], {"order_date": F.to_date("order_date")})


@query
def scope_semi(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    old, new = _order_changes(fx)
    keys = incremental.affected_keys([old, new], {"order_id": "order_id"})
    return incremental.scope(fx.fx_order_items, keys, ["order_id"])


@query
def replace_keys(spark, sf_dir):
    """Replace the items of changed orders by their new rows."""
    fx = _fx(spark, sf_dir)
    old, new = incremental.changed_images(fx.fx_order_items, fx.fx_order_items_after)
    keys = incremental.affected_keys([old, new], {"order_id": "order_id"})
    result = incremental.scope(fx.fx_order_items_after, keys, ["order_id"])
    return incremental.replace_keys(fx.fx_order_items, result, keys, ["order_id"])


@query
def incr_customer_360(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    prev = marts.customer_360(fx.fx_customers_scd2, fx.fx_orders_scd2, AS_OF_DATE)
    old, new = _order_changes(fx)
    return maintenance.maintain_customer_360(prev, fx.fx_customers_scd2,
                                             fx.fx_orders_scd2_after, [], [old, new], AS_OF_DATE)


@query
def incr_daily_revenue(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    prev = marts.daily_revenue(fx.fx_orders_scd2, fx.fx_order_items, fx.fx_products,
                               fx.fx_categories)
    orders = incremental.images_of(_signed(fx, "fx_orders_scd2", REVENUE_ORDER_COLUMNS))
    items = incremental.images_of(_signed(fx, "fx_order_items", REVENUE_ITEM_COLUMNS))
    return maintenance.maintain_daily_revenue(prev, fx.fx_orders_scd2_after,
                                              fx.fx_order_items_after, fx.fx_products,
                                              fx.fx_categories, orders, items)


@query
def incr_fulfillment_health(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    prev = marts.fulfillment_health(fx.fx_orders_scd2, SLA_DAYS)
    old, new = _order_changes(fx)
    return maintenance.maintain_fulfillment_health(prev, fx.fx_orders_scd2_after, [old, new],
                                                   SLA_DAYS)


@query
def incr_funnel(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    prev = marts.funnel_analysis(fx.fx_clickstream)
    old, new = incremental.changed_images(fx.fx_clickstream, fx.fx_clickstream_after)
    return maintenance.maintain_funnel(prev, fx.fx_clickstream_after, [old, new])


@query
def incr_product_performance(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    prev = marts.product_performance(fx.fx_order_items, fx.fx_inventory, fx.fx_products)
    old, new = incremental.changed_images(fx.fx_order_items, fx.fx_order_items_after)
    return maintenance.maintain_product_performance(prev, fx.fx_order_items_after,
                                                    fx.fx_inventory, fx.fx_products, [old, new])


@query
def incr_customer_360_profiles(spark, sf_dir):
    """Customer 360 maintained from profile changes *and* order changes."""
    fx = _fx(spark, sf_dir)
    prev = marts.customer_360(fx.fx_customers_scd2, fx.fx_orders_scd2, AS_OF_DATE)
    c_old, c_new = incremental.changed_images(fx.fx_customers_scd2, fx.fx_customers_scd2_after)
    o_old, o_new = _order_changes(fx)
    return maintenance.maintain_customer_360(prev, fx.fx_customers_scd2_after,
                                             fx.fx_orders_scd2_after, [c_old, c_new],
                                             [o_old, o_new], AS_OF_DATE)


@query
def incr_product_performance_inventory(spark, sf_dir):
    """Product performance maintained from order-item and inventory changes."""
    fx = _fx(spark, sf_dir)
    prev = marts.product_performance(fx.fx_order_items, fx.fx_inventory, fx.fx_products)
    i_old, i_new = incremental.changed_images(fx.fx_order_items, fx.fx_order_items_after)
    v_old, v_new = incremental.changed_images(fx.fx_inventory, fx.fx_inventory_after)
    return maintenance.maintain_product_performance(
        prev, fx.fx_order_items_after, fx.fx_inventory_after, fx.fx_products,
        [i_old, i_new], [v_old, v_new])


# -------------------------------------------------------- signed changes ----
def _kept(df: DataFrame) -> DataFrame:
    """A state or a change log as a job finds it: materialised."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def _signed(fx: Fixtures, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    return _kept(incremental.signed_images(fx[name], fx[f"{name}_after"], columns))


@query
def delta_fulfillment_health(spark, sf_dir):
    """Fulfillment health from its counters and signed order images alone."""
    fx = _fx(spark, sf_dir)
    state = _kept(deltas.fulfillment_state(fx.fx_orders_scd2, SLA_DAYS))
    return deltas.fulfillment_view(deltas.fulfillment_next(state, _signed(fx, "fx_orders_scd2"), SLA_DAYS))


@query
def delta_funnel(spark, sf_dir):
    """The funnel from session counters and signed clickstream images alone."""
    fx = _fx(spark, sf_dir)
    sessions = _kept(deltas.session_state(fx.fx_clickstream))
    return deltas.funnel_view(deltas.funnel_next(sessions, deltas.funnel_state(sessions), _signed(fx, "fx_clickstream"))[1])


@query
def delta_product_performance(spark, sf_dir):
    """Product performance from sales counters, latest snapshots and signed
    order-item and inventory images."""
    fx = _fx(spark, sf_dir)
    mart = _kept(marts.product_performance(fx.fx_order_items, fx.fx_inventory, fx.fx_products))
    return deltas.product_performance_next(
        mart, _kept(deltas.sales_state(fx.fx_order_items)), _kept(deltas.stock_state(fx.fx_inventory)), fx.fx_products,
        _signed(fx, "fx_order_items", SALES_COLUMNS), _signed(fx, "fx_inventory"), fx.fx_inventory_after)[2]


@query
def delta_customer_360(spark, sf_dir):
    """Customer 360 from order counters, last dates, and signed order and
    customer images."""
    fx = _fx(spark, sf_dir)
    mart = _kept(marts.customer_360(fx.fx_customers_scd2, fx.fx_orders_scd2, AS_OF_DATE))
    return deltas.customer_360_next(
        mart, _kept(deltas.bought_state(fx.fx_orders_scd2)), _kept(deltas.last_order_state(fx.fx_orders_scd2)),
        fx.fx_customers_scd2_after, [_signed(fx, "fx_customers_scd2")], _signed(fx, "fx_orders_scd2"),
        fx.fx_orders_scd2_after, AS_OF_DATE)[2]


@query
def delta_daily_revenue(spark, sf_dir):
    """Daily revenue from contributions per order: the affected orders' old
    ones subtracted, their new ones added."""
    fx = _fx(spark, sf_dir)
    per_order = deltas.order_revenue(fx.fx_orders_scd2, fx.fx_order_items, fx.fx_products, fx.fx_categories)
    return deltas.daily_revenue_view(deltas.daily_revenue_next(
        deltas.revenue_state(per_order), per_order, fx.fx_orders_scd2_after, fx.fx_order_items_after, fx.fx_products,
        fx.fx_categories, [_signed(fx, "fx_orders_scd2")], [_signed(fx, "fx_order_items", REVENUE_ITEM_COLUMNS)])[1])


@query
def scd1_from_cdc(spark, sf_dir):
    """Change-aware SCD1 from a CDC batch -- rows rewritten only when a
    tracked column changed, deletes remove their key (H1)."""
    b1, b2 = _cdc_batches(_fx(spark, sf_dir))
    target = (dedup.latest_per_key(b1, ["pk"], ["ts_ms"])
              .filter(F.col("op") != cdc.OP_DELETE).select("pk", "st", "cust", "ts_ms"))
    source = dedup.latest_per_key(b2, ["pk"], ["ts_ms"])
    return scd.upsert_changed_only(target, source, ["pk"], CDC_TRACKED, op_col="op")
