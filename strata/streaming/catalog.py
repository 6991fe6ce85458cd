"""Streaming named queries: real bounded streams over landed test data.

Each query lands data derived from the test tables as files in a fresh
folder under the session's checkpoint root, runs the streaming job(s) with
``availableNow`` and returns the published result read back.  The oracle is
the batch result of the same operator.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.predicates import is_current, open_end_as_null
from ..operators import dedup, incremental, quality
from ..operators.cdc import OP_DELETE, flatten_cdc
from ..operators.scd import versions
from ..plans import catalog as batch_catalog
from ..plans import maintenance, marts
from ..plans.oracle_sql import _RAW as BATCH_SQL
from ..plans.oracle_sql import ITEM_PRED
from ..plans.oracle_sql import _daily_revenue as daily_revenue_sql
from ..session import scratch_dir, written
from ..sources.fixtures import CDC_WAVES, PRICED, Fixtures, with_fixtures
from ..sources.schemas import SOURCES
from . import jobs
from .drivers import cdc_stream, file_stream
from .tables import KeyedTable

STREAM_QUERIES: dict = {}


def _q(fn):
    STREAM_QUERIES[fn.__name__] = fn
    return fn


def _work(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, name)


PRODUCT_CSV_SCHEMA = StructType([
    StructField("product_id", LongType()), StructField("product_name", StringType()),
    StructField("brand", StringType()), StructField("category_id", StringType()),
    StructField("retail_cents", LongType())])
ORDER_ROW_SCHEMA = StructType([
    StructField("order_id", LongType()), StructField("order_status", StringType()),
    StructField("customer_id", LongType())])


# The feeds land as FILES files, PER_BATCH of which make a micro-batch; tables
# are cut into BUCKETS partitions.  Sizes of the test tables: a larger feed lands
# in files, and its table and the marts made of it are cut into buckets, of
# PART_ROWS rows (some 100 MB), of a registered source's wide ones WIDE_ROWS.
FILES, PER_BATCH, BUCKETS, PART_ROWS = 8, 3, 16, 1_000_000
WIDE_ROWS = PART_ROWS // 4


def _buckets(rows: int, most: int | None = None) -> int:
    """Buckets of a table that is fed so many rows, ``most`` (PART_ROWS) in each."""
    return max(BUCKETS, math.ceil(rows / (most or PART_ROWS)))


@_q
def stream_ingest_csv(spark, sf_dir):
    """Products landed as CSV files, ingested to Bronze in two batches."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "ingest-csv")
    fx.fx_products.repartition(4).write.option("header", True).csv(f"{work}/landing")
    jobs.ingest_files(spark, "csv", PRODUCT_CSV_SCHEMA, f"{work}/landing", f"{work}/bronze",
                      f"{work}/_checkpoints/bronze", max_files_per_trigger=2)
    return spark.read.parquet(f"{work}/bronze").drop(*jobs.LINEAGE_COLS)


def _land_envelopes(fx: Fixtures, path: str) -> None:
    batch_catalog.orders_cdc_envelope(fx).repartition(FILES).write.json(path)


@_q
def stream_ingest_cdc_json(spark, sf_dir):
    """Orders CDC envelopes landed as JSON, ingested, then flattened."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "ingest-cdc")
    _land_envelopes(fx, f"{work}/landing")
    jobs.ingest_cdc(spark, ORDER_ROW_SCHEMA, f"{work}/landing", f"{work}/bronze",
                    f"{work}/_checkpoints/bronze", max_files_per_trigger=2)
    bronze = spark.read.parquet(f"{work}/bronze")
    return batch_catalog._flat_out(flatten_cdc(bronze, "order_id"))


def _land_files(df: DataFrame, path: str, files: int) -> tuple[int, int]:
    """Lands the rows in ``files`` Parquet files or more, none of above
    ``PART_ROWS`` rows, each by the task that reads them: (rows, files)."""
    rows = df.count()
    most = max(1, min(math.ceil(rows / files), PART_ROWS))
    df.write.option("maxRecordsPerFile", most).option("compression", "zstd").parquet(path)
    return rows, len(df.sparkSession.read.schema(df.schema).parquet(path).inputFiles())


def _share(landed: int, per: int, files: int) -> int:
    """``per`` of ``files`` files, of the number that did land."""
    return max(1, math.ceil(landed * per / files))


@_q
def stream_dq_split(spark, sf_dir):
    """Order items streamed through the valid / quarantine split."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "dq-split")
    landed = _land_files(fx.fx_order_items, f"{work}/landing", 4)[1]
    src = file_stream(spark, "parquet", fx.fx_order_items.schema, f"{work}/landing",
                      max_files_per_trigger=_share(landed, 1, 4))
    jobs.dq_split(src, batch_catalog.ITEM_RULES, f"{work}/valid", f"{work}/quarantine",
                  f"{work}/_checkpoints/dq")
    drop = [*jobs.LINEAGE_COLS, "_query_id", "_batch_id"]
    valid = spark.read.parquet(f"{work}/valid").drop(*drop).withColumn("is_valid", F.lit(True))
    bad = spark.read.parquet(f"{work}/quarantine").drop(*drop).withColumn("is_valid", F.lit(False))
    return valid.unionByName(bad)


@_q
def stream_scd1(spark, sf_dir):
    """C4: the order-item update feed streamed into an SCD1 table."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "scd1")
    schema = fx.fx_order_items.schema
    rows, landed = _land_files(fx.fx_order_items, f"{work}/landing", FILES)
    src = file_stream(spark, "parquet", schema, f"{work}/landing", _share(landed, PER_BATCH, FILES), lineage=False)
    table = KeyedTable(spark, f"{work}/silver_order_items", schema, batch_catalog.ITEM_KEYS, _buckets(rows))
    jobs.scd1_stream(src, table, batch_catalog.ITEM_ORDER, f"{work}/_checkpoints/scd1")
    return table.read()


@_q
def stream_silver_quarantine(spark, sf_dir):
    """An SCD1 table of order items, and its clean and quarantined halves
    by the Silver rules, maintained from its change images."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "silver-dq")
    schema = fx["fx_order_items_priced"].schema
    rows, landed = _land_files(fx["fx_order_items_priced"], f"{work}/landing", FILES)
    silver, clean, bad = (KeyedTable(spark, f"{work}/{n}", schema, batch_catalog.ITEM_KEYS, _buckets(rows),
                                     changes=f"{work}/changes" if n == "silver" else None)
                          for n in ("silver", "clean", "quarantined"))
    src = file_stream(spark, "parquet", schema, f"{work}/landing", _share(landed, PER_BATCH, FILES), lineage=False)
    jobs.scd1_stream(src, silver, batch_catalog.ITEM_ORDER, f"{work}/_checkpoints/scd1")
    jobs.quarantine_stream(_images(spark, silver), silver, quality.SILVER_ORDER_ITEM_RULES, clean, bad,
                           f"{work}/_checkpoints/dq")
    return (clean.read().withColumn("is_valid", F.lit(True))
            .unionByName(bad.read().withColumn("is_valid", F.lit(False))))


def _images(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """Stream of the change images that a table has logged."""
    schema = StructType([*table.schema.fields, StructField(incremental.WEIGHT, LongType())])
    return file_stream(spark, "parquet", schema, table.changes, lineage=False)


def _scd2_out(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("order_id").alias("pk"), F.col("order_status").alias("st"),
                       F.col("customer_id").alias("cust"),
                       F.col("valid_from").cast("timestamp_ntz").alias("valid_from"),
                       F.col("valid_to").cast("timestamp_ntz").alias("valid_to"))


@_q
def stream_scd2(spark, sf_dir):
    """The orders CDC log landed in files of no order, so that batches hold
    several events of a key and late ones, kept as SCD2 history."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "scd2")
    _land_envelopes(fx, f"{work}/landing")
    src = flatten_cdc(cdc_stream(spark, ORDER_ROW_SCHEMA, f"{work}/landing", PER_BATCH), "order_id")
    tracked = ["order_status", "customer_id"]
    table = KeyedTable(spark, f"{work}/silver_orders_scd2", jobs.history_schema(src.schema, "order_id", tracked),
                       ["order_id"], BUCKETS)
    jobs.scd2_stream(src, table, "order_id", tracked, f"{work}/_checkpoints/scd2")
    return _scd2_out(open_end_as_null(versions(table.read())))


@_q
def stream_scd1_cdc(spark, sf_dir):
    """The orders CDC log kept as a change-aware SCD1 table (no-op updates
    keep the row, deletes remove the key).  A removed key has no row that a
    later batch's older event could be compared with, so the log lands wave by
    wave, and the one stream runs after each."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "scd1-cdc")
    cols = ["order_id", "order_status", "customer_id", "ts_ms"]
    schema = StructType([*ORDER_ROW_SCHEMA.fields, StructField("ts_ms", LongType())])
    table = KeyedTable(spark, f"{work}/silver_orders_scd1", schema, ["order_id"], BUCKETS)
    env = batch_catalog.orders_cdc_envelope(fx)
    for wave in CDC_WAVES:
        env.filter(F.col("ts_ms") == wave).write.mode("append").json(f"{work}/landing")
        src = flatten_cdc(cdc_stream(spark, ORDER_ROW_SCHEMA, f"{work}/landing"), "order_id").select(*cols, "op")
        jobs.scd1_stream(src, table, ["ts_ms", "op"], f"{work}/_checkpoints/scd1",
                         tracked=["order_status", "customer_id"], op_col="op")
    return table.read().select(F.col("order_id").alias("pk"), F.col("order_status").alias("st"),
                               F.col("customer_id").alias("cust"), "ts_ms")


@_q
def stream_append_conform(spark, sf_dir):
    """Clickstream landed as JSON with every field a string (Bronze),
    streamed through the Silver conform casts and appended."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "conform")
    clicks = fx.fx_clickstream
    clicks.select(*[F.col(c).cast("string").alias(c) for c in clicks.columns]) \
        .repartition(3).write.json(f"{work}/landing")
    bronze = StructType([StructField(c, StringType()) for c in clicks.columns])
    src = file_stream(spark, "json", bronze, f"{work}/landing", max_files_per_trigger=1)
    jobs.append_conform(src, {"event_id": "bigint", "customer_id": "bigint",
                              "event_timestamp": "timestamp_ntz"},
                        f"{work}/silver", f"{work}/_checkpoints/silver")
    return spark.read.parquet(f"{work}/silver").drop(*jobs.LINEAGE_COLS)


# Declared constraints of the fulfillment mart (NOT NULL key columns, PK).
FULFILLMENT_CONSTRAINTS = {"not_null": ["order_date", "region"],
                           "primary_key": ["order_date", "region"]}


def _touched_dates(images: DataFrame) -> DataFrame:
    """Mart keys (order dates) touched by a batch of order change images."""
    return incremental.affected_keys([images], {"order_date": F.to_date("order_date")})


def _touched(column: str):
    return lambda images: images.select(column).distinct()


def _mart(spark: SparkSession, path: str, rows: DataFrame, key: str, buckets: int = BUCKETS, **options) -> KeyedTable:
    """A mart table by its key that begins with ``rows``."""
    table = KeyedTable(spark, path, rows.schema, [key], buckets, **options)
    table.create(rows)
    return table


def _changes(spark: SparkSession, path: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Stream of the change images between two snapshots, landed as files."""
    images = incremental.signed_images(before, after)
    images.repartition(2).write.parquet(path)
    return file_stream(spark, "parquet", images.schema, path, 1, lineage=False)


@_q
def stream_mart(spark, sf_dir):
    """C14: fulfillment health maintained from a stream of order change images."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "mart")
    mart = _mart(spark, f"{work}/gold_fulfillment_health",
                 marts.fulfillment_health(fx.fx_orders_scd2, batch_catalog.SLA_DAYS), "order_date",
                 **FULFILLMENT_CONSTRAINTS)
    changes = _changes(spark, f"{work}/changes", fx.fx_orders_scd2, fx.fx_orders_scd2_after)
    orders_now = fx.fx_orders_scd2_after

    def maintain(prev: DataFrame, images: DataFrame) -> DataFrame:
        return maintenance.maintain_fulfillment_health(prev, orders_now, [images], batch_catalog.SLA_DAYS)
    jobs.mart_stream(changes, mart, maintain, f"{work}/_checkpoints/mart", _touched_dates)
    return mart.read()


@_q
def stream_mart_two_sources(spark, sf_dir):
    """One mart (product performance) maintained by two change streams --
    order-item changes, then inventory changes -- run one after the other."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "mart2")
    mart = _mart(spark, f"{work}/gold_product_performance",
                 marts.product_performance(fx.fx_order_items, fx.fx_inventory, fx.fx_products), "product_id")
    items_now, inventory_now = fx.fx_order_items_after, fx.fx_inventory_after
    feeds = {
        "items": (fx.fx_order_items, items_now,
                  lambda prev, img: maintenance.maintain_product_performance(
                      prev, items_now, inventory_now, fx.fx_products, [img])),
        "inventory": (fx.fx_inventory, inventory_now,
                      lambda prev, img: maintenance.maintain_product_performance(
                          prev, items_now, inventory_now, fx.fx_products, [],
                          inventory_images=[img])),
    }
    for name, (before, after, maintain) in feeds.items():
        changes = _changes(spark, f"{work}/changes_{name}", before, after)
        jobs.mart_stream(changes, mart, maintain, f"{work}/_checkpoints/{name}", _touched("product_id"))
    return mart.read()


@_q
def stream_silver_to_gold(spark, sf_dir):
    """H5 end to end: a Silver orders table fed by an order stream logs the
    old/new images of every batch; the Gold fulfillment mart is maintained by
    a second stream that reads only that change log."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "silver-gold")
    orders, after = fx.fx_orders_scd2, fx.fx_orders_scd2_after
    # two landing drops, each written in parallel: every order, then the new
    # image of the changed orders; the Silver stream runs after each
    silver = KeyedTable(spark, f"{work}/silver_orders", orders.schema, ["order_id"], BUCKETS,
                        changes=f"{work}/silver_orders_changes")
    for drop in (orders, incremental.changed_images(orders, after)[1]):
        drop.write.mode("append").parquet(f"{work}/landing")
        src = file_stream(spark, "parquet", orders.schema, f"{work}/landing", lineage=False)
        jobs.scd1_stream(src, silver, ["updated_at"], f"{work}/_checkpoints/silver",
                         tracked=[c for c in orders.columns if c != "order_id"])
    gold = _mart(spark, f"{work}/gold_fulfillment_health",
                 marts.fulfillment_health(orders.limit(0), batch_catalog.SLA_DAYS), "order_date",
                 **FULFILLMENT_CONSTRAINTS)

    def maintain(prev: DataFrame, images: DataFrame) -> DataFrame:
        return maintenance.maintain_fulfillment_health(prev, silver.read(), [images], batch_catalog.SLA_DAYS)
    jobs.mart_stream(_images(spark, silver), gold, maintain, f"{work}/_checkpoints/gold", _touched_dates)
    return gold.read()


# ------------------------------------------ registered feeds to the marts --
def _land(rows: DataFrame, name: str, path: str) -> None:
    """Rows (op, ts_ms and some of a registered source's columns) landed as
    the source lands them: envelopes of all its columns, deletes by key."""
    spec = SOURCES[name]
    have = {c.lower() for c in rows.columns}
    row = F.struct(*[(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                     for f in spec.schema.fields])
    key = F.struct(F.col(spec.key).cast("string").alias(spec.key))
    gone = F.col("op") == OP_DELETE
    env = rows.select("op", "ts_ms", F.when(gone, key).alias("before"), F.when(~gone, row).alias("after"))
    # a task reads a compressed file whole, so none has more than some rows
    env.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", WIDE_ROWS).json(path)


def _feed(spark: SparkSession, work: str, name: str, rows: DataFrame, **options) -> KeyedTable:
    """A registered feed from its landed files to its Silver table."""
    _land(rows, name, f"{work}/landing/{name}")
    jobs.ingest_source(spark, name, f"{work}/landing/{name}", f"{work}/bronze/{name}", f"{work}/_c/bronze-{name}")
    jobs.bronze_dq_source(spark, name, f"{work}/bronze/{name}", f"{work}/valid/{name}", f"{work}/bad/{name}",
                          f"{work}/_c/dq-{name}")
    fed = spark.read.parquet(f"{work}/bronze/{name}").count()      # from the files' footers
    return jobs.silver_source(spark, name, f"{work}/valid/{name}", f"{work}/silver/{name}", f"{work}/_c/silver-{name}",
                              _buckets(fed, WIDE_ROWS), **options)


def _order_events(orders: DataFrame) -> DataFrame:
    """Orders as CDC events; one whose version is closed was deleted later."""
    ms = F.unix_millis(F.col("order_date").cast("timestamp"))
    made = orders.select("order_id", "customer_id", "order_status", "order_date", "updated_at", "shipping_city",
                         "shipping_state", "shipping_country", (F.col("total_cents") / 100).alias("total_amount"),
                         (F.col("discount_cents") / 100).alias("discount_amount"), "valid_to", ms.alias("ts_ms"))
    gone = made.where(~is_current(orders)).withColumns({"op": F.lit(OP_DELETE), "ts_ms": F.col("ts_ms") + 1})
    return made.withColumn("op", F.lit("c")).unionByName(gone)


# Tiers that the Bronze rule of the customers feed lets through.
TIERS = ("bronze", "silver", "gold", "platinum")


def _customer_events(customers: DataFrame) -> DataFrame:
    """Every version of a customer as an event of its start, with a tier that
    the feed's rule knows."""
    tier = F.element_at(F.array(*map(F.lit, TIERS)), (F.col("customer_id") % 4 + 1).cast("int"))
    return customers.withColumns({"op": F.lit("u"), "ts_ms": F.unix_millis(F.col("valid_from").cast("timestamp")),
                                  "loyalty_tier": F.when(is_current(customers), tier).otherwise(TIERS[0])})


@_q
def stream_customer_360(spark, sf_dir):
    """C9 from the registered feeds: customer and order envelopes to Silver
    histories (currency amounts), and the mart (cents) maintained from the
    change logs of both."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "c360")
    customers = _feed(spark, work, "customers", _customer_events(fx.fx_customers_scd2), changes=f"{work}/log/customers")
    orders = _feed(spark, work, "orders", _order_events(fx.fx_orders_scd2), changes=f"{work}/log/orders")
    people = versions(customers.read())
    bought = marts.orders_in_cents(versions(orders.read())).select(
        "customer_id", "order_id", "total_cents", F.to_date("order_date").alias("order_date"), "valid_to")
    empty = marts.customer_360(people.limit(0), bought.limit(0), batch_catalog.AS_OF_DATE)
    mart = _mart(spark, f"{work}/gold_customer_360", empty, "customer_id", customers.buckets)

    def maintain(prev: DataFrame, images: DataFrame) -> DataFrame:
        return maintenance.maintain_customer_360(prev, people, bought, [images], [], batch_catalog.AS_OF_DATE)
    for table in (customers, orders):
        jobs.mart_stream(_images(spark, table), mart, maintain, f"{table.changes}-checkpoint", _touched("customer_id"))
    return mart.read().withColumns({"customer_id": F.col("customer_id").cast("long"),
                                    "registration_date": F.to_date("registration_date")})


def _item_events(items: DataFrame) -> DataFrame:
    return items.select(
        F.concat_ws("-", "order_id", "line_no").alias("order_item_id"), "order_id", "product_id", "quantity",
        (F.col("line_cents") / F.col("quantity") / 100).alias("unit_price"), (F.col("line_cents") / 100).alias("line_total"),
        "return_requested", "return_reason", F.lit("c").alias("op"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"))


@_q
def stream_daily_revenue(spark, sf_dir):
    """C10 from the registered feeds: order and order-item envelopes to Silver,
    and the mart (cents) maintained from the change logs of both."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "revenue")
    newest = dedup.latest_per_key(fx.fx_order_items, batch_catalog.ITEM_KEYS, batch_catalog.ITEM_ORDER)
    orders = _feed(spark, work, "orders", _order_events(fx.fx_orders_scd2), changes=f"{work}/log/orders")
    items = _feed(spark, work, "order_items", _item_events(newest), changes=f"{work}/log/order_items")
    products = fx.fx_products.withColumn("product_id", F.col("product_id").cast("string"))
    sold = marts.orders_in_cents(versions(orders.read())).withColumn("order_date", F.to_date("order_date"))
    lines = marts.items_in_cents(items.read())
    empty = marts.daily_revenue(sold.limit(0), lines.limit(0), products, fx.fx_categories)
    mart = _mart(spark, f"{work}/gold_daily_revenue", empty, "order_date", items.buckets)

    dates: dict[str, DataFrame] = {}        # of the batch in hand: named by touched, used by maintain
    for table, role in ((orders, "order_images"), (items, "item_images")):
        def touched(images: DataFrame, role=role) -> DataFrame:
            dates[role] = written(maintenance.daily_revenue_dates(sold, lines, products, **{role: [images]}), "dates")
            return dates[role]

        def maintain(prev: DataFrame, images: DataFrame, role=role) -> DataFrame:
            return maintenance.maintain_daily_revenue(prev, sold, lines, products, fx.fx_categories, dates=dates[role],
                                                      **{"order_images": [], "item_images": [], role: [images]})
        jobs.mart_stream(_images(spark, table), mart, maintain, f"{table.changes}-checkpoint", touched)
    return mart.read()


@_q
def stream_funnel(spark, sf_dir):
    """C12 from the registered feed: clickstream lines to Bronze and Silver,
    and the funnel maintained from the rows that Silver gains."""
    fx, work = Fixtures(spark, sf_dir), _work(spark, "funnel")
    fields = SOURCES["clickstream"].schema.fields
    clicks = fx.fx_clickstream
    full = clicks.select(*[(F.col(f.name).cast("string") if f.name in clicks.columns else F.lit(None).cast("string"))
                           .alias(f.name) for f in fields])
    full.write.json(f"{work}/landing")
    jobs.ingest_source(spark, "clickstream", f"{work}/landing", f"{work}/bronze", f"{work}/_c/bronze")
    jobs.silver_source(spark, "clickstream", f"{work}/bronze", f"{work}/silver", f"{work}/_c/silver")
    silver = spark.read.parquet(f"{work}/silver")
    mart = _mart(spark, f"{work}/gold_funnel", marts.funnel_analysis(silver.limit(0)), "referrer")
    changes = file_stream(spark, "parquet", silver.drop("_query_id", "_batch_id").schema, f"{work}/silver", lineage=False)

    def touched(rows: DataFrame) -> DataFrame:
        return rows.select(F.coalesce("referrer", F.lit("direct")).alias("referrer")).distinct()

    def maintain(prev: DataFrame, rows: DataFrame) -> DataFrame:
        return maintenance.maintain_funnel(prev, silver, [rows])
    jobs.mart_stream(changes, mart, maintain, f"{work}/_c/gold", touched)
    return mart.read()


def stream_oracle_sql() -> dict[str, str]:
    raw = {
        "stream_ingest_csv": "select * from fx_products",
        "stream_ingest_cdc_json": BATCH_SQL["cdc_flatten"],
        "stream_dq_split": f"select *, {ITEM_PRED} as is_valid from fx_order_items",
        "stream_scd1": BATCH_SQL["latest_order_item"],
        "stream_silver_quarantine": f"""select *, coalesce(not (return_requested = true and return_reason is null)
            and abs(line_total - quantity * unit_price) < 0.01, false) as is_valid
            from (select *, {PRICED} from ({BATCH_SQL['latest_order_item']}) l) p""",
        "stream_scd2": BATCH_SQL["scd2_from_changelog"],
        "stream_scd1_cdc": f"""select pk, st, cust, epoch_ms(valid_from) as ts_ms
            from ({BATCH_SQL['scd2_from_changelog']}) h where valid_to is null""",
        "stream_customer_360": f"""select * replace ({list(TIERS)}[customer_id % 4 + 1] as loyalty_tier)
            from ({BATCH_SQL['customer_360']}) c""",
        "stream_daily_revenue": daily_revenue_sql("fx_orders_scd2", f"({BATCH_SQL['latest_order_item']})"),
        "stream_funnel": BATCH_SQL["funnel_analysis"],
        "stream_mart": BATCH_SQL["incr_fulfillment_health"],
        "stream_append_conform": BATCH_SQL["append_conform_events"],
        "stream_mart_two_sources": BATCH_SQL["incr_product_performance_inventory"],
        "stream_silver_to_gold": BATCH_SQL["incr_fulfillment_health"],
    }
    return {k: with_fixtures(v) for k, v in raw.items()}
