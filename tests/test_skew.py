"""A key holding a third of all rows: results stay exact and every grouping
aggregates partially before its shuffle (the hot group never moves whole)."""

import datetime as dt
import re

from pyspark.sql import functions as F

from strata.operators import dedup, quality, skew
from strata.plans import marts

OPEN = dt.datetime(9999, 12, 31)


def _skewed(spark, n=3000):
    # key "hot" holds n/3 rows; the rest spread over n*2/3 distinct keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 97).alias("ts"), F.col("id").alias("v"))


def _partial_before_exchange(df, capsys) -> bool:
    df.collect()
    df.explain("formatted")
    plan = capsys.readouterr().out
    # some aggregate node sits under (is listed after) a hash-partitioning exchange
    body = plan.split("== Final Plan ==")[-1].split("== Initial Plan ==")[0]
    return bool(re.search(r"Exchange[\s\S]*?(HashAggregate|SortAggregate|ObjectHashAggregate)", body))


def test_latest_per_key_hot_key(spark, capsys):
    df = _skewed(spark)
    out = dedup.latest_per_key(df, ["k"], ["ts"])
    hot = out.filter("k = 'hot'").collect()
    assert len(hot) == 1 and hot[0].ts == 96
    assert hot[0].v == max(i for i in range(0, 3000, 3) if i % 97 == 96)
    assert out.count() == 1 + 2000
    assert _partial_before_exchange(out, capsys)


def test_duplicate_keys_hot_key(spark, capsys):
    d = quality.duplicate_keys(_skewed(spark), ["k"])
    assert [(r.k, r.occurrences) for r in d.collect()] == [("hot", 1000)]
    assert _partial_before_exchange(d, capsys)


def test_customer_360_hot_customer(spark, capsys):
    orders = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
        .alias("customer_id"), F.col("id").cast("string").alias("order_id"),
        F.lit(100).cast("bigint").alias("total_cents"),
        F.lit(dt.date(2024, 1, 1)).alias("order_date"), F.lit(OPEN).alias("valid_to"))
    customers = spark.createDataFrame([("HOT", "x", OPEN)],
                                      "customer_id string, first_name string, valid_to timestamp")
    r = marts.customer_360(customers, orders, dt.date(2024, 1, 2), profile_cols=[])
    row = r.collect()[0]
    assert (row.order_count, row.lifetime_value) == (1000, 1000.0)
    assert _partial_before_exchange(r, capsys)


def test_daily_revenue_hot_order(spark):
    """One order holding a third of all items: allocation and totals stay exact."""
    items = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
        .alias("order_id"), F.lit("P1").alias("product_id"),
        F.lit(1).cast("bigint").alias("quantity"), F.lit(100).cast("bigint").alias("line_cents"))
    orders = items.select("order_id").distinct().select(
        "order_id", F.lit(dt.datetime(2024, 1, 1)).alias("order_date"),
        F.when(F.col("order_id") == "HOT", F.lit(1000)).otherwise(F.lit(0)).cast("bigint")
        .alias("discount_cents"), F.lit("UK").alias("shipping_country"),
        F.lit("Kent").alias("shipping_state"),
        F.lit("Ashford").alias("shipping_city"), F.lit(OPEN).alias("valid_to"))
    prods = spark.createDataFrame([("P1", "shoe")], "product_id string, category_id string")
    cats = spark.createDataFrame([("shoe", "Shoes")], "category_id string, category_name string")
    r = marts.daily_revenue(orders, items, prods, cats).collect()
    assert len(r) == 1
    # 1000 lines of the hot order share 1000 cents: exactly 1 cent each
    assert (r[0].gross_revenue, r[0].total_discount, r[0].order_count,
            r[0].total_units_sold) == (3000.0, 10.0, 2001, 3000)


def test_hot_order_is_dealt_over_tasks(spark):
    """An order with a third of all items: values as by hand, and no task of
    the join has more rows than the skew factor times the median task."""
    n = 24_000
    items = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).cast("long").alias("order_id"),
        F.col("id").alias("line_no"), (F.col("id") % 10 + 1).alias("line_cents")).repartition(8)
    orders = items.select("order_id").distinct().select(
        "order_id", F.lit(1000).cast("long").alias("discount_cents"), F.lit(OPEN).alias("valid_to"))
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        made = marts.discount_allocation(orders, items)
        sizes = sorted(r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect())
        assert sum(sizes) == n and len(sizes) == 8
        assert sizes[-1] <= 5 * sizes[len(sizes) // 2]       # AQE's skewedPartitionFactor
        plain = items.join(orders, "order_id").groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in plain.collect()) >= n // 3
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    hot = made.where("order_id = 7")
    total = sum(i % 10 + 1 for i in range(0, n, 3))
    assert {(r.line_cents, r.subtotal_cents, r.allocated_cents) for r in hot.collect()} == {
        (c, total, (2 * c * 1000 + total) // (2 * total)) for c in {i % 10 + 1 for i in range(0, n, 3)}}


def test_frequent_keys_hold_every_heavy_one(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 100 < 5, F.col("id") % 100).otherwise(F.col("id")).alias("k"))
    found = {r.k for r in skew.frequent_keys(rows, "k", parts=200).collect()}
    assert set(range(5)) <= found and len(found) <= 200
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "k long, v string")
    right = spark.createDataFrame([(1, 10), (2, 20)], "k long, x int")
    heavy = spark.createDataFrame([(1,), (1,), (9,)], "k long")
    assert sorted(map(tuple, skew.join_heavy(left, right, ["k"], heavy).collect())) == [
        (1, "a", 10), (1, "b", 10), (2, "c", 20)]
    assert skew.join_heavy(left, right, ["k"], heavy, "left").where("x is null").count() == 1
