"""Physical-plan properties: pushdown, pruning, no Python in the hot path."""

import datetime as dt
import re

import pytest

from pyspark.sql import functions as F

from strata.functions.predicates import current_rows
from strata.operators import incremental, scd
from strata.plans import marts

OPEN = dt.datetime(9999, 12, 31)


def _plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_current_rows_filter_reaches_parquet_scan(spark, tmp_path, capsys):
    p = str(tmp_path / "scd2")
    spark.createDataFrame([("a", "x", "y", OPEN), ("a", "w", "z", dt.datetime(2020, 1, 1))],
                          "k string, v string, w string, valid_to timestamp").write.parquet(p)
    plan = _plan(current_rows(spark.read.parquet(p)).select("k"), capsys)
    assert "GreaterThanOrEqual(valid_to," in plan
    assert "ReadSchema: struct<k:string,valid_to:timestamp>" in plan


def test_customer_360_pushes_and_prunes(spark, tmp_path, capsys):
    c = str(tmp_path / "c")
    o = str(tmp_path / "o")
    spark.createDataFrame([("C1", "A", "x@y", OPEN)],
                          "customer_id string, first_name string, email string, valid_to timestamp"
                          ).write.parquet(c)
    spark.createDataFrame([("C1", "O1", 100, dt.date(2024, 1, 1), "note", OPEN)],
                          "customer_id string, order_id string, total_cents bigint, "
                          "order_date date, note string, valid_to timestamp").write.parquet(o)
    df = marts.customer_360(spark.read.parquet(c), spark.read.parquet(o), dt.date(2024, 2, 1),
                            profile_cols=["first_name", "email"])
    plan = _plan(df, capsys)
    assert plan.count("GreaterThanOrEqual(valid_to,") == 2
    assert "note" not in plan.split("ReadSchema")[1] and "note" not in plan.split("ReadSchema")[2]
    r = df.collect()
    assert r[0].lifetime_value == 1.0 and r[0].days_since_last_order == 31


@pytest.mark.parametrize("name", ["customer_360", "daily_revenue", "fulfillment_health",
                                  "funnel_analysis", "product_performance",
                                  "latest_order_item_maxby", "scd2_apply", "cdc_classify"])
def test_no_python_evaluation_in_plans(spark, capsys, name):
    from __spark_entry__ import queries
    from tests.conftest import SF_SMALL
    df = queries()[name](spark, SF_SMALL)
    df.collect()                      # AQE shows the final plan after execution
    plan = _plan(df, capsys)
    assert "isFinalPlan=true" in plan
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert re.search(r"\* \w+ \(\d+\)", plan)     # "* Op (n)" = inside whole-stage codegen


def test_scope_prunes_partitions_and_keeps_null_keys(spark, tmp_path, capsys):
    """A table partitioned by the key is read where keys were affected only."""
    days = spark.range(600).select("id", F.expr("date_add(date '2024-01-01', cast(id % 30 as int))").alias("order_date"))
    days = days.unionByName(spark.createDataFrame([(1000, None), (1001, None)], "id long, order_date date"))
    days.write.partitionBy("order_date").parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    keys = spark.createDataFrame([(dt.date(2024, 1, 3),), (dt.date(2024, 1, 3),), (None,)], "order_date date").distinct().persist()
    keys.count()
    found = incremental.scope(facts, keys, ["order_date"])
    plan = _plan(found, capsys)
    assert "dynamicpruning" in plan and "PartitionFilters: [isnull(order_date" in plan
    rows = found.collect()
    assert len(rows) == 22 and {r.order_date for r in rows} == {dt.date(2024, 1, 3), None}
    assert incremental.replace_keys(facts, facts.limit(0), keys, ["order_date"]).count() == 580
    read = re.findall(r"number of output rows: (\d+)", "")
    assert read == [] and found.inputFiles()
    keys.unpersist()


def test_image_diff_is_one_shuffle(spark, capsys):
    """Both directions of a diff come from one exchange, multiplicities included."""
    before = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, None), (2, None), (2, None), (4, "d")], "v2 int, x string").toDF("k", "v")
    signed = incremental.signed_images(before, after)
    assert len(re.findall(r"^\s*[:+| -]*Exchange \(", _plan(signed, capsys), re.M)) == 1
    assert sorted(map(tuple, signed.collect())) == [(1, "a", -1), (2, None, 2), (3, "c", -1), (4, "d", 1)]
    old, new = incremental.changed_images(before, after)
    assert sorted(map(tuple, old.collect())) == [(1, "a"), (3, "c")]
    assert sorted(map(tuple, new.collect()), key=str) == [(2, None), (2, None), (4, "d")]


def test_images_of_the_columns_that_a_consumer_reads(spark):
    before = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (2, "b", 8)], "k int, v string, other int")
    after = spark.createDataFrame([(1, "a", 9), (2, "c", 7), (2, "b", 7)], "k int, v string, other int")
    signed = incremental.signed_images(before, after, ["k", "v"])
    assert sorted(map(tuple, signed.collect())) == [(2, "b", -1), (2, "c", 1)]


def test_daily_revenue_counts_orders_without_a_shuffle_of_their_own(spark, capsys):
    """Repeated orders, and one whose lines are dealt over many tasks, count once a group."""
    day = dt.date(2024, 1, 1)
    orders = spark.createDataFrame([(o, day, 50, "c", "s", t, OPEN) for o, t in [(1, "x"), (2, "x"), (2, "x"), (3, "y"), (4, "x")]],
                                   "order_id long, order_date date, discount_cents long, shipping_country string, "
                                   "shipping_state string, shipping_city string, valid_to timestamp")
    lines = [(1, 10, 1, 100)] * 5000 + [(2, 10, 1, 300), (2, 11, 2, 100), (3, 10, 1, 5), (4, 10, None, 7), (4, 99, 1, 7), (None, 10, 1, 1)]
    items = spark.createDataFrame(lines, "order_id long, product_id long, quantity long, line_cents long").repartition(6)
    products = spark.createDataFrame([(10, "g"), (11, "g"), (12, None)], "product_id long, category_id string")
    categories = spark.createDataFrame([("g", "name")], "category_id string, category_name string")
    out = marts.daily_revenue(orders, items, products, categories)
    got = sorted((r.shipping_city, r.order_count, r.total_units_sold, r.gross_revenue) for r in out.collect())
    assert got == [("x", 3, 5000 + 2 * 3, (500000 + 2 * 400 + 7) / 100), ("y", 1, 1, 0.05)]
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = _plan(marts.daily_revenue(orders, items, products, categories), capsys).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    above = tree[:tree.index("SortMergeJoin")]
    assert len(re.findall(r"Exchange \(", above)) == 1


def test_merge_into_a_bucketed_table_shuffles_the_batch_only(spark, tmp_path, capsys):
    rows = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    scd.save_bucketed(rows, "bucketed_target", ["k"], 8, str(tmp_path / "bucketed_target"))
    spark.range(0, 8000, 3).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v")).write.parquet(str(tmp_path / "b"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target, batch = spark.table("bucketed_target"), spark.read.parquet(str(tmp_path / "b"))
        for merged in (scd.upsert(target, batch, ["k"]), scd.upsert_changed_only(target, batch, ["k"], ["v"])):
            tree = _plan(merged, capsys).split("\n\n")[0]
            join = tree[tree.index("SortMergeJoin"):].split("Scan parquet")[0]
            assert "Exchange" not in join and "Exchange" in tree       # above the target's scan; above the batch's
            assert merged.count() == 4000 + 2667 - 1334 and merged.where("v = -1").count() == 2667
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
        spark.sql("drop table bucketed_target")
