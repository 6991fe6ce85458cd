"""Incremental maintenance = full recompute (H8); replay-safe streaming."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import incremental
from strata.plans import maintenance, marts
from strata.session import scratch_dir
from strata.sources.schemas import ORDERS_ROW
from strata.streaming import jobs
from strata.streaming.tables import KeyedTable

OPEN = dt.datetime(9999, 12, 31)
ORD = ("order_id string, order_status string, order_date timestamp, updated_at timestamp, "
       "shipping_state string, valid_to timestamp")


def _o(oid, status, day, state="Kent"):
    return (oid, status, dt.datetime(2024, 1, day), dt.datetime(2024, 1, day + 1), state, OPEN)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_moved_key_and_emptied_date_are_recomputed(spark):
    before = spark.createDataFrame([_o("A", "delivered", 1), _o("B", "delivered", 2),
                                    _o("C", "delivered", 3)], ORD)
    after = spark.createDataFrame([_o("A", "delivered", 2), _o("B", "delivered", 2),
                                   _o("C", "shipped", 3), _o("D", "delivered", 4)], ORD)
    prev = marts.fulfillment_health(before)
    old, new = incremental.changed_images(before, after)
    got = maintenance.maintain_fulfillment_health(prev, after, [old, new])
    assert _rows(got) == _rows(marts.fulfillment_health(after))
    assert {r.order_date.day for r in got.collect()} == {2, 4}   # days 1 and 3 emptied


def test_replace_keys_removes_absent_keys(spark):
    tgt = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    res = spark.createDataFrame([("b", 20)], "k string, v int")
    keys = spark.createDataFrame([("b",), ("c",)], "k string")
    assert _rows(incremental.replace_keys(tgt, res, keys, ["k"])) == [("a", 1), ("b", 20)]


KV = StructType().add("k", "string").add("v", "integer")


def _kv(spark, *rows):
    return spark.createDataFrame(list(rows), KV)


def _append(prev, b):       # not idempotent on purpose
    return prev.unionByName(b)


def test_a_batch_is_applied_once(spark):
    t = KeyedTable(spark, scratch_dir(spark, "replay"), KV, ["k"], 4)
    assert t.read().count() == 0
    t.create(_kv(spark, ("a", 1)))
    t.create(_kv(spark, ("z", 9)))                             # exists
    for rows, i in (([("b", 2)], 0), ([("b", 2)], 0), ([("c", 3)], 1), ([("b", 2)], 0)):
        t.merge_batch(_append, _kv(spark, *rows), "q", i)
    assert _rows(t.read()) == [("a", 1), ("b", 2), ("c", 3)]


@pytest.mark.parametrize("at", ["rows staged", "partitions overwritten"])
def test_a_batch_that_crashes_is_completed(spark, monkeypatch, at):
    """A batch that ends before its mark is set is run again: before its rows
    were staged from the table as it was, later from the staged rows."""
    t = KeyedTable(spark, scratch_dir(spark, "crash"), KV, ["k"], 4, changes=scratch_dir(spark, "log"))
    t.create(_kv(spark, ("a", 1), ("b", 1)))
    mark = t._mark

    def crash(path):
        if path.endswith("staged" if at == "rows staged" else "done"):
            raise RuntimeError("lost")
        mark(path)
    monkeypatch.setattr(t, "_mark", crash)
    batch = _kv(spark, ("b", 2), ("c", 3))
    with pytest.raises(RuntimeError):
        t.merge_batch(_append, batch, "q", 0)
    monkeypatch.setattr(t, "_mark", mark)
    if at == "rows staged":
        assert _rows(t.read()) == [("a", 1), ("b", 1)]
    t.merge_batch(_append, batch, "q", 0)
    assert _rows(t.read()) == [("a", 1), ("b", 1), ("b", 2), ("c", 3)]
    log = spark.read.parquet(t.changes).where("_query = 'q'")
    assert _rows(log.select("k", "v", "_w")) == [("b", 2, 1), ("c", 3, 1)]


def test_stream_rerun_reads_no_file_twice(spark):
    work = scratch_dir(spark, "rerun")
    env = spark.createDataFrame(
        [("c", 1000, None, ("O1", "C1", "placed", None, None, None, None, None, None, None,
                             None, None, 10.0))],
        "op string, ts_ms bigint, before string, after struct<order_id:string, customer_id:string,"
        " order_status:string, order_date:string, updated_at:string, shipping_address_id:string,"
        " shipping_city:string, shipping_state:string, shipping_country:string,"
        " payment_method:string, discount_code:string, discount_amount:double, total_amount:double>")
    env.write.json(f"{work}/landing")
    for _ in range(2):
        jobs.ingest_cdc(spark, ORDERS_ROW, f"{work}/landing", f"{work}/bronze", f"{work}/ckpt")
    bronze = spark.read.parquet(f"{work}/bronze")
    assert bronze.count() == 1
    r = bronze.collect()[0]
    assert r.after.order_id == "O1" and r._source_file.endswith(".json") and r._ingested_at


def _files(t):
    """Files by bucket."""
    out = {}
    for f in t._stored(t.path).inputFiles():
        out.setdefault(f.split("_bucket=")[1].split("/")[0], set()).add(f)
    return out


def test_table_rewrites_only_touched_buckets(spark):
    t = KeyedTable(spark, scratch_dir(spark, "buckets"), KV, ["k"], 8)
    t.create(_kv(spark, *[(f"k{i}", i) for i in range(40)]))
    before = _files(t)
    batch = _kv(spark, ("k3", 300), ("new", 1))

    def step(prev, b):
        return prev.join(b, "k", "left_anti").unionByName(b)
    t.merge_batch(step, batch, "q", 0)
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 41 and got["k3"] == 300 and got["new"] == 1
    changed = {b for b, f in _files(t).items() if before[b] != f}
    assert changed == {str(b) for b in t.touched(batch)} and 1 <= len(changed) <= 2
    assert all(len(f) == 1 for f in _files(t).values())
    for i, key in enumerate([f"k{i}" for i in range(40)] + ["new"]):       # every bucket emptied
        if i < 3 or key == "new":
            t.merge_batch(lambda prev, b: prev.join(b, "k", "left_anti"), _kv(spark, (key, 0)), "q", i + 1)
    assert {"k0", "k1", "k2", "new"}.isdisjoint(r.k for r in t.read().collect()) and t.read().count() == 37
    t.merge(lambda prev: prev.limit(0), list(range(8)), "q", 99)
    assert t.read().count() == 0
    with pytest.raises(ValueError, match="bucket"):
        t.merge(lambda prev: _kv(spark, *[(f"k{i}", i) for i in range(40)]), [0], "q", 100)


def test_registered_cdc_source_ingest_and_delete_aware_dq(spark):
    """Registry-driven Bronze ingest + DQ: a delete with a NULL row image and
    a valid update pass, an unparsable line and a row without key do not."""
    work = scratch_dir(spark, "registry")
    lines = ['{"op":"u","ts_ms":1,"after":{"order_id":"O1","customer_id":"C1","total_amount":5.0}}',
             '{"op":"d","ts_ms":2,"before":{"order_id":"O1"},"after":null}',
             '{"op":"c","ts_ms":3,"after":{"customer_id":"C2"}}',
             'not json']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.text(f"{work}/landing")
    jobs.ingest_source(spark, "orders", f"{work}/landing", f"{work}/bronze", f"{work}/ck1")
    jobs.bronze_dq_source(spark, "orders", f"{work}/bronze", f"{work}/valid", f"{work}/bad",
                          f"{work}/ck2")
    ok = spark.read.parquet(f"{work}/valid")
    bad = spark.read.parquet(f"{work}/bad")
    assert sorted(r.op for r in ok.collect()) == ["d", "u"]
    assert bad.count() == 2 and ok.count() + bad.count() == 4
    assert [r._corrupt_record for r in bad.where("op is null").collect()] == ["not json"]


def test_a_broken_csv_line_is_quarantined_with_its_text(spark):
    work = scratch_dir(spark, "corrupt-csv")
    lines = ["category_id,category_name,parent_category_id,is_active", "c1,Shoes,,true", "c2,Hats,,perhaps"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{work}/landing")
    jobs.ingest_source(spark, "categories", f"{work}/landing", f"{work}/bronze", f"{work}/ck1")
    jobs.bronze_dq_source(spark, "categories", f"{work}/bronze", f"{work}/valid", f"{work}/bad", f"{work}/ck2")
    assert [r.category_id for r in spark.read.parquet(f"{work}/valid").collect()] == ["c1"]
    assert [r._corrupt_record for r in spark.read.parquet(f"{work}/bad").collect()] == ["c2,Hats,,perhaps"]


def test_change_log_feeds_a_downstream_mart(spark):
    """H5: an SCD1 table logs old/new images per batch; a mart maintained
    from that log equals the mart recomputed from the final table."""
    from strata.operators.scd import upsert
    work = scratch_dir(spark, "changes")
    first = spark.createDataFrame([_o("A", "delivered", 1), _o("B", "shipped", 2)], ORD)
    t = KeyedTable(spark, f"{work}/orders", first.schema, ["order_id"], 4, changes=f"{work}/_changes")
    t.create(first)
    step = lambda prev, b: upsert(prev, b, ["order_id"])
    batches = [[_o("A", "delivered", 3)], [_o("B", "delivered", 2), _o("C", "delivered", 3)]]
    for i, rows in enumerate([*batches, batches[1]]):                      # the last one again
        t.merge_batch(step, spark.createDataFrame(rows, ORD), "o", min(i, 1))
    log = spark.read.parquet(f"{work}/_changes").where("_query = 'o'")
    assert log.filter("_w = -1").count() == 2 and log.filter("_w = 1").count() == 3
    before = marts.fulfillment_health(first)
    mart = KeyedTable(spark, f"{work}/mart", before.schema, ["order_date"], 4)
    mart.create(before)
    images = log.drop("_w", "_query", "_batch")
    dates = incremental.affected_keys([images], {"order_date": F.to_date("order_date")})
    mart.merge_batch(lambda prev, b: maintenance.maintain_fulfillment_health(prev, t.read(), [b]),
                     images, "m", 0, keys=dates)
    assert _rows(mart.read()) == _rows(marts.fulfillment_health(t.read()))


def test_scd1_stream_audit_and_history(spark):
    """Per-batch merge metrics land in an audit table, whose newest
    batches are reported."""
    from strata.streaming.drivers import file_stream
    work = scratch_dir(spark, "audit")
    schema = StructType().add("k", "string").add("v", "string").add("ts", "integer").add("op", "string")
    for rows in ([("a", "1", 1, "c"), ("b", "1", 1, "c")],
                 [("a", "2", 2, "u"), ("b", "1", 2, "u"), ("c", "1", 2, "c")],
                 [("b", None, 3, "d")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{work}/in")
    t = KeyedTable(spark, f"{work}/t", StructType(list(schema.fields[:3])), ["k"], 1, audit=f"{work}/audit")
    src = file_stream(spark, "parquet", schema, f"{work}/in", max_files_per_trigger=1, lineage=False)
    jobs.scd1_stream(src, t, ["ts"], f"{work}/ck", tracked=["v"], op_col="op")
    assert _rows(t.read()) == [("a", "2", 2), ("c", "1", 2)]
    a = {r.batch_id: (r.rows_inserted, r.rows_updated, r.rows_unchanged, r.rows_deleted, r.rows_copied)
         for r in spark.read.parquet(f"{work}/audit").collect()}
    assert a == {0: (2, 0, 0, 0, 0), 1: (1, 1, 1, 0, 0), 2: (0, 0, 0, 1, 2)}
    assert [r.batch_id for r in jobs.newest_batches(spark, f"{work}/audit", 2).collect()] == [2, 1]


def test_stream_replay_after_crash_is_exactly_once(spark):
    """A crash after the sink wrote batch N but before Spark committed it
    makes Spark re-run batch N on restart; the table ends up as if it ran once."""
    import os
    from strata.operators.cdc import flatten_cdc
    from strata.operators.scd import versions
    from strata.streaming.drivers import cdc_stream
    work = scratch_dir(spark, "crash")
    waves = [['{"op":"c","ts_ms":1000,"after":{"order_id":"A","order_status":"new"}}',
              '{"op":"c","ts_ms":1000,"after":{"order_id":"B","order_status":"new"}}'],
             ['{"op":"u","ts_ms":2000,"after":{"order_id":"A","order_status":"paid"}}'],
             ['{"op":"d","ts_ms":3000,"before":{"order_id":"B"},"after":null}',
              '{"op":"u","ts_ms":3000,"after":{"order_id":"A","order_status":"sent"}}']]
    for lines in waves:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.mode("append").text(f"{work}/landing")

    def run():
        src = flatten_cdc(cdc_stream(spark, ORDERS_ROW, f"{work}/landing",
                                     max_files_per_trigger=1), "order_id")
        t = KeyedTable(spark, f"{work}/scd2", jobs.history_schema(src.schema, "order_id", ["order_status"]),
                       ["order_id"], 4)
        jobs.scd2_stream(src, t, "order_id", ["order_status"], f"{work}/ck")
        return versions(t.read())
    first = _rows(run())
    ck = f"{work}/ck/commits".replace("file:", "")
    for name in ("2", ".2.crc"):                               # crash before commit
        if os.path.exists(f"{ck}/{name}"):
            os.remove(f"{ck}/{name}")
    assert _rows(run()) == first                               # restart: batch 2 again
    assert sorted((r[0], r[1], r[3].year == 9999) for r in first) == [
        ("A", "new", False), ("A", "paid", False), ("A", "sent", True), ("B", "new", False)]


def test_mart_rewrites_only_touched_keys(spark):
    before = spark.createDataFrame([_o(x, "delivered", d) for x, d in
                                    [("A", 1), ("B", 2), ("C", 3), ("D", 4), ("E", 5)]], ORD)
    after = spark.createDataFrame([_o(x, "delivered", d) for x, d in
                                   [("A", 1), ("B", 6), ("C", 3), ("D", 4), ("E", 5)]], ORD)
    rows = marts.fulfillment_health(before)
    mart = KeyedTable(spark, scratch_dir(spark, "mart-b"), rows.schema, ["order_date"], 8,
                      primary_key=["order_date", "region"])
    mart.create(rows)
    was = _files(mart)
    images = incremental.signed_images(before, after)
    touched = incremental.affected_keys([images], {"order_date": F.to_date("order_date")})
    mart.merge_batch(lambda prev, b: maintenance.maintain_fulfillment_health(prev, after, [b]),
                     images, "m", 0, keys=touched)
    assert _rows(mart.read()) == _rows(marts.fulfillment_health(after))
    assert {b for b, f in _files(mart).items() if was[b] != f} == {str(b) for b in mart.touched(touched)}


def _drop(spark, path, rows):
    _kv(spark, *rows).coalesce(1).write.mode("append").parquet(path)


def test_recreated_checkpoint_loses_no_row(spark):
    """Batch ids start at 0 again with a new checkpoint; staged rows are named
    by query id too, so no batch is taken for another."""
    work = scratch_dir(spark, "recreated")
    table = KeyedTable(spark, f"{work}/t", KV, ["k"], 4)
    for i, rows in enumerate(([(f"k{j}", 1) for j in range(40)], [("k0", 2)], [("k1", 3)])):
        _drop(spark, f"{work}/in{i}", rows)
        src = spark.readStream.schema(KV).parquet(f"{work}/in{i}")
        jobs.scd1_stream(src, table, ["v"], f"{work}/checkpoint{i}")
    got = {r.k: r.v for r in KeyedTable(spark, f"{work}/t", KV, ["k"], 4).read().collect()}
    assert got == {f"k{j}": {0: 2, 1: 3}.get(j, 1) for j in range(40)}


def test_recreated_checkpoint_keeps_split_rows(spark):
    work = scratch_dir(spark, "resplit")
    for i, n in enumerate((10, 3)):
        _drop(spark, f"{work}/in{i}", [(f"k{j}", j - 1) for j in range(n)])
        src = spark.readStream.schema("k string, v int").parquet(f"{work}/in{i}")
        jobs.dq_split(src, {"positive": "v >= 0"}, f"{work}/ok", f"{work}/bad", f"{work}/checkpoint{i}")
    assert spark.read.parquet(f"{work}/ok").count() == 11 and spark.read.parquet(f"{work}/bad").count() == 2


def test_a_finished_batch_never_undoes_another_query(spark):
    path = scratch_dir(spark, "writers")
    one, two = (KeyedTable(spark, path, KV, ["k"], 1) for _ in range(2))
    one.merge_batch(_append, _kv(spark, ("k0", 0)), "a", 0)
    two.merge_batch(_append, _kv(spark, ("k1", 1)), "b", 0)
    one.merge_batch(_append, _kv(spark, ("k2", 2)), "a", 1)
    one.merge_batch(_append, _kv(spark, ("k0", 0)), "a", 0)
    two.merge_batch(_append, _kv(spark, ("k1", 1)), "b", 0)
    assert _rows(two.read()) == [("k0", 0), ("k1", 1), ("k2", 2)]


def test_a_mended_row_moves_between_the_halves(spark):
    """Only the keys of a batch change sides; other rows stay as they are."""
    from strata.streaming.drivers import file_stream
    work = scratch_dir(spark, "halves")
    silver, clean, bad = (KeyedTable(spark, f"{work}/{n}", KV, ["k"], 4, changes=f"{work}/log" if n == "s" else None)
                          for n in ("s", "clean", "bad"))
    log = StructType([*KV.fields]).add("_w", "long")

    def run(rows):
        _drop(spark, f"{work}/in", rows)
        jobs.scd1_stream(spark.readStream.schema(KV).parquet(f"{work}/in"), silver, ["v"], f"{work}/ck-s")
        jobs.quarantine_stream(file_stream(spark, "parquet", log, f"{work}/log", lineage=False), silver,
                               {"positive": "v > 0"}, clean, bad, f"{work}/ck-q")
        return _rows(clean.read()), _rows(bad.read())
    assert run([("a", 1), ("b", -1), ("c", -2), ("d", 4)])[0] == [("a", 1), ("d", 4)]
    was = _files(clean)
    assert run([("b", 5)]) == ([("a", 1), ("b", 5), ("d", 4)], [("c", -2)])
    touched = {str(x) for x in clean.touched(_kv(spark, ("b", 5)))}
    assert {x for x, f in _files(clean).items() if was.get(x) != f} == touched


def test_registered_sources_reach_silver(spark):
    """Bronze rows of one feed of each kind, cast as registered before they are kept."""
    from strata.sources.schemas import LINEAGE, SOURCES
    work = scratch_dir(spark, "silver")
    stamp = dt.datetime(2024, 1, 1)

    def land(name, rows):
        spec = SOURCES[name]
        schema = StructType(spec.landing_schema.fields + LINEAGE.fields)
        full = [tuple(r.get(f.name) for f in spec.landing_schema.fields) + (stamp, "f") for r in rows]
        spark.createDataFrame(full, schema).write.parquet(f"{work}/{name}")
        return jobs.silver_source(spark, name, f"{work}/{name}", f"{work}/silver_{name}", f"{work}/c_{name}", buckets=4)

    def row(name, **values):
        return tuple(values.get(f.name) for f in SOURCES[name].schema.fields)

    land("inventory", [{"snapshot_id": "s1", "snapshot_date": "2024-01-02", "product_id": "p"},
                       {"snapshot_id": "s2", "snapshot_date": "2024-13-02", "product_id": "p"}])
    got = spark.read.parquet(f"{work}/silver_inventory").collect()
    assert [(r.snapshot_id, r.snapshot_date) for r in got] == [("s1", dt.date(2024, 1, 2))]
    bad = spark.read.parquet(f"{work}/silver_inventory_rejected").collect()
    assert [(r.snapshot_id, r.snapshot_date, r._rejected) for r in bad] == [("s2", None, {"snapshot_date": "2024-13-02"})]
    table = land("products", [{"product_id": "p1", "launch_date": "2024-01-03"}, {"product_id": "p2", "launch_date": "?"},
                              {"product_id": "p3"}])
    assert {r.product_id: r.launch_date for r in table.read().collect()} == {"p1": dt.date(2024, 1, 3), "p3": None}
    bad = spark.read.parquet(f"{work}/silver_products_rejected").collect()
    assert [(r.product_id, r._rejected) for r in bad] == [("p2", {"launch_date": "?"})]
    table = land("order_items", [
        {"op": "c", "ts_ms": 1, "after": row("order_items", order_item_id="i1", quantity=2)},
        {"op": "c", "ts_ms": 1, "after": row("order_items", order_item_id="i2", quantity=1)},
        {"op": "d", "ts_ms": 2, "before": row("order_items", order_item_id="i2")}])
    assert [(r.order_item_id, r.quantity) for r in table.read().collect()] == [("i1", 2)]
    table = land("orders", [
        {"op": "c", "ts_ms": 1000, "after": row("orders", order_id="o1", order_date="2024-02-01 10:00:00", total_amount=3.5)},
        {"op": "u", "ts_ms": 2000, "after": row("orders", order_id="o1", order_date="soon", total_amount=9.5)}])
    got = table.read().collect()
    assert [(r.order_date, r.valid_from, r.is_version) for r in got] == [
        (dt.datetime(2024, 2, 1, 10), dt.datetime(1970, 1, 1, 0, 0, 1), True)]
    assert [r._rejected for r in spark.read.parquet(f"{work}/silver_orders_rejected").collect()] == [{"order_date": "soon"}]


def test_images_are_told_by_the_marks_of_a_merge(spark, monkeypatch):
    """a marked merge logs its images from the rows it staged, and the
    table is overwritten from them as they lie; neither shuffles the table."""
    from strata.operators.dedup import latest_placed
    from strata.operators.scd import merge_actions
    from strata.streaming import tables
    t = KeyedTable(spark, scratch_dir(spark, "told"), KV, ["k"], 4, changes=scratch_dir(spark, "told-log"))
    t.create(_kv(spark, ("a", 1), ("b", 1), ("c", 1), (None, 1)))

    def never(*_):
        raise AssertionError("the whole table was compared")
    monkeypatch.setattr(tables, "signed_images", never)
    batch = spark.createDataFrame([("a", 2, "u"), ("b", 1, "u"), ("c", 1, "d"), ("d", 4, "c"), ("e", 0, "d")], "k string, v int, op string")
    latest = latest_placed(batch, ["k"], ["v", "op"], t.buckets)
    t.merge_batch(lambda prev, b: merge_actions(prev, b, ["k"], ["v"], "op", keep_old=True), latest, "q", 0, placed=True)
    assert {tuple(r) for r in t.read().collect()} == {("a", 2), ("b", 1), ("d", 4), (None, 1)}
    log = spark.read.parquet(t.changes).where("_query = 'q'")
    assert _rows(log.select("k", "v", "_w")) == [("a", 1, -1), ("a", 2, 1), ("c", 1, -1), ("d", 4, 1)]
    assert all(len(f) == 1 for f in _files(t).values())


def test_newest_rows_lie_where_a_table_wants_them(spark):
    """one shuffle, hot and NULL keys included."""
    from strata.operators.dedup import latest_per_key, latest_placed
    rows = spark.createDataFrame([("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 50}", i, i % 11) for i in range(2000)],
                                 "k string, v int, w int")
    placed = latest_placed(rows, ["k"], ["w"], 5)
    assert sorted(map(str, placed.collect())) == sorted(map(str, latest_per_key(rows, ["k"], ["w"]).collect()))
    wrong = placed.where(F.spark_partition_id() != F.pmod(F.hash("k"), F.lit(5)))
    assert placed.rdd.getNumPartitions() == 5 and wrong.isEmpty()


def test_a_large_feed_lands_in_more_files(spark, monkeypatch):
    """no task reads a fixed share of the feed."""
    from strata.streaming import catalog
    monkeypatch.setattr(catalog, "PART_ROWS", 10)
    df = spark.range(0, 100, 1, 1)
    work = scratch_dir(spark, "landing")
    rows, files = catalog._land_files(df, work, 4)
    assert (rows, files, spark.read.parquet(work).count()) == (100, 10, 100)
    assert catalog._share(files, 1, 4) == 3 and catalog._share(1, 1, 4) == 1 and catalog._buckets(1000) == 100


def test_replace_keys_by_equality_keeps_null_keys_apart(spark):
    tgt = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), (None, 1, 3), (None, 2, 4), ("c", None, 5)], "k string, l int, v int")
    keys = spark.createDataFrame([("b", 1), (None, 2), ("c", None)], "k string, l int")
    res = spark.createDataFrame([("b", 1, 20)], "k string, l int, v int")
    both = [sorted(map(str, incremental.replace_keys(tgt, res, keys, ["k", "l"], prune=p).collect())) for p in (False, True)]
    assert both[0] == both[1] and len(both[0]) == 3
