"""CDC flatten/classify, SCD1 upserts and SCD2 history (hand cases + model)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import cdc, scd
from strata.sources.schemas import ORDERS_ROW, envelope_schema

OPEN = dt.datetime(9999, 12, 31)
T = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
TGT = "pk string, a string, b string, valid_from timestamp, valid_to timestamp"
EV = "pk string, a string, b string, op string, event_ts timestamp"


def _sort(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def _state(df):
    return _sort((r.pk, r.a, r.b, r.valid_from, r.valid_to) for r in df.collect())


def test_flatten_delete_keeps_key_and_closes_row(spark):
    env = spark.read.schema(envelope_schema(ORDERS_ROW)).json(spark.sparkContext.parallelize(
        ['{"op":"d","ts_ms":1700000000999,"before":{"order_id":"O1"},"after":null}']))
    flat = cdc.flatten_cdc(env, "order_id")
    row = flat.collect()[0]
    assert row.order_id == "O1" and row.op == "d" and row.customer_id is None
    assert row.event_ts == dt.datetime(2023, 11, 14, 22, 13, 20, 999000)
    start = dt.datetime(2023, 1, 1)
    tgt = spark.createDataFrame([("O1", "x", "y", start, OPEN)], TGT)
    batch = flat.select(F.col("order_id").alias("pk"), F.lit(None).cast("string").alias("a"),
                        F.lit(None).cast("string").alias("b"), "op", "event_ts")
    assert _state(scd.scd2_apply(tgt, batch, "pk", ["a", "b"])) == [
        ("O1", "x", "y", start, row.event_ts)]


def test_scd2_apply_cases(spark):
    tgt = spark.createDataFrame([
        ("noop", "1", "1", T(0), OPEN), ("n2v", None, "1", T(0), OPEN),
        ("v2n", "1", "1", T(0), OPEN), ("late", "1", "1", T(50), OPEN),
        ("twice", "1", "1", T(0), OPEN), ("gone", "1", "1", T(0), T(5))], TGT)
    batch = spark.createDataFrame([
        ("noop", "1", "1", "u", T(10)), ("n2v", "2", "1", "u", T(10)),
        ("v2n", None, "1", "u", T(10)), ("late", "9", "9", "u", T(20)),
        ("twice", "2", "1", "u", T(1)), ("twice", "3", "1", "u", T(2)),
        ("gone", "1", "1", "c", T(30)), ("fresh", "1", None, "r", T(7))], EV)
    batch = cdc.normalize_ops(batch)
    got = _state(scd.scd2_apply(tgt, batch, "pk", ["a", "b"]))
    assert got == _sort([
        ("noop", "1", "1", T(0), OPEN),
        ("n2v", None, "1", T(0), T(10)), ("n2v", "2", "1", T(10), OPEN),
        ("v2n", "1", "1", T(0), T(10)), ("v2n", None, "1", T(10), OPEN),
        ("late", "1", "1", T(50), OPEN),                        # rejected, no inversion
        ("twice", "1", "1", T(0), T(2)), ("twice", "3", "1", T(2), OPEN),  # newest only
        ("gone", "1", "1", T(0), T(5)), ("gone", "1", "1", T(30), OPEN),   # re-create, gap kept
        ("fresh", "1", None, T(7), OPEN)])
    # replay: applying the same batch again changes nothing
    once = scd.scd2_apply(tgt, batch, "pk", ["a", "b"])
    assert _state(scd.scd2_apply(once, batch, "pk", ["a", "b"])) == got


def test_untracked_column_change_opens_no_version(spark):
    tgt = spark.createDataFrame([("k", "1", "u1", T(0), OPEN)], TGT)
    batch = spark.createDataFrame([("k", "1", "u2", "u", T(5))], EV)
    assert _state(scd.scd2_apply(tgt, batch, "pk", ["a"])) == [("k", "1", "u1", T(0), OPEN)]
    assert len(_state(scd.scd2_apply(tgt, batch, "pk", ["a", "b"]))) == 2


def test_changelog_keeps_all_versions(spark):
    ev = spark.createDataFrame([("k", "1", "x", "c", T(1)), ("k", "2", "x", "u", T(2)),
                                ("k", "2", "x", "u", T(3)), ("k", None, None, "d", T(4)),
                                ("k", "2", "x", "c", T(6))], EV)
    got = _state(scd.scd2_from_changelog(ev, "pk", ["a", "b"]))
    assert got == [("k", "1", "x", T(1), T(2)), ("k", "2", "x", T(2), T(4)),
                   ("k", "2", "x", T(6), OPEN)]


def _model(events):
    """Plain-Python SCD2 over a complete log (ties: greatest (op, a, b) wins)."""
    out = []
    for key in sorted({e[0] for e in events}):
        evs = {}
        for e in events:
            if e[0] == key:
                k = e[4]
                cand = (e[3], e[1] or "", e[2] or "", e[1] is not None, e[2] is not None)
                if k not in evs or _rank(e) > _rank(evs[k]):
                    evs[k] = e
        cur = None
        for ts in sorted(evs):
            _, a, b, op, _ = evs[ts]
            if op == "d":
                if cur:
                    out.append((key, cur[0], cur[1], cur[2], ts)); cur = None
            elif cur is None:
                cur = (a, b, ts)
            elif (a, b) != (cur[0], cur[1]):
                out.append((key, cur[0], cur[1], cur[2], ts)); cur = (a, b, ts)
        if cur:
            out.append((key, cur[0], cur[1], cur[2], OPEN))
    return _sort(out)


def _rank(e):
    def k(x):
        return (x is not None, x or "")
    return (k(e[3]), k(e[1]), k(e[2]))


EVENTS = st.lists(st.tuples(st.sampled_from("pq"), st.one_of(st.none(), st.sampled_from("12")),
                            st.sampled_from("xy"), st.sampled_from("cud"),
                            st.integers(0, 6).map(T)), max_size=20)


@settings(max_examples=20, deadline=None, derandomize=True)
@given(EVENTS)
def test_changelog_matches_model(spark, events):
    events = [(k, None if op == "d" else a, None if op == "d" else b, op, ts)
              for k, a, b, op, ts in events]
    df = spark.createDataFrame(events, EV)
    assert _state(scd.scd2_from_changelog(df, "pk", ["a", "b"])) == _model(events)


@settings(max_examples=10, deadline=None, derandomize=True)
@given(EVENTS)
def test_apply_per_timestamp_equals_changelog(spark, events):
    """Applying one batch per distinct timestamp, in time order, builds the
    same history as the changelog operator."""
    events = [(k, None if op == "d" else a, None if op == "d" else b, op, ts)
              for k, a, b, op, ts in events]
    df = spark.createDataFrame(events, EV)
    state = spark.createDataFrame([], TGT)
    for ts in sorted({e[4] for e in events}):
        state = scd.scd2_apply(state, df.filter(F.col("event_ts") == F.lit(ts)), "pk", ["a", "b"])
        state = spark.createDataFrame(state.collect(), TGT)   # keep plans small
    assert _state(state) == _model(events)


HISTORY = ("pk string, a string, b string, op string, valid_from timestamp, valid_to timestamp, "
           "is_version boolean")


@settings(max_examples=15, deadline=None, derandomize=True)
@given(EVENTS, st.lists(st.integers(0, 2), min_size=20, max_size=20))
def test_merge_of_shuffled_batches_matches_model(spark, events, wave):
    """Events in three batches, whatever their order, several of a key in one
    batch, and one batch twice: always the history of the whole log."""
    events = [(k, None if op == "d" else a, None if op == "d" else b, op, ts)
              for k, a, b, op, ts in events]
    state = spark.createDataFrame([], HISTORY)
    for n in (0, 1, 2, 1):
        batch = [e for e, w in zip(events, wave, strict=False) if w == n]
        state = scd.scd2_merge(state, spark.createDataFrame(batch, EV), "pk", ["a", "b"])
        state = spark.createDataFrame(state.collect(), HISTORY)   # keep plans small
    assert _state(scd.versions(state)) == _model(events)
    assert state.groupBy("pk", "valid_from").count().where("count > 1").isEmpty()


def test_merge_splits_closed_intervals_and_keeps_idle_events(spark):
    """A late event into a closed interval; a late change before an update that
    had changed nothing; a late create before a delete that had ended nothing."""
    batches = [[("k", "1", "x", "c", T(10)), ("k", "3", "x", "u", T(30)), ("k", "3", "x", "u", T(40)),
                ("gone", None, None, "d", T(20))],
               [("k", "2", "x", "u", T(20)), ("k", "9", "x", "u", T(35)), ("gone", "1", "x", "c", T(5)),
                (None, "1", "x", "c", T(1)), ("k", "1", "x", "u", None)]]
    state = spark.createDataFrame([], HISTORY)
    for rows in batches:
        state = scd.scd2_merge(state, spark.createDataFrame(rows, EV), "pk", ["a", "b"])
    assert _state(scd.versions(state)) == _sort([
        ("k", "1", "x", T(10), T(20)), ("k", "2", "x", T(20), T(30)), ("k", "3", "x", T(30), T(35)),
        ("k", "9", "x", T(35), T(40)), ("k", "3", "x", T(40), OPEN), ("gone", "1", "x", T(5), T(20))])


def test_merge_rebuilds_the_affected_end_only(spark):
    """Rows before the last version that a batch can't affect pass through as they are."""
    rows = [("k", str(i), "x", "u", T(i)) for i in range(50)] + [("other", "1", "x", "c", T(3))]
    state = scd.scd2_merge(spark.createDataFrame([], HISTORY), spark.createDataFrame(rows, EV), "pk", ["a", "b"])
    marked = state.withColumn("b", F.when(F.col("valid_from") < F.lit(T(45)), "kept").otherwise(F.col("b")))
    after = scd.scd2_merge(marked, spark.createDataFrame([("k", "z", "x", "u", T(47))], EV), "pk", ["a"], ["b"])
    got = {r.valid_from: (r.a, r.b) for r in after.where("pk = 'k'").collect()}
    assert got[T(44)] == ("44", "kept") and got[T(47)] == ("z", "x") and len(got) == 50
    assert after.where("pk = 'other'").first().b == "kept"


def test_upsert_modes(spark):
    tgt = spark.createDataFrame([("k1", "a", 1), ("k2", "b", 1), ("k3", "c", 1)],
                                "k string, v string, ing int")
    src = spark.createDataFrame([("k1", "a", 2, "u"), ("k2", "B", 2, "u"), ("k3", None, 2, "d"),
                                 ("k4", "d", 2, "c")], "k string, v string, ing int, op string")
    plain = {tuple(r) for r in scd.upsert(tgt, src, ["k"]).collect()}
    assert plain == {("k1", "a", 2), ("k2", "B", 2), ("k3", None, 2), ("k4", "d", 2)}
    changed = {tuple(r) for r in scd.upsert_changed_only(tgt, src, ["k"], ["v"], "op").collect()}
    # unchanged k1 keeps its old lineage value; k3 deleted
    assert changed == {("k1", "a", 1), ("k2", "B", 2), ("k4", "d", 2)}
    m = scd.merge_metrics(tgt, src, ["k"], ["v"], "op").collect()[0]
    assert (m.rows_inserted, m.rows_updated, m.rows_unchanged, m.rows_deleted, m.rows_copied) == (1, 1, 1, 1, 0)


def test_upsert_newer_than_is_order_independent(spark):
    tgt = spark.createDataFrame([("k", 5, "new")], "k string, ts int, v string")
    old = spark.createDataFrame([("k", 3, "old")], "k string, ts int, v string")
    assert [tuple(r) for r in scd.upsert(tgt, old, ["k"], newer_than=["ts"]).collect()] == [("k", 5, "new")]


def test_classify_buckets(spark):
    tgt = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "pk string, v string")
    ch = spark.createDataFrame([("a", "1", "u"), ("b", "2", "u"), ("c", None, "d"), ("d", "1", "c")],
                               "pk string, v string, op string")
    got = {r.pk: r.action for r in cdc.classify_changes(ch, tgt, "pk", ["v"]).collect()}
    assert got == {"a": "noop", "b": "changed", "c": "delete", "d": "new"}


def test_changelog_hot_key_split_across_segments(spark):
    """One key holding most events is cut into several range segments; the
    stitched history equals the plain-Python model."""
    from strata.operators.sequence import SEG, segment
    vals = ["1", "1", "2", "2", "3", None, "3", "4"]
    events = [("hot", vals[i % 8], "x", "d" if i % 37 == 36 else "u", T(i)) for i in range(300)]
    events = [(k, None if op == "d" else a, None if op == "d" else b, op, ts)
              for k, a, b, op, ts in events] + [("cold", "1", "x", "c", T(5))]
    df = spark.createDataFrame(events, EV)
    segs = segment(df, ["pk"], ["event_ts"], 7).filter(F.col("pk") == "hot")
    assert segs.select(SEG).distinct().count() >= 5
    got = _state(scd.scd2_from_changelog(df, "pk", ["a", "b"], segments=7))
    assert got == _model(events)


def test_late_event_after_delete_is_ignored(spark):
    """create day 5, delete day 10, late update day 3: no row opens, nothing overlaps."""
    schema = "pk string, a string, valid_from timestamp, valid_to timestamp"
    empty = spark.createDataFrame([], schema)
    ev = "pk string, a string, op string, event_ts timestamp"
    state = empty
    for row in [("k", "1", "c", T(5)), ("k", None, "d", T(10)), ("k", "0", "u", T(3))]:
        state = scd.scd2_apply(state, spark.createDataFrame([row], ev), "pk", ["a"])
    assert [(r.valid_from, r.valid_to) for r in state.collect()] == [(T(5), T(10))]
    state = scd.scd2_apply(state, spark.createDataFrame([("k", "2", "c", T(10))], ev), "pk", ["a"])
    assert state.count() == 2


def test_changed_only_ignores_older_events(spark):
    tgt = spark.createDataFrame([("k", 5, "new")], "k string, ts int, v string")
    src = spark.createDataFrame([("k", 3, "old", "u")], "k string, ts int, v string, op string")
    got = scd.upsert_changed_only(tgt, src, ["k"], ["v"], "op", newer_than=["ts"]).collect()
    assert [tuple(r) for r in got] == [("k", 5, "new")]
    gone = spark.createDataFrame([("k", 3, None, "d")], "k string, ts int, v string, op string")
    assert scd.upsert_changed_only(tgt, gone, ["k"], ["v"], "op", newer_than=["ts"]).count() == 1
