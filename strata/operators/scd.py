"""SCD1 upserts and SCD2 validity history as joins (no row-level MERGE).

Parquet has no row-level update, so each operator returns the *next state*
of the table as a DataFrame; the streaming layer overwrites the touched
partitions with it (see ``strata.streaming.tables``).  The joins are equi-joins on the
business key; AQE broadcasts the change side at runtime when it measures
small and otherwise sort-merges, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import is_current, open_end
from ..session import checkpoint_root
from .cdc import OP_DELETE
from .dedup import latest_per_key
from .sequence import segment, with_next, with_previous
from .skew import frequent_keys


def _keys_equal(keys: Sequence[str], left: str, right: str):
    cond = None
    for k in keys:
        c = F.col(f"{left}.{k}") == F.col(f"{right}.{k}")
        cond = c if cond is None else cond & c
    return cond


def _touched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key occurs in the source (LEFT SEMI; AQE broadcasts
    the key set when it measures small)."""
    return target.join(source.select(*keys), list(keys), "left_semi")


def _full_outer(target: DataFrame, source: DataFrame, keys: Sequence[str]):
    t = target.select(*target.columns, F.lit(True).alias("_t"))
    s = source.select(*source.columns, F.lit(True).alias("_s"))
    return t.alias("t").join(s.alias("s"), _keys_equal(keys, "t", "s"), "full_outer")


ACTION, WAS = "_action", "_was"


def merge_actions(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  tracked: Sequence[str] | None = None, op_col: str | None = None,
                  apply_deletes: bool = True, newer_than: Sequence[str] | None = None,
                  keep_old: bool = False) -> DataFrame:
    """What a merge does to each row: the target's columns as they are
    afterwards, with ``_action``: ``insert``, ``update``, ``unchanged`` (a
    source row that changes nothing), ``delete`` (the row that goes) or
    ``copy`` (no source row).  One full outer join on the key.

    With ``tracked`` a matched row is updated only if one of those columns
    differs (NULL-safe); otherwise only if the source row is newer, by
    ``newer_than`` and the remaining columns.  With ``op_col`` a delete event
    removes its key, or is ignored without ``apply_deletes``.  A source row
    that is older than the target's by ``newer_than`` changes nothing.

    With ``keep_old`` an updated row has its old values in the struct ``_was``,
    NULL in all other rows.
    """
    src = source.select(*target.columns, *([op_col] if op_col else []))
    j = _full_outer(target, src, keys)
    t_here, s_here = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    is_delete = F.coalesce(F.col(f"s.{op_col}") == OP_DELETE, F.lit(False)) if op_col else F.lit(False)

    def struct(side: str, cols: Sequence[str]) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(f"_o{i}") for i, c in enumerate(cols)])
    if tracked is not None:
        differs = F.lit(False)
        for c in tracked:
            differs = differs | ~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
        late = struct("s", newer_than) < struct("t", newer_than) if newer_than else F.lit(False)
    else:
        rest = [c for c in target.columns if c not in keys and c not in (newer_than or ())]
        order = [*(newer_than or ()), *rest]
        differs, late = struct("s", order) > struct("t", order) if newer_than else F.lit(True), F.lit(False)
    action = (F.when(~s_here, "copy")
              .when(is_delete, F.when(t_here & ~late & F.lit(apply_deletes), "delete").when(t_here, "unchanged"))
              .when(~t_here, "insert").when(late | ~differs, "unchanged").otherwise("update"))
    take = F.col(ACTION).isin("insert", "update")
    was = F.when(F.col(ACTION) == "update", F.struct(*[F.col(f"t.{c}").alias(c) for c in target.columns])).alias(WAS)
    return (j.withColumn(ACTION, action).where(F.col(ACTION).isNotNull())
            .select(*[F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns],
                    ACTION, *([was] if keep_old else [])))


def merged(actions: DataFrame) -> DataFrame:
    """The table after a merge."""
    return actions.where(F.col(ACTION) != "delete").drop(ACTION)


def action_counts(actions: DataFrame) -> DataFrame:
    """``rows_inserted, rows_updated, rows_unchanged, rows_deleted, rows_copied``
    of a merge, from its rows: one pass over one column."""
    names = {"insert": "inserted", "update": "updated", "unchanged": "unchanged", "delete": "deleted", "copy": "copied"}
    return actions.agg(*[F.count_if(F.col(ACTION) == a).alias(f"rows_{n}") for a, n in names.items()])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           newer_than: Sequence[str] | None = None) -> DataFrame:
    """Upsert: source rows replace target rows of the same key.

    ``source`` holds at most one row per key and (at least) the target's
    columns.  Unconditional plan: target LEFT ANTI source-keys, UNION ALL
    source.  With ``newer_than`` (order columns, newest = greatest, remaining
    columns break ties) a source row wins only if it is newer than the
    target row, so the result does not depend on the order batches arrive in:
    one full outer join on the key.
    """
    src = source.select(*target.columns)
    if not newer_than:
        return target.join(src.select(*keys), list(keys), "left_anti").unionByName(src)
    return merged(merge_actions(target, src, keys, newer_than=newer_than))


def upsert_changed_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                        tracked: Sequence[str], op_col: str | None = None,
                        apply_deletes: bool = True,
                        newer_than: Sequence[str] | None = None) -> DataFrame:
    """Upsert that rewrites a row only when a tracked column changed.

    Unchanged matches keep the target row untouched (including lineage such
    as ``_ingested_at``).  With ``op_col`` given, delete events remove their
    key when ``apply_deletes`` is set and are ignored otherwise.  With
    ``newer_than`` (order columns) an event that is older than the target row
    is ignored, deletes included, so a late batch never undoes a newer one.

    One full outer join on the key.
    """
    return merged(merge_actions(target, source, keys, tracked, op_col, apply_deletes, newer_than))


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """``df`` as a table ``name`` bucketed and sorted by ``keys``, one file a
    bucket.  A merge into it (``upsert``, ``upsert_changed_only``,
    ``scd2_merge``) joins on the keys without shuffling or sorting the table:
    only the batch moves, to the table's buckets."""
    writer = (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet")
              .bucketBy(buckets, *keys).sortBy(*keys))
    (writer.option("path", path) if path else writer).saveAsTable(name)


def merge_metrics(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  tracked: Sequence[str], op_col: str | None = None) -> DataFrame:
    """What an upsert of ``source`` into ``target`` does: one row of counts
    ``rows_inserted, rows_updated, rows_unchanged, rows_deleted, rows_copied``."""
    sk = source.select(*keys, *tracked, *([op_col] if op_col else []))
    hit = _touched(target.select(*keys, *tracked), sk, keys).withColumn("_t", F.lit(True))
    j = sk.alias("s").join(hit.alias("t"), _keys_equal(keys, "s", "t"), "left")
    t_here = F.col("t._t").isNotNull()
    is_del = F.coalesce(F.col(f"s.{op_col}") == OP_DELETE, F.lit(False)) if op_col else F.lit(False)
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
    flags = j.select((~t_here & ~is_del).cast("long").alias("i"),
                     (t_here & ~is_del & differs).cast("long").alias("u"),
                     (t_here & ~is_del & ~differs).cast("long").alias("n"),
                     (t_here & is_del).cast("long").alias("d"),
                     t_here.cast("long").alias("m"), F.lit(0).cast("long").alias("t"))
    target_rows = target.select(*[F.lit(0).cast("long").alias(c) for c in "iundm"],
                                F.lit(1).cast("long").alias("t"))
    # one partially aggregated pass over batch flags + target row count
    return flags.unionByName(target_rows).agg(
        F.sum("i").alias("rows_inserted"), F.sum("u").alias("rows_updated"),
        F.sum("n").alias("rows_unchanged"), F.sum("d").alias("rows_deleted"),
        (F.sum("t") - F.sum("m")).alias("rows_copied"))


def change_metrics_by_batch(feed: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                            batch_col: str, order_cols: Sequence[str]) -> DataFrame:
    """Per batch of a change feed: rows inserted / updated / unchanged when the
    batches are upserted in ``batch_col`` order, computed in one pass.

    Each (key, batch) is first reduced to its newest row (partial aggregate),
    then compared with the key's row of the previous batch (``lag`` over at
    most one row per batch and key).
    """
    per_batch = latest_per_key(feed.select(*keys, batch_col, *order_cols,
                                           *[c for c in tracked if c not in order_cols]),
                               [*keys, batch_col], list(order_cols))
    w = Window.partitionBy(*keys).orderBy(batch_col)
    prev = per_batch.select(
        batch_col,
        F.lag(F.lit(1)).over(w).isNotNull().alias("_had_prev"),
        *[F.col(c).alias(c) for c in tracked],
        *[F.lag(c).over(w).alias(f"_p_{c}") for c in tracked])
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_p_{c}"))
    return prev.groupBy(batch_col).agg(
        F.count_if(~F.col("_had_prev")).alias("rows_inserted"),
        F.count_if(F.col("_had_prev") & differs).alias("rows_updated"),
        F.count_if(F.col("_had_prev") & ~differs).alias("rows_unchanged"))


def scd2_apply(target: DataFrame, batch: DataFrame, key: str, tracked: Sequence[str],
               ts_col: str = "event_ts", op_col: str = "op",
               valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Next state of an SCD2 table after one change batch.

    * the batch is reduced to the newest event per key (total order);
    * delete: closes the key's open row at the event time;
    * new key (no open row): opens a version;
    * changed tracked columns: closes the open row and opens a new one;
    * no change: nothing;
    * an event not newer than the open row's ``valid_from``, or older than the
      end of the key's newest closed row (a late event after a delete), is
      ignored (no inverted or overlapping interval; a replayed batch is a
      no-op); ``scd2_merge`` is the operator that places late events;
    * replay guard: a version whose (key, valid_from) already exists is not
      inserted again.

    ``batch`` carries the target's payload columns plus ``op_col`` and
    ``ts_col``.  Output has the target's columns.
    """
    vt_type = target.schema[valid_to].dataType.typeName()
    like = {"timestamp_ntz": "timestamp_ntz", "date": "date"}.get(vt_type, "timestamp")
    payload = [c for c in target.columns if c not in (valid_from, valid_to)]
    latest = latest_per_key(batch.select(*payload, op_col, ts_col), [key], [ts_col, op_col])
    # one row a key: its open row, and the end of its newest closed one
    here = _touched(target, latest, [key])
    is_open = is_current(target, valid_to)
    known = here.groupBy(F.col(key).alias("_t_key")).agg(
        F.max(F.when(is_open, F.struct(F.col(valid_from).alias("_from"), *tracked))).alias("_open"),
        F.max(F.when(~is_open, F.col(valid_to))).alias("_ended"))
    open_rows = known.select("_t_key", "_ended", F.col("_open").isNotNull().alias("_has_open"),
                             F.col("_open._from").alias("_t_from"),
                             *[F.col(f"_open.{c}").alias(f"_t_{c}") for c in tracked])
    j = latest.join(open_rows, F.col(key) == F.col("_t_key"), "left")
    ts = F.col(ts_col).cast(target.schema[valid_from].dataType)
    has_open = F.coalesce("_has_open", F.lit(False))
    late = F.coalesce(F.when(has_open, ts <= F.col("_t_from")).otherwise(ts < F.col("_ended")), F.lit(False))
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    is_del = F.col(op_col) == OP_DELETE
    action = (F.when(late, "late")
              .when(is_del & has_open, "delete")
              .when(is_del, "noop")
              .when(~has_open, "new")
              .when(differs, "changed")
              .otherwise("noop"))
    acted = j.withColumn("_action", action).filter(F.col("_action").isin("delete", "changed", "new"))
    retire = acted.filter(F.col("_action").isin("delete", "changed")).select(
        F.col(key).alias("_r_key"), F.col("_t_from").alias("_r_from"), ts.alias("_r_to"))
    inserts = acted.filter(F.col("_action").isin("new", "changed")).select(
        *payload, ts.alias(valid_from), open_end(like).alias(valid_to))
    # versions already present for the batch's keys (a superset of the
    # inserted keys; independent of the decision join, so it is not re-run)
    existing = _touched(target.select(key, valid_from), latest, [key])
    inserts = inserts.join(existing, [key, valid_from], "left_anti")
    retired = (target.join(retire, (F.col(key) == F.col("_r_key"))
                           & (F.col(valid_from) == F.col("_r_from"))
                           & is_current(target, valid_to), "left")
               .withColumn(valid_to, F.coalesce(F.col("_r_to"), F.col(valid_to)))
               .select(*target.columns))
    return retired.unionByName(inserts.select(*target.columns))


def scd2_from_changelog(events: DataFrame, key: str, tracked: Sequence[str],
                        ts_col: str = "event_ts", op_col: str = "op",
                        valid_from: str = "valid_from", valid_to: str = "valid_to",
                        end_like: str = "timestamp", segments: int | None = None) -> DataFrame:
    """Full validity history from a complete change log (all versions).

    Events tied on (key, ts) keep one winner (same total order as
    ``scd2_apply``: op, then tracked columns, greatest wins).  A create or
    update opens a version when its tracked values differ from the previous
    event or the previous event was a delete; no-op updates are dropped; a
    version ends at the next kept event (change or delete) of the key, else
    stays open.  Deletes open nothing.

    Previous/next lookups are skew-safe (``strata.operators.sequence``): a
    key's history is split over range segments, never sorted in one task.
    """
    kept = _opened(events.select(key, op_col, ts_col, *tracked), key, tracked, ts_col, op_col, segments)
    return (_ended(kept.filter(F.col("_opens") | (F.col(op_col) == OP_DELETE)), key, ts_col, op_col, end_like)
            .filter(F.col("_opens"))
            .select(key, *tracked, F.col(ts_col).alias(valid_from), F.col("_end").alias(valid_to)))


def _opened(events: DataFrame, key: str, tracked: Sequence[str], ts_col: str, op_col: str,
            segments: int | None) -> DataFrame:
    """One event per (key, ts) with ``_opens``: whether it opens a version."""
    ev = latest_per_key(events, [key, ts_col], [op_col, *tracked])
    p = with_previous(segment(ev, [key], [ts_col], segments), [key], [ts_col], [op_col, *tracked])
    return p.withColumn("_opens", _opens(op_col, tracked))


def _opens(op_col: str, tracked: Sequence[str]) -> Column:
    """Whether an event opens a version, from its columns and those of its
    key's previous one (``_has_prev``, ``_prev_<column>``)."""
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_prev_{c}"))
    return (F.col(op_col) != OP_DELETE) & (
        ~F.col("_has_prev") | (F.col(f"_prev_{op_col}") == OP_DELETE) | differs)


def _ended(kept: DataFrame, key: str, ts_col: str, op_col: str, end_like: str) -> DataFrame:
    """``kept`` (events that open a version, and deletes) with ``_end``, the
    time of the key's next one or the open end."""
    return with_next(kept, [key], [ts_col], ts_col, "_next").withColumn(
        "_end", F.coalesce(F.col("_next"), open_end(end_like)))


# ------------------------------------------------- history of late events --
IS_VERSION = "is_version"


def scd2_history(events: DataFrame, key: str, tracked: Sequence[str], carried: Sequence[str] = (),
                 ts_col: str = "event_ts", op_col: str = "op", valid_from: str = "valid_from",
                 valid_to: str = "valid_to", end_like: str = "timestamp",
                 segments: int | None = None) -> DataFrame:
    """A history that later events of any age can be merged into: one row per
    (key, ts) of ``events``, in which ``is_version`` marks the rows of the
    SCD2 table and the others keep what the table can't tell, the events that
    changed nothing and the deletes.  ``versions`` of it equals
    ``scd2_from_changelog``.  Events without a key or a time are left out.

    Columns: key, tracked, carried (kept, not compared), op, valid_from,
    valid_to (NULL where no version starts), is_version.
    """
    rows = events.select(key, op_col, ts_col, *tracked, *carried).where(
        F.col(key).isNotNull() & F.col(ts_col).isNotNull())
    opened = _opened(rows, key, tracked, ts_col, op_col, segments)
    keeps = F.col("_opens") | (F.col(op_col) == OP_DELETE)
    out = [key, *tracked, *carried, op_col, F.col(ts_col).alias(valid_from)]
    end = F.when(F.col("_opens"), F.col("_end"))
    kept = _ended(opened.filter(keeps), key, ts_col, op_col, end_like)
    kept = kept.select(*out, end.alias(valid_to), F.col("_opens").alias(IS_VERSION))
    idle = opened.filter(~keeps).select(*out, F.lit(None).cast(kept.schema[valid_to].dataType).alias(valid_to),
                                        F.lit(False).alias(IS_VERSION))
    return kept.unionByName(idle)


def versions(history: DataFrame, op_col: str = "op") -> DataFrame:
    """The SCD2 table in a history: its versions, each once."""
    return history.where(IS_VERSION).drop(IS_VERSION, op_col)


#: Events of a key that one task sorts without harm, whatever their share of all.
HEAVY_ROWS = 100_000


def scd2_merge(history: DataFrame, batch: DataFrame, key: str, tracked: Sequence[str],
               carried: Sequence[str] = (), ts_col: str = "event_ts", op_col: str = "op",
               valid_from: str = "valid_from", valid_to: str = "valid_to",
               segments: int | None = None, parts: int | None = None, keep_old: bool = False) -> DataFrame:
    """``history`` after a batch of any number of events per key, of any age.

    A late event splits the interval it falls into, an update that a late one
    contradicts becomes a change, and so on: the result is the history of all
    events ever merged, whatever the batches and their order, so a batch that
    is delivered again changes nothing.

    Only the affected end of a key is derived again: the rows from its last
    version before the batch's first event of that key on.  What an event
    opens or ends depends on its neighbours alone, and that version, which
    the batch precedes nowhere, opens whatever follows.  All other rows pass
    through.

    History and events are dealt by key in one shuffle, to the partitions of
    ``repartition(parts, key)`` if ``parts`` is given, and stay there.  Only
    the keys that hold a large part of all rows, and ``HEAVY_ROWS`` at least,
    are rebuilt over range segments like ``scd2_from_changelog``.

    With ``keep_old`` the rows have ``_action`` and ``_was`` like those of
    ``merge_actions``; a row that goes is marked ``delete``.
    """
    ts_type = history.schema[valid_from].dataType
    end_like = {"timestamp_ntz": "timestamp_ntz", "date": "date"}.get(ts_type.typeName(), "timestamp")
    values = [*tracked, *carried]
    events = batch.select(key, *values, op_col, F.col(ts_col).cast(ts_type).alias(valid_from)).where(
        F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    columns = (key, tracked, carried, op_col, valid_from, valid_to)
    heavy = _heavy(history.select(key).unionByName(events.select(key)), key)
    if heavy is None:
        return _merged_by_key(history, events, *columns, end_like, parts, keep_old)
    light, hot = ([rows.join(F.broadcast(heavy), key, how) for rows in (history, events)] for how in ("left_anti", "left_semi"))
    dealt = _merged_by_segments(*hot, *columns, end_like, segments, keep_old)
    return _merged_by_key(*light, *columns, end_like, parts, keep_old).unionByName(
        dealt if parts is None else dealt.repartition(parts, key))


def _heavy(rows: DataFrame, key: str) -> DataFrame | None:
    """The keys that hold a large part of ``rows`` (``skew.frequent_keys``)
    and ``HEAVY_ROWS`` of them, or None if there are none."""
    few = F.broadcast(frequent_keys(rows, key).distinct())
    checkpoint_root(rows.sparkSession)
    heavy = rows.join(few, key).groupBy(key).count().where(F.col("count") >= HEAVY_ROWS).select(key).checkpoint()
    return None if heavy.isEmpty() else heavy


def _merged_by_key(history: DataFrame, events: DataFrame, key: str, tracked: Sequence[str], carried: Sequence[str],
                   op_col: str, valid_from: str, valid_to: str, end_like: str, parts: int | None,
                   keep_old: bool) -> DataFrame:
    """``scd2_merge`` of keys that a task can hold: one shuffle by key, then
    one row per (key, time) and windows over the key's rows."""
    values, kept = [op_col, *tracked, *carried], [valid_to, IS_VERSION]
    late = events.select(key, valid_from, *values, *[F.lit(None).cast(history.schema[c].dataType).alias(c) for c in kept],
                         F.lit(True).alias("_new"))
    rows = history.select(key, valid_from, *values, *kept, F.lit(False).alias("_new")).unionByName(late)
    rows = rows.repartition(key) if parts is None else rows.repartition(parts, key)
    was = F.when(~F.col("_new"), F.struct(*kept, *(values if keep_old else [])))
    rows = rows.groupBy(key, valid_from).agg(F.max(F.struct(*values)).alias("_best"), F.max(was).alias("_old"),
                                             F.max("_new").alias("_new"))
    rows = rows.select(key, valid_from, *[F.col(f"_best.{c}").alias(c) for c in values], "_old", "_new")

    time, of_key = F.col(valid_from), Window.partitionBy(key)
    rows = rows.withColumn("_first", F.min(F.when(F.col("_new"), time)).over(of_key))
    rows = rows.withColumn("_start", F.max(F.when(F.col(f"_old.{IS_VERSION}") & (time < F.col("_first")), time)).over(of_key))
    rows = rows.withColumn("_again", F.coalesce(
        F.col("_first").isNotNull() & (F.col("_start").isNull() | (time >= F.col("_start"))), F.lit(False)))
    before = of_key.orderBy(valid_from)
    rows = rows.withColumns({"_has_prev": F.coalesce(F.lag("_again").over(before), F.lit(False)),
                             **{f"_prev_{c}": F.lag(c).over(before) for c in (op_col, *tracked)}})
    rows = rows.withColumn("_opens", _opens(op_col, tracked))
    rows = rows.withColumn("_keeps", F.col("_opens") | (F.col(op_col) == OP_DELETE))
    after = of_key.orderBy(F.desc(valid_from)).rowsBetween(Window.unboundedPreceding, -1)
    end = F.coalesce(F.min(F.when(F.col("_keeps"), time)).over(after), open_end(end_like))
    rows = rows.withColumn("_end", end)

    again, old = F.col("_again"), F.col("_old")
    fresh = {valid_to: F.when(F.col("_opens"), F.col("_end")), IS_VERSION: F.col("_opens")}
    now = rows.withColumns({c: F.when(again, fresh[c]).otherwise(old[c]) for c in kept})
    gone = again & F.col("_keeps").isNull()        # an event without an operation opens and ends nothing
    if not keep_old:
        return now.where(~gone).select(*history.columns)
    had = F.struct(*[F.col(c) if c in (key, valid_from) else old[c].alias(c) for c in history.columns])
    now = now.where(~gone | old.isNotNull()).withColumns({
        ACTION: _history_action(again, gone, old.isNotNull(), F.struct(*history.columns).eqNullSafe(had)), WAS: had})
    return now.select(*[F.when(F.col(ACTION) == "delete", F.col(f"{WAS}.{c}")).otherwise(F.col(c)).alias(c)
                        for c in history.columns], ACTION, F.when(F.col(ACTION) == "update", F.col(WAS)).alias(WAS))


def _history_action(again: Column, gone: Column, here: Column, same: Column) -> Column:
    """What a merge does to a row of a history (see ``merge_actions``)."""
    return (F.when(~again, "copy").when(gone, "delete").when(~here, "insert").when(same, "unchanged").otherwise("update"))


def _merged_by_segments(history: DataFrame, events: DataFrame, key: str, tracked: Sequence[str], carried: Sequence[str],
                        op_col: str, valid_from: str, valid_to: str, end_like: str, segments: int | None,
                        keep_old: bool) -> DataFrame:
    """``scd2_merge`` of keys that no task should hold whole: the rebuild is
    split over range segments like ``scd2_from_changelog``; the joins are
    equi-joins on the key against one row a key of the batch."""
    first = events.groupBy(key).agg(F.min(valid_from).alias("_first"))
    before = F.col(IS_VERSION) & (F.col(valid_from) < F.col("_first"))
    start = (history.select(key, valid_from, IS_VERSION).join(first, key).where(before)
             .groupBy(key).agg(F.max(valid_from).alias("_start")))
    bounds = first.join(start, key, "left").select(key, F.lit(True).alias("_touched"), "_start")
    marked = history.join(bounds, key, "left")
    again = F.col("_touched").isNotNull() & (F.col("_start").isNull() | (F.col(valid_from) >= F.col("_start")))
    old = marked.where(again).select(*history.columns)
    rebuilt = scd2_history(old.select(*events.columns).unionByName(events), key, tracked, carried,
                           valid_from, op_col, valid_from, valid_to, end_like, segments).select(*history.columns)
    kept = marked.where(~again).select(*history.columns)
    if not keep_old:
        return kept.unionByName(rebuilt)
    kept = kept.withColumns({ACTION: F.lit("copy"), WAS: F.lit(None).cast(history.schema)})
    o, n = old.select(F.struct(*history.columns).alias("o")), rebuilt.select(F.struct(*history.columns).alias("n"))
    both = o.join(n, (F.col(f"o.{key}") == F.col(f"n.{key}")) & (F.col(f"o.{valid_from}") == F.col(f"n.{valid_from}")), "full_outer")
    both = both.withColumn(ACTION, _history_action(F.lit(True), F.col("n").isNull(), F.col("o").isNotNull(),
                                                   F.col("n").eqNullSafe(F.col("o"))))
    return kept.unionByName(both.select(F.coalesce("n", "o").alias("r"), ACTION, F.when(F.col(ACTION) == "update", F.col("o")).alias(WAS))
                            .select("r.*", ACTION, WAS))
