"""Change-data-capture helpers: flatten envelopes, classify against a target.

Classification is one left join of the (deduplicated) change batch against
the target's open rows plus a ``CASE`` -- not one join per bucket -- so the
batch is read and shuffled once whatever buckets the caller needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conform import epoch_millis_to_timestamp

# CDC operation codes (create, update, delete, snapshot read).
OP_CREATE, OP_UPDATE, OP_DELETE, OP_READ = "c", "u", "d", "r"


def flatten_cdc(df: DataFrame, key: str,
                keep: Sequence[str] = ("op", "ts_ms", "_ingested_at", "_source_file"),
                ts_name: str = "event_ts") -> DataFrame:
    """``after.*`` plus envelope metadata; the key also survives deletes.

    A delete carries ``after = NULL``; its key is taken from ``before`` so the
    delete can close the key's open row.  ``event_ts`` is ``ts_ms`` as a
    timestamp.
    """
    fields = df.schema["after"].dataType.fieldNames()
    cols = [F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}")).alias(key)]
    cols += [F.col(f"after.{c}").alias(c) for c in fields if c != key]
    cols += [F.col(c) for c in keep if c in df.columns]
    out = df.select(*cols)
    if "ts_ms" in out.columns:
        out = out.withColumn(ts_name, epoch_millis_to_timestamp("ts_ms"))
    return out


def normalize_ops(df: DataFrame, op_col: str = "op") -> DataFrame:
    """A snapshot read (``r``) is a create."""
    return df.withColumn(op_col, F.when(F.col(op_col) == OP_READ, F.lit(OP_CREATE))
                         .otherwise(F.col(op_col)))


def classify_changes(changes: DataFrame, target_open: DataFrame, key: str,
                     tracked: Sequence[str], op_col: str = "op") -> DataFrame:
    """Tag each change with ``action`` in {new, changed, noop, delete}.

    ``changes`` must hold at most one row per key (see ``latest_per_key``);
    ``target_open`` is the target's current rows.  Comparison of tracked
    columns is null-safe.  Output: the change row plus ``action``.
    """
    tgt = target_open.select(F.col(key).alias("_t_key"),
                             *[F.col(c).alias(f"_t_{c}") for c in tracked])
    joined = changes.join(tgt, F.col(key) == F.col("_t_key"), "left")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    action = (F.when(F.col(op_col) == OP_DELETE, F.lit("delete"))
              .when(F.col("_t_key").isNull(), F.lit("new"))
              .when(differs, F.lit("changed"))
              .otherwise(F.lit("noop")))
    return (joined.withColumn("action", action)
            .drop("_t_key", *[f"_t_{c}" for c in tracked]))
