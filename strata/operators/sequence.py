"""Skew-safe previous/next-row lookups within a key, ordered by time.

``lag``/``lead`` over ``Window.partitionBy(key)`` sorts each key's whole
history in one task, so a key holding a third of all rows becomes a single
straggler task.  Here rows are first range-partitioned on (key, order):
the range partitioner samples the data and cuts it into ``segments``
contiguous, similarly sized ranges, which splits a hot key's history across
tasks.  Windows then run per (key, segment); the first/last row of each
segment takes its neighbour from a small per-segment summary (one row per
key and segment), carried across segments with a window over that summary.

Data shuffles: one range exchange (plus its sampling pass) and one hash
exchange on (key, segment); everything else moves summary rows only.

The segmented rows are materialised once with a reliable ``checkpoint()``
(into the session's ``spark.checkpoint.dir``): the per-row windows and the
per-segment summary then read the *same* segment assignment, which a second
range exchange (its own sample) would not guarantee, and executor loss
recomputes nothing upstream.  Keys must be non-NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

SEG = "_seg"


def segment(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
            segments: int | None = None) -> DataFrame:
    """Range-partition on (keys, order) and tag each row with its segment."""
    if segments is None:
        spark = SparkSession.getActiveSession()
        segments = int(spark.conf.get("spark.sql.shuffle.partitions")) if spark else 200
    checkpoint_root(df.sparkSession)        # fails loudly if no shared dir is set
    return (df.repartitionByRange(segments, *keys, *order_cols)
            .withColumn(SEG, F.spark_partition_id())
            .checkpoint(eager=True))


def with_previous(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                  cols: Sequence[str], prefix: str = "_prev_",
                  flag: str = "_has_prev") -> DataFrame:
    """Add ``<prefix><c>`` = value of ``c`` in the previous row of the same key
    and ``flag`` = whether such a row exists.  ``df`` must carry ``_seg``."""
    w = Window.partitionBy(*keys, SEG).orderBy(*order_cols)
    local = df.withColumns({
        "_lp": F.lag(F.lit(True)).over(w).isNotNull(),
        **{f"_l_{c}": F.lag(c).over(w) for c in cols}})
    last = df.groupBy(*keys, SEG).agg(
        F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                       *[F.col(c).alias(f"_v_{c}") for c in cols])).alias("_last"))
    carry = last.select(*keys, SEG, F.lag("_last").over(
        Window.partitionBy(*keys).orderBy(SEG)).alias("_carry"))
    joined = local.join(carry, [*keys, SEG], "left")
    out = joined.withColumns({
        flag: F.col("_lp") | F.col("_carry").isNotNull(),
        **{f"{prefix}{c}": F.when(F.col("_lp"), F.col(f"_l_{c}"))
           .otherwise(F.col(f"_carry._v_{c}")) for c in cols}})
    return out.drop("_lp", "_carry", *[f"_l_{c}" for c in cols])


def with_next(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], col: str,
              out: str) -> DataFrame:
    """Add ``out`` = value of ``col`` in the next row of the same key (NULL for
    the last row).  ``df`` must carry ``_seg``."""
    w = Window.partitionBy(*keys, SEG).orderBy(*order_cols)
    local = df.withColumns({"_ln": F.lead(F.lit(True)).over(w).isNotNull(),
                            "_lv": F.lead(col).over(w)})
    first = df.groupBy(*keys, SEG).agg(
        F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                       F.col(col).alias("_v"))).alias("_first"))
    carry = first.select(*keys, SEG, F.lead("_first").over(
        Window.partitionBy(*keys).orderBy(SEG)).alias("_carry"))
    joined = local.join(carry, [*keys, SEG], "left")
    return (joined.withColumn(out, F.when(F.col("_ln"), F.col("_lv"))
                              .otherwise(F.col("_carry._v")))
            .drop("_ln", "_lv", "_carry"))
