"""Joins that a few heavy keys cannot pull into one task.

A key is heavy when it holds at least one in ``PARTS`` of all rows, so there
are at most ``PARTS`` heavy keys whatever the size of the data: that bound is
what makes their list safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

PARTS = 1000
SALTS = 64              # tasks that the rows of one heavy key are dealt to


def heavy_keys(counts: DataFrame, total: int, n: str = "n", parts: int = PARTS) -> DataFrame:
    """Rows of ``counts`` (one a key, ``n`` rows of it) whose key is heavy: at
    most ``parts`` of them."""
    return counts.where(F.col(n) * parts >= F.lit(max(total, 1)))


def frequent_keys(rows: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """All heavy values of ``key``, and perhaps some others: at most ``parts``.

    A bounded frequent-items pass over one column: every task keeps ``parts``
    counters, and only those are merged, so nothing is shuffled by key."""
    found = rows.where(F.col(key).isNotNull()).stat.freqItems([key], 1 / parts)
    return found.select(F.explode(f"{key}_freqItems").alias(key))


def frequent_hashes(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hashes ``_h`` of all heavy ``keys`` and of some others, with ``_heavy``.

    Materialised: which others ``frequent_keys`` finds may differ each time it
    is evaluated, and the branches that a caller makes of heavy and of other
    keys must agree, or rows of a key would be in neither."""
    checkpoint_root(rows.sparkSession)
    found = frequent_keys(rows.select(F.hash(*keys).alias("_h")), "_h").distinct()
    return found.withColumn("_heavy", F.lit(True)).checkpoint()


def join_heavy(rows: DataFrame, unique: DataFrame, on: Sequence[str], heavy: DataFrame,
               how: str = "inner", salts: int = SALTS, marks: bool = False) -> DataFrame:
    """``rows`` joined (``inner`` or ``left``) to ``unique``, which has one row
    a key, with the rows of the ``heavy`` keys dealt to ``salts`` tasks each.

    ``heavy`` is broadcast; a heavy key's row of ``unique`` is copied to every
    salt, at most ``PARTS * salts`` rows in all.  Other keys have one salt, so
    it is one shuffle join of the size of the plain one.  Keys are not NULL.
    With ``marks`` the result has ``_salt`` and ``_heavy`` (true or NULL): the
    rows of a key that is not heavy, and of a heavy one's salt, lie together.
    """
    keys = list(on)
    few = F.broadcast(heavy.select(*keys).distinct().withColumn("_heavy", F.lit(True)))
    dealt = F.when(F.col("_heavy"), F.monotonically_increasing_id() % salts).otherwise(0).cast("int")
    every = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(few, keys, "left").withColumn("_salt", dealt)
    right = unique.join(few, keys, "left").withColumn("_salt", F.explode(every)).drop("_heavy")
    payload = [c for c in unique.columns if c not in keys]
    return left.join(right, [*keys, "_salt"], how).select(*rows.columns, *payload, *(["_salt", "_heavy"] if marks else []))
