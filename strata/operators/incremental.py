"""Affected-key incremental maintenance: keys -> scope -> recompute -> replace.

Affected keys stay a DataFrame end to end (never ``collect``-ed into a
literal list): scoping is a LEFT SEMI join and replacement a LEFT ANTI join.
Keys come from *both* the old and the new image of every change, so a row
that moved away from a key (an order whose date changed) still triggers a
recompute of the key it left, and a key whose result became empty is
deleted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def affected_keys(images: Sequence[DataFrame], key_exprs: dict[str, Column | str]) -> DataFrame:
    """Distinct keys touched by any of the change images (old and new)."""
    cols = [(F.col(e) if isinstance(e, str) else e).alias(n) for n, e in key_exprs.items()]
    parts = [img.select(*cols) for img in images]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def _same_key(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> tuple[DataFrame, Column]:
    """``keys`` under other names and the NULL-safe equality with ``df``: a key
    that is NULL (a failed cast) is affected like any other."""
    other = keys.select(*[F.col(c).alias(f"_key_{c}") for c in on])
    return other, reduce(lambda a, b: a & b, [df[c].eqNullSafe(other[f"_key_{c}"]) for c in on])


def scope(df: DataFrame, keys: DataFrame, on: Sequence[str], prune: bool = True) -> DataFrame:
    """Rows of ``df`` whose key is affected (LEFT SEMI, NULL keys included).

    With ``prune``, for a table that may be partitioned by the key: rows
    without a NULL key meet in a plain equality join, for which Spark prunes
    the partitions while it runs (it knows that ``keys`` are few when they are
    cached or read from files).  Rows with a NULL key, which equality never
    finds, are a branch of their own, whose filter prunes the scan.  Without
    it: one NULL-safe join.
    """
    on = list(on)
    if not prune:
        return df.join(*_same_key(df, keys, on), "left_semi")
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    # Spark prunes partitions only by a side with a comparison in its filter;
    # IS NOT NULL isn't one, so an always true one that it doesn't fold stands by
    counted = F.bit_count(F.hash(*on)) >= 0
    out = df.where(full).join(keys.select(*on).where(full & counted), on, "left_semi").select(*df.columns)
    gaps = df.where(~full)
    return out.unionAll(gaps.join(*_same_key(gaps, keys.where(~full), on), "left_semi"))


def replace_keys(target: DataFrame, result: DataFrame, affected: DataFrame,
                 on: Sequence[str], prune: bool = False) -> DataFrame:
    """Replace every affected key's rows of ``target`` by ``result``'s rows.

    Keys affected but absent from ``result`` disappear from the target.  This
    is the whole next state; a table partitioned by the key is better written
    by ``streaming.tables.KeyedTable``, which leaves other partitions be.

    With ``prune``, for a target and keys that are dealt by ``on``: rows without
    a NULL key meet in a plain equality join, which keeps both where they are,
    and the others in a branch of their own (see ``scope``).
    """
    if prune:
        full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
        gaps = target.where(~full)
        kept = target.where(full).join(affected.select(*on).where(full), list(on), "left_anti").select(*target.columns)
        kept = kept.unionAll(gaps.join(*_same_key(gaps, affected.where(~full), on), "left_anti"))
    else:
        kept = target.join(*_same_key(target, affected, on), "left_anti")
    return kept.unionByName(result.select(*target.columns))


WEIGHT = "_w"


def signed_images(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """What turns ``before`` into ``after``: their rows that differ with a
    weight, ``-n`` for a row that occurs n times less, ``n`` for one that
    occurs n times more.

    One shuffle for both directions: rows are counted with their sign, and
    equal rows of both sides, most of them, cancel out in the partial counts
    of a task or in the final ones.  Used when a source has no change log.

    ``columns``, default all, are those that a consumer reads: rows that differ
    in others only have no images, and the others aren't shuffled.
    """
    if columns is not None:
        before, after = before.select(*columns), after.select(*columns)
    sides = (before.withColumn(WEIGHT, F.lit(-1).cast("long"))
             .unionByName(after.select(*before.columns).withColumn(WEIGHT, F.lit(1).cast("long"))))
    return (sides.groupBy(*[F.col(f"`{c}`") for c in before.columns])
            .agg(F.sum(WEIGHT).alias(WEIGHT)).where(F.col(WEIGHT) != 0))


def images_of(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(old images, new images) of signed ones, each as often as its weight says."""
    times = F.explode(F.sequence(F.lit(1), F.abs(F.col(WEIGHT))))
    return tuple(signed.where(F.col(WEIGHT) * sign > 0).withColumn("_i", times).drop(WEIGHT, "_i")
                 for sign in (-1, 1))


def changed_images(before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(old images, new images) of rows that differ between two snapshots, each
    as often as it differs."""
    return images_of(signed_images(before, after))
