"""Column predicates shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the open end of an SCD2 validity interval is 9999-12-31.
OPEN_END_LITERAL = "9999-12-31 00:00:00"


def open_end(like: str = "timestamp") -> Column:
    """The open-interval sentinel typed like the ``valid_to`` column.

    Test tables load timestamps as ``timestamp_ntz``; ``like`` lets callers
    build a sentinel of the matching type so comparisons stay sargable.
    """
    if like == "timestamp_ntz":
        return F.lit(OPEN_END_LITERAL).cast("timestamp_ntz")
    if like == "date":
        return F.lit(OPEN_END_LITERAL[:10]).cast("date")
    return F.lit(OPEN_END_LITERAL).cast("timestamp")


def _type_name(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.typeName()


def is_current(df: DataFrame, valid_to: str = "valid_to") -> Column:
    """``valid_to >= sentinel``: a range predicate Parquet can push down.

    ``year(valid_to) = 9999`` (the spelling a hand-written filter often uses)
    only pushes ``IsNotNull``; a range comparison prunes row groups.
    """
    t = _type_name(df, valid_to)
    like = {"timestamp_ntz": "timestamp_ntz", "date": "date"}.get(t, "timestamp")
    return F.col(valid_to) >= open_end(like)


def current_rows(df: DataFrame, valid_to: str = "valid_to") -> DataFrame:
    """Keep only the open version of each key of an SCD2 table."""
    return df.filter(is_current(df, valid_to))


def open_end_as_null(df: DataFrame, valid_to: str = "valid_to") -> DataFrame:
    """Presentation form of an SCD2 table: the open end shown as NULL.

    Year-9999 timestamps overflow nanosecond-based consumers (pandas); the
    stored table keeps the sentinel, reports show NULL = open.
    """
    return df.withColumn(valid_to, F.when(~is_current(df, valid_to), F.col(valid_to)))
