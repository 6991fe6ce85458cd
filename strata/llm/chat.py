"""Operator 6: chat formatting of maximal conversations.

DataFrame operations only.  Chat logs hold cumulative snapshots: a logged
conversation is often the beginning of a longer one.  Every turn's rolling
hash stands for all turns up to it; a conversation whose last hash is an
inner hash of another one is a prefix of it and is left out by an anti-join,
and of equal conversations the one with the smallest id stays.

The rolling hash of k turns is the exclusive or of the hashes of
(position, role, text) of each, 128 bits in two halves.  Exclusive or is
associative, so the positions and rolling hashes of one conversation come
from segments of a range partitioning (``operators.sequence.segment``) and a
carry for each segment; a conversation with a third of all turns is never in
one task.  Prefix hashes are made distinct before the anti-join.

Rendering gives each conversation in parts of ``turns_per_part`` turns, so
no row grows with a conversation.

Defined results: turns are ordered by (turn, role, text), NULLs first;
repeated rows count once; a NULL role or text is an empty one; rows with a
NULL conv_id are one conversation with a NULL id; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import SEG, segment
from .tables import written


def _turn_hash(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "pos", "role", "text")


def rolling(conversations: DataFrame) -> DataFrame:
    """Every turn with ``pos`` (0-based position), ``size`` (turns of the
    conversation) and ``a``, ``b`` (hash of all turns up to this one)."""
    rows = conversations.select(
        F.concat(F.when(F.col("conv_id").isNull(), "none").otherwise("id "),        # NULL is no id, '' is one
                 F.coalesce(F.col("conv_id").cast("string"), F.lit(""))).alias("conv"), "conv_id", "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    order = ["turn", "role", "text"]
    rows = segment(rows, ["conv"], order)
    here = Window.partitionBy("conv", SEG).orderBy(*order)
    before = Window.partitionBy("conv").orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv", SEG).agg(F.count("*").alias("n"))
    counts = counts.select("conv", SEG, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                           F.sum("n").over(Window.partitionBy("conv")).alias("size"))
    rows = rows.withColumn("at", F.row_number().over(here)).join(counts, ["conv", SEG]).withColumn(
        "pos", F.col("offset") + F.col("at") - 1)
    rows = rows.withColumns({"ha": _turn_hash(1), "hb": _turn_hash(2)})
    upto = Window.partitionBy("conv", SEG).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy("conv", SEG).agg(F.bit_xor("ha").alias("ta"), F.bit_xor("hb").alias("tb"))
    carry = totals.select("conv", SEG, *[
        F.coalesce(F.bit_xor(f"t{x}").over(before), F.lit(0)).alias(f"c{x}") for x in "ab"])
    found = rows.withColumns({f"l{x}": F.bit_xor(f"h{x}").over(upto) for x in "ab"}).join(carry, ["conv", SEG])
    return found.select("conv", "conv_id", "pos", "size", "role", "text",
                        *[F.col(f"l{x}").bitwiseXOR(F.col(f"c{x}")).alias(x) for x in "ab"])


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, copies): of equal conversations the smallest id, without those
    that begin a longer one; ``copies`` counts the equal ones."""
    whole = turns.where("pos = size - 1").select("conv", "conv_id", "size", "a", "b")
    inner = turns.where("pos < size - 1").select((F.col("pos") + 1).alias("size"), "a", "b").distinct()
    return (whole.join(inner, ["size", "a", "b"], "left_anti").groupBy("size", "a", "b")
            .agg(F.min(F.struct("conv_id", "conv")).alias("first"), F.count("*").alias("copies"))
            .select("first.conv", "copies"))


def render(conversations: DataFrame, turns_per_part: int = 32) -> DataFrame:
    """(conv_id, part, n_turns, copies, rendered): maximal conversations in
    chat markup, ``turns_per_part`` turns a row."""
    turns = written(rolling(conversations), "chat-turns")
    kept = turns.join(maximal(turns), "conv")
    line = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    part = F.floor(F.col("pos") / turns_per_part).alias("part")
    lines = kept.select("conv", "conv_id", part, "copies", "size", F.struct("pos", line.alias("line")).alias("turn"))
    return (lines.groupBy("conv", "conv_id", "part")
            .agg(F.max("size").alias("n_turns"), F.max("copies").alias("copies"),
                 F.array_sort(F.collect_list("turn")).alias("turns"))
            .select("conv_id", "part", "n_turns", "copies",
                    F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("rendered")))
