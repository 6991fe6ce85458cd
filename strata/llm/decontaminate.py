"""Operator 8: benchmark decontamination by a prefix-filtered join.

DataFrame operations only.  Method: every window of ``width`` consecutive
benchmark words is a set of positioned tokens that a document must contain
whole.  Its tokens are ordered by rarity in the whole corpus, and since
containment must be exact its necessary prefix is one token, the rarest.
Document words are joined to these tokens; the positional bound (the window
must fit around the word) and the length bound (the document must have as
many words) discard pairs, and what is left is verified word by word.  The
covered words of a document are the union of its hits' intervals.

A window is ``width`` words; an item of fewer, but not none, is one window.
Words are compared with A-Z lower-cased.

The benchmark side is broadcast in blocks of at most ``BLOCK_WINDOWS``
windows: the number of blocks follows from its count, every block is joined
with all documents, and no document is ever shuffled with its text.  Only
word counts of the benchmark's vocabulary, hits and one narrow row a document
move, all pre-aggregated.

Defined results: NULL or empty texts have no words and are never
contaminated; items without words or NULL items have no window; an item with
a NULL id marks hits but is not listed; repeated documents are judged alike
(documents are told apart by id and text); ties in rarity go to the earlier
word; extra columns of either table are ignored; an empty table on either
side gives no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

#: Characters between words; A-Z are word characters until they are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK_WINDOWS = 200_000         # windows broadcast at once, some 50 MB


def _split(text: Column) -> Column:
    """Words of a text as written, with an empty first or last entry where the
    text begins or ends between words."""
    return F.split(F.coalesce(text, F.lit("")), BETWEEN)


def _count(words: Column) -> Column:
    last = F.element_at(words, -1)
    return (F.size(words) - (words[0] == "").cast("int")
            - ((F.size(words) > 1) & (last == "")).cast("int")).cast("long")


def _lowered(words: Column) -> Column:
    return F.transform(words, lambda w: F.translate(w, UPPER, LOWER))


def windows(benchmark: DataFrame, width: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, size, window): the windows of all items, repeated ones once,
    their words joined by one space."""
    words = F.filter(_lowered(_split(F.col(text))), lambda w: w != "")
    rows = benchmark.select(F.col(item).alias("item_id"), words.alias("all")).where(F.size("all") > 0)
    start = F.sequence(F.lit(0), F.greatest(F.size("all") - width, F.lit(0)))
    return (rows.distinct().select("item_id", "all", F.explode(start).alias("start"))
            .select("item_id", F.slice("all", F.col("start") + 1, F.lit(width)).alias("window"))
            .select("item_id", F.size("window").alias("size"), F.array_join("window", " ").alias("window"))
            .distinct())


def hits(docs: DataFrame, benchmark: DataFrame, width: int = 13, text: str = "text") -> DataFrame:
    """(doc_id, text_hash, begin, end, item_id): every occurrence of a window;
    ``begin`` and ``end`` (exclusive) number the document's words."""
    made = written(windows(benchmark, width), "windows")
    n = made.count()
    if n == 0:
        return docs.sparkSession.createDataFrame(
            [], "doc_id bigint, text_hash bigint, begin int, end int, item_id string")
    blocks = -(-n // BLOCK_WINDOWS)
    block = F.pmod(F.xxhash64("item_id", "window"), F.lit(blocks))
    texts = docs.select(F.col("doc_id"), F.xxhash64(text).alias("text_hash"), _split(F.col(text)).alias("words"))
    found = []
    for k in range(blocks):
        part = made.where(block == k)
        vocabulary = part.select(F.explode(F.split("window", " ")).alias("w")).select(F.lower("w").alias("key")).distinct()
        spread = (texts.select(F.explode_outer("words").alias("w")).select(F.lower("w").alias("key"))
                  .join(F.broadcast(vocabulary), "key").groupBy("key").agg(F.count("*").alias("n")))
        rarity = vocabulary.join(spread, "key", "left").select("key", F.coalesce("n", F.lit(0)).alias("n"))
        tokens = part.select("item_id", "size", "window", F.posexplode(F.split("window", " ")).alias("offset", "w"))
        rarest = (tokens.join(F.broadcast(rarity), F.lower("w") == F.col("key"))
                  .groupBy("item_id", "size", "window")
                  .agg(F.min(F.struct("n", "offset", "key")).alias("least"))
                  .select("item_id", "size", "window", "least.offset", "least.key"))
        begin, size = F.col("pos") - F.col("offset"), F.col("size")
        fits = (begin >= 0) & (begin + size <= F.size("words"))
        # no function with a lambda here: the array stays inside generated code,
        # where a row a word would otherwise carry a copy of it
        same = F.translate(F.array_join(F.slice("words", F.greatest(begin, F.lit(0)) + 1, size), " "),
                           UPPER, LOWER) == F.col("window")
        found.append(
            texts.select("doc_id", "text_hash", "words", F.posexplode_outer("words").alias("pos", "w"))
            .join(F.broadcast(rarest), F.lower("w") == F.col("key"))
            .where(fits & same)
            .select("doc_id", "text_hash", begin.alias("begin"), (begin + size).alias("end"),
                    F.col("item_id").cast("string").alias("item_id")))
    return reduce(DataFrame.unionAll, found)


def judge(docs: DataFrame, benchmark: DataFrame, width: int = 13, text: str = "text") -> DataFrame:
    """One row a document: doc_id, text_hash, n_words, n_hit (words inside
    hits), items (sorted ids as strings), contaminated (at least a twentieth
    of the words is hit)."""
    found = hits(docs, benchmark, width, text)
    spans = found.groupBy("doc_id", "text_hash", "begin").agg(
        F.max("end").alias("end"), F.collect_set("item_id").alias("items"))
    earlier = (Window.partitionBy("doc_id", "text_hash").orderBy("begin")
               .rowsBetween(Window.unboundedPreceding, -1))
    covered = F.coalesce(F.max("end").over(earlier), F.lit(0))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("begin"), covered))
    hit = (spans.select("doc_id", "text_hash", "items", new.alias("new"))
           .groupBy(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"))
           .agg(F.sum("new").alias("n_hit"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), _count(_split(F.col(text))).alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return rows.join(hit, same, "left").select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))
