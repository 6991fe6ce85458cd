"""Operator 13: phrase collocation mining over sorted count streams.

Method: the layout of external stream estimation.  Counts of words and of
phrases are kept as sorted streams, and a phrase finds the counts of its parts
by walking two streams in lockstep, without a hash table.

* Counting, length by length.  A phrase that occurs ``min_count`` times is
  made of shorter ones that do, so a phrase enters the count only when both
  its ends passed the round before.  That test is a bitmap of
  ``2 ** MAP_BITS`` bits, which holds every frequent phrase: a false mark only
  counts in vain, so results don't depend on its size.
* Suffix order: all frequent words and phrases, sorted by their words from
  last to first.  Every suffix of a phrase stands before it, and the last row
  of each length seen on the way is that suffix.  It gives a phrase the counts
  of its right parts, and its last word.
* Prefix order: the same rows sorted from first to last, for the counts of the
  left parts, the words and the language.
* Extension counts: in either order a phrase meets the one that it extends; if
  it has ``share`` per cent of its occurrences, that one is dropped.

A stream is cut into ranges of sorted rows, so that no word, however frequent,
puts its phrases into one task; the rows on which a range depends, the last
ones of each length before it, are carried over from a summary of one row a
range.

Words are 64-bit hashes of language and word until the end; if two words had
the same hash, the run fails (a query can then set another ``seed``).  Score:
``a`` occurrences of a phrase, cut into parts of ``l`` and ``r`` occurrences,
give floor(10^6 a^2 / (l r)) in 38-digit decimals, exact for counts below
10^15; the lowest cut counts.

What the driver collects and broadcasts: the bitmaps, ``2 ** MAP_BITS`` bits
each.

Defined results: a NULL text has no words, a NULL language is ``und``;
repeated rows count each; a phrase never spans two pieces or texts; ties
follow the phrase's UTF-8 bytes; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import flat, share, slices, written
from .words import LOWER, boundaries, mix, word_hashes

MAP_BITS = 27
UNKNOWN = "und"
SCORE = 1_000_000
TOP_PARTS = 64          # in which each language's first phrases are found before they are merged

#: Bytes that end a piece, and bytes that end a word (pieces end words too).
PIECE_ENDS = np.zeros(256, bool)
PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD_ENDS = PIECE_ENDS.copy()
WORD_ENDS[[0x20, 0x09]] = True


class Words:
    """Word hashes of many texts, and which neighbours share a piece."""

    def __init__(self, texts: pa.Array, salts: np.ndarray):
        raw, at = flat(texts)
        self.data = LOWER[raw]
        self.starts, self.ends, first = boundaries(self.data, at, WORD_ENDS)
        self.owner = np.repeat(np.arange(len(at) - 1), np.diff(first))
        self.hashes = mix(word_hashes(self.data, self.starts, self.ends) ^ salts[self.owner])
        # piece and text numbers both only grow, so their sum tells the pieces apart
        self.piece = np.cumsum(PIECE_ENDS[self.data])[self.starts] + self.owner if len(self.starts) else self.owner

    def runs(self, size: int) -> np.ndarray:
        """First words of all runs of ``size`` words inside a piece."""
        n = len(self.hashes) - size + 1
        return np.flatnonzero(self.piece[:max(n, 0)] == self.piece[size - 1:]) if n > 0 else np.zeros(0, np.int64)

    def text(self, i: int) -> str:
        return self.data[self.starts[i]:self.ends[i]].tobytes().decode("utf-8", "replace")


def salts_of(langs: list[str], seed: int) -> np.ndarray:
    """A 64-bit number a row, from its language."""
    known = {x: int.from_bytes(hashlib.blake2b(f"{seed} {x}".encode(), digest_size=8).digest(), "little")
             for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def places(columns: list[np.ndarray], bits: int = MAP_BITS) -> np.ndarray:
    """Bit of the bitmap of each phrase, given its words' hashes in order."""
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + c.view(np.uint64))
    return h & np.uint64((1 << bits) - 1)


def marked(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def _distinct(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows and how often each occurs."""
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    for i, c in enumerate(columns):
        new[1:] = (c[1:] != c[:-1]) if i == 0 else new[1:] | (c[1:] != c[:-1])
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.diff(np.append(at, len(order)))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")


def count_words(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(w, lang, word, f) of all words of all texts."""
    share(docs.sparkSession, None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, row = batch.column(0).to_pylist(), 0
            for part in slices(batch.column(1)):
                mine = langs[row:row + len(part)]
                row += len(part)
                words = Words(part, salts_of(mine, seed))
                value, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array([mine[words.owner[i]] for i in first], pa.string()),
                     pa.array([words.text(i) for i in first], pa.string()), pa.array(n.astype(np.int64))],
                    ["w", "lang", "word", "n"])

    seen = _rows(docs).mapInArrow(read, "w long, lang string, word string, n long")
    return seen.groupBy("w", "lang", "word").agg(F.sum("n").alias("f"))


def count_phrases(docs: DataFrame, size: int, bitmap: Broadcast, seed: int = 0) -> DataFrame:
    """(w0, w1, .., f) of the phrases of ``size`` words whose two ends of
    ``size - 1`` words are marked in ``bitmap``."""
    names = [f"w{i}" for i in range(size)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = bitmap.value
        for batch in batches:
            langs, row = batch.column(0).to_pylist(), 0
            for part in slices(batch.column(1)):
                words = Words(part, salts_of(langs[row:row + len(part)], seed))
                row += len(part)
                h = words.hashes
                shorter = words.runs(size - 1)
                ends = np.zeros(len(h) + 1, bool)
                if len(shorter):
                    ends[shorter] = marked(marks, places([h[shorter + j] for j in range(size - 1)]))
                at = words.runs(size)
                at = at[ends[at] & ends[at + 1]]
                columns, n = _distinct([h[at + j] for j in range(size)])
                yield pa.RecordBatch.from_arrays([*[pa.array(c.view(np.int64)) for c in columns],
                                                  pa.array(n.astype(np.int64))], [*names, "n"])

    seen = _rows(docs).mapInArrow(read, ", ".join(f"{c} long" for c in [*names, "n"]))
    return seen.groupBy(*names).agg(F.sum("n").alias("f"))


def _bitmap(phrases: DataFrame, names: list[str]) -> Broadcast:
    """The bitmap of ``phrases``; at most ``2 ** (MAP_BITS - 6)`` numbers reach the driver."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = places([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            yield pa.RecordBatch.from_arrays(
                [pa.array((place >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64))], ["at", "bits"])

    made = phrases.select(*names).mapInArrow(read, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    found = made.toArrow()
    bitmap = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    bitmap[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return share(phrases.sparkSession, bitmap)


def with_heads(rows: DataFrame, order: str, sizes: int, values: list[str], out: str) -> DataFrame:
    """``rows`` with ``out``: an array whose entry j - 1 is the struct of
    ``values`` of the row that ``order`` (an array) begins with, j long.

    All rows are one sorted stream, cut into ranges; an array's beginnings are
    rows before it.  ``rows`` must hold every beginning of every array.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(rows.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id()), "phrase-stream")
    head = lambda j: F.when(F.size(order) == j, F.struct(*values))
    so_far = Window.partitionBy("part").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = placed.groupBy("part").agg(*[F.max_by(head(j), F.when(F.size(order) == j, F.col(order))).alias(f"_last{j}")
                                        for j in range(1, sizes)])
    # one row a range of the stream, so bounded by the number of ranges
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("part", *[F.last(f"_last{j}", ignorenulls=True).over(before).alias(f"_carry{j}")
                                    for j in range(1, sizes)])
    seen = placed.select("*", *[F.last(head(j), ignorenulls=True).over(so_far).alias(f"_head{j}")
                                for j in range(1, sizes)])
    heads = F.array(*[F.when(F.size(order) > j, F.coalesce(f"_head{j}", f"_carry{j}")) for j in range(1, sizes)])
    return (seen.join(F.broadcast(carried), "part").withColumn(out, heads)
            .drop("part", *[f"_{x}{j}" for x in ("head", "carry") for j in range(1, sizes)]))


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, share_percent: int = 50,
                 top: int | None = 2000, seed: int = 0) -> DataFrame:
    """Collocations of ``docs`` (text, lang): ``lang, phrase, words, a, l, r,
    n, score`` and, with ``top``, ``rank``: each language's first ``top`` by
    score, a (both descending) and phrase."""
    words = written(count_words(docs, seed), "phrase-words")
    if not words.groupBy("w").count().where("count > 1").isEmpty():
        raise ValueError(f"two words have the same hash with seed {seed}; take another")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= min_count)
    rows = frequent.select(F.array("w").alias("key"), "f", "lang", "word")
    names, level = ["w"], frequent
    for size in range(2, max_words + 1):
        bitmap = _bitmap(level, names)
        names = [f"w{i}" for i in range(size)]
        level = written(count_phrases(docs, size, bitmap, seed).where(F.col("f") >= min_count), "phrase-counts")
        bitmap.unpersist()
        rows = rows.unionByName(level.select(F.array(*names).alias("key"), "f"), allowMissingColumns=True)

    return ranked(with_parts(rows, max_words), share_percent, top).join(totals, "lang")


def with_parts(rows: DataFrame, max_words: int) -> DataFrame:
    """``rows`` (key, f, lang, word: an array of words' hashes and its count;
    of single words also the language and the word) with ``left`` and
    ``right``, the counts and words of all their left and right parts by
    length, and ``word``, the last word."""
    rows = with_heads(rows.withColumn("_back", F.reverse("key")), "_back", max_words, ["f", "word"], "right").drop("_back")
    rows = rows.withColumn("word", F.coalesce(F.col("right")[0]["word"], "word"))
    return written(with_heads(rows, "key", max_words, ["f", "word", "lang"], "left"), "phrase-parts")


def ranked(rows: DataFrame, share_percent: int, top: int | None) -> DataFrame:
    """The phrases among ``rows`` that no longer one covers, scored, and
    ranked within their language."""
    size = F.size("key")
    phrases = rows.where(size >= 2)
    strong = lambda side: F.col("f") * 100 >= F.element_at(side, size - 1)["f"] * share_percent
    longer = phrases.where(size >= 3)
    covered = (longer.where(strong("left")).select(F.slice("key", 1, size - 1).alias("key"))
               .unionAll(longer.where(strong("right")).select(F.slice("key", F.lit(2), size - 1).alias("key"))))
    kept = phrases.join(covered.distinct(), "key", "left_anti")

    big = lambda c: c.cast("decimal(15,0)")

    def cut(k):
        l, r = F.col("left")[k - 1]["f"], F.col("right")[size - k - 1]["f"]
        top_, bottom = F.lit(SCORE).cast("decimal(7,0)") * big(F.col("f")) * big(F.col("f")), big(l) * big(r)
        return F.struct(F.call_function("div", top_, bottom).alias("score"), k.alias("k"), l.alias("l"), r.alias("r"))

    best = F.array_min(F.transform(F.sequence(F.lit(1), size - 1), cut))
    spelled = F.concat_ws(" ", F.transform(F.filter("left", lambda x: x.isNotNull()), lambda x: x["word"]), F.col("word"))
    found = kept.select(F.col("left")[0]["lang"].alias("lang"), spelled.alias("phrase"), size.alias("words"),
                        F.col("f").alias("a"), best.alias("best"))
    found = found.select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")
    if top is not None:
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
        first = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
        found = found.withColumn("_part", part).withColumn("rank", first).where(F.col("rank") <= top).drop("_part")
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
        found = found.withColumn("rank", rank).where(F.col("rank") <= top)
    return found
