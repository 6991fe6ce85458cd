"""Operator 11: spelling variants, grouped by a variable-length gram index.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point.  Method:

* Gram dictionary: grams of ``qmin`` code points are counted over all words;
  one that more than ``extend_above`` of the words have is extended to longer
  ones, up to ``qmax``, which enter the dictionary (at most ``max_grams``, the
  most frequent first).  Any dictionary gives the same pairs.
* Decomposition: from each place of a word the longest gram of the dictionary
  is taken (``qmin`` code points where there is none), unless an earlier gram
  covers it.
* Affected-gram bound: for each place of one edit, a gram before it may change
  if the text between them begins a longer gram of the dictionary, and a gram
  behind it may vanish if the text between them ends one.  The largest number
  of grams that one edit can affect, ``k``, is kept a word: a near word has
  all but ``k`` of its grams, each at the same place or one further.
* List merging: among its ``k + 1`` rarest grams a word has the first gram, in
  order of rarity, that it shares with a near word, whatever the edit; only
  these enter the lists, by gram, length and place, and the longer lists are
  skipped.  Lists meet those of the same length and of one more.
* Verification: a signature of code point parities and the edit distance,
  inside the join that merges the lists.

A word of which an edit can affect all grams enters all its lists; two such
words need not share a gram, and meet by what is left when one code point is
deleted.  Lists of more than ``LIST_SIZE`` words are split over several tasks.

The driver collects and broadcasts the dictionary and the counts that order
the grams, at most ``max_grams`` each.

Defined results: equal words are one word; NULL and empty words are ignored;
among near words of equal count the smallest in code point order is the form;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import share, written

LETTERS = "a-zA-ZÀ-ÿ"
LIST_SIZE = 4096
RATIO = 10              # how much more frequent than a word its form is


def word_counts(docs: DataFrame, min_chars: int = 7, min_count: int = 2, drop_every: int | None = None) -> DataFrame:
    """(word, n): maximal runs of letters in ``text``, A-Z lower-cased, with at
    least ``min_chars`` code points and ``min_count`` occurrences.

    With ``drop_every`` a run whose crc32(``<doc_id>:<run>``) it divides loses
    the code point at that number modulo its length first (a NULL id is empty)."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0))
    words = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("word"))
    if drop_every:
        h = F.crc32(F.concat_ws(":", "doc", "word").cast("binary"))
        words = words.withColumn("h", h)
        at = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = words.select(F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("word")).alias("word"))
        words = words.where(F.length("word") >= min_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# ------------------------------------------------------------- gram index --
class Grams:
    """A gram dictionary and the order of its grams."""

    def __init__(self, qmin: int, qmax: int, longer: set[str], counts: dict[str, int]):
        self.qmin, self.qmax, self.longer = qmin, qmax, longer
        self.begins = {g[:k] for g in longer for k in range(1, len(g))}
        self.ends = {g[-k:] for g in longer for k in range(1, len(g))}
        # a gram is taken less often the more of its extensions are in the dictionary
        self.counts = dict(counts)
        for g in longer:
            if g[:-1] in self.counts:
                self.counts[g[:-1]] -= counts.get(g, 0)

    def order(self, token: tuple[int, str]) -> tuple[int, str, int]:
        return self.counts.get(token[1], 0), token[1], token[0]

    def decompose(self, word: str) -> list[tuple[int, str]]:
        """(place, gram) of the word's grams; places and ends both grow."""
        out, end = [], 0
        for p in range(len(word) - self.qmin + 1):
            q = min(self.qmax, len(word) - p)
            while q > self.qmin and word[p:p + q] not in self.longer:
                q -= 1
            if p + q > end:
                out.append((p, word[p:p + q]))
                end = p + q
        return out

    def affected(self, word: str, grams: list[tuple[int, str]]) -> int:
        """How many of the word's grams one edit can affect at most."""
        starts = [p for p, _ in grams]
        ends = [p + len(g) for p, g in grams]
        most = 0
        for i in range(len(word) + 1):
            # an edit at i: the grams before it, up to the first place whose text up to i begins a longer gram
            reach = next((q for q in range(max(0, i - self.qmax + 1), i) if word[q:i] in self.begins), i)
            before = min(bisect_right(ends, i), bisect_left(starts, reach))
            for r in (i, i + 1):        # what is left behind it: all for an insertion, else all but word[i]
                if r > len(word):
                    continue
                covered = next((e for e in range(min(len(word), r + self.qmax - 1), r, -1) if word[r:e] in self.ends), r)
                behind = len(grams) - max(bisect_left(starts, r), bisect_right(ends, covered))
                most = max(most, len(grams) - before - behind)
        return most

    def lists(self, word: str) -> tuple[list[tuple[int, str]], bool]:
        """The grams whose lists the word enters, and whether an edit can affect all of its grams."""
        grams = self.decompose(word)
        k = self.affected(word, grams)
        return sorted(grams, key=self.order)[:k + 1], k >= len(grams)


def gram_dictionary(words: DataFrame, qmin: int, qmax: int, extend_above: float, max_grams: int) -> Grams:
    """The frequency-pruned dictionary of ``words``."""
    share(words.sparkSession, None)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(w[p:p + q] for w in batch.column(0).to_pylist()
                            for q in range(qmin, qmax + 1) for p in range(len(w) - q + 1))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()),
                                              pa.array(list(found.values()), pa.int64())], ["gram", "n"])

    grams = written(words.select("word").mapInArrow(count, "gram string, n long")
                    .groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    above = extend_above * words.count()
    size = F.length("gram")
    level, longer = grams.where(size == qmin), None
    for q in range(qmin + 1, qmax + 1):
        parents = level.where(F.col("n") > above).select(F.col("gram").alias("parent"))
        level = (grams.where(size == q).join(parents, F.substring("gram", 1, q - 1) == F.col("parent"), "left_semi"))
        longer = level if longer is None else longer.unionAll(level)
    most = lambda df: [] if df is None else df.orderBy(F.desc("n"), "gram").limit(max_grams).collect()
    kept = most(longer)
    return Grams(qmin, qmax, {r["gram"] for r in kept},
                 {r["gram"]: r["n"] for r in [*most(grams.where(size == qmin)), *kept]})


def postings(words: DataFrame, grams: Grams) -> DataFrame:
    """(gram, size, place, word, n, sig): the lists that each word enters.
    Words that an edit can affect wholly also enter, with size -1, the lists
    of themselves and of what is left without one of their code points."""
    sent = share(words.sparkSession, grams)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            out = []
            for word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                sig = 0
                for c in word:
                    sig ^= 1 << (ord(c) & 63)
                sig -= (sig >> 63) << 64
                lists, loose = index.lists(word)
                out += [(g, len(word), p, word, n, sig) for p, g in lists]
                if loose:
                    out += [(x, -1, 0, word, n, sig) for x in {word, *(word[:i] + word[i + 1:] for i in range(len(word)))}]
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                                             ["gram", "size", "place", "word", "n", "sig"])

    return words.select("word", "n").mapInArrow(
        read, "gram string, size int, place int, word string, n long, sig long")


def near_pairs(words: DataFrame, qmin: int = 2, qmax: int = 3, extend_above: float = 0.005,
               max_grams: int = 1 << 16) -> DataFrame:
    """(a, a_n, b, b_n): each pair of near words once."""
    lists = written(postings(words, gram_dictionary(words, qmin, qmax, extend_above, max_grams)), "word-lists")
    key = ["gram", "size", "place"]
    long = lists.groupBy(*key).count().where(F.col("count") > LIST_SIZE)
    long = long.select(*key, F.ceil(F.col("count") / LIST_SIZE).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    right = (lists.join(long, key, "left").withColumn("part", F.pmod(F.xxhash64("word"), parts)).drop("parts")
             .select(*key, "part", *[F.col(c).alias(f"b_{c}") for c in ("word", "n", "sig")]))
    here = F.struct("size", "place")
    further = lambda d: F.struct((F.col("size") + 1).alias("size"), (F.col("place") + d).alias("place"))
    targets = F.when(F.col("size") < 0, F.array(here)).otherwise(F.array(here, further(0), further(1)))
    left = (lists.withColumn("to", F.explode(targets)).drop("size", "place").select("*", "to.*").drop("to")
            .join(long, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
            .withColumn("part", F.col("part").cast("long")))
    one = F.when(F.length("word") == F.length("b_word"), F.col("word") < F.col("b_word")).otherwise(
        F.length("word") < F.length("b_word"))
    near = ((F.bit_count(F.col("sig").bitwiseXOR(F.col("b_sig"))) <= 2) & one
            & (F.levenshtein("word", "b_word", 1) == 1))
    left = left.select(*[F.col(c).alias(f"_{c}") for c in [*key, "part"]], "word", "n", "sig")
    right = right.hint("shuffle_hash")
    same = [F.col(f"_{c}") == F.col(c) for c in [*key, "part"]]
    found = left.join(right, [*same, near])
    return found.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("b_word").alias("b"),
                        F.col("b_n")).distinct()


def variants(words: DataFrame, ratio: int = RATIO, **index) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of ``words`` (word, n).

    The form is the near word of largest n, if that is at least ``ratio``
    times the word's; the root is the last form on the way from form to form."""
    words = written(words.where("word <> ''").groupBy("word").agg(F.max("n").cast("long").alias("n")), "words")
    pairs = written(near_pairs(words, **index), "near-words")
    both = pairs.unionAll(pairs.select("b", "b_n", "a", "a_n"))
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("m"), F.col("b").alias("form"))).alias("best"))
    made = words.join(best, "word", "left")
    has = -F.col("best.m") >= ratio * F.col("n")
    made = written(made.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                               F.when(has, F.col("best.form")).alias("form"),
                               F.when(has, -F.col("best.m")).alias("form_n")), "word-forms")
    # every step multiplies n, so a way has at most log(n) steps, and each round doubles the steps taken
    most = words.agg(F.max("n")).first()[0] or 1
    steps = made.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(math.log(most, ratio) + 1)) if most > 1 else 0):
        steps = written(steps, "word-roots")
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        steps = steps.join(onward, "root", "left").select("word", F.coalesce("_on", "root").alias("root"))
    return (made.join(steps, "word", "left")
            .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
