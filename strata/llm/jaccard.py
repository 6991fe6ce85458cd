"""Operator 2: exact n-gram Jaccard join and its connected groups.

Two texts link when ``den * intersection >= num * union`` of their sets of
distinct word shingles.  Method: set-relation skipping over a prefix index.

* Equal sets are one class from the start (64-bit set hash and size).
* Index: shingles are ordered by rarity (estimated counts of the frequent
  ones, the rest by hash); a set enters the lists of its first
  ``n - ceil(n * num / den) + 1`` shingles, which two linked sets must share.
  Lists are cut into blocks by size, and a block whose sizes cannot meet the
  bound is skipped; within reach, the position of the shared shingle bounds
  the overlap and skips the rest.
* Answers from answers: first every set is compared with few leaders of its
  blocks only (four leader orders), those it meets in most lists.  The verified links make groups,
  and then a set meets just those members of its lists that are not in its
  group yet: what a leader's verified answers already connect, a copy or
  near copy of it need not be asked again, and lists within one group are
  skipped whole.  This yields every group exactly, without the pairs within
  a group of near copies.
* Candidates pass an exact bound on the symmetric difference (bits in which
  256-bit parities of the sets differ) inside the join that finds them.
  Sets of more than ``LONG`` shingles, which fill the parities, enter
  ``n // 50`` further lists, and two of them must meet in more than
  ``min(n, m) // 50`` lists (the same prefix theorem for that many shared
  shingles), so that long texts don't meet by a few common shingles.
  What is left is decided from differences: candidates that hang together
  share a base set, each is reduced once to its symmetric difference from
  that base, and since x ^ y = (x ^ base) ^ (y ^ base), a pair of similar
  sets is compared by two short differences instead of two whole sets.

Ordering estimates are merged from counts of some ``COUNTED`` shingles each and change
the cost only: any total order of the shingles gives the same links.  What
the driver collects and broadcasts is bounded: ``FREQUENT`` shingles and a
bitmap of ``2 ** MAP_BITS`` bits that marks classes whose sets are needed (a
false mark only sends a set in vain).

Words are runs of characters other than space and \\x09-\\x0D, A-Z
lower-cased; a text of fewer words than a shingle, but not none, is one
shingle.  Shingles are 64-bit hashes.

Defined results: NULL, empty and wordless texts have an empty set, link with
nothing and are a group each; repeated rows are equal sets; rows with a NULL
doc_id take part, and a group's id is its smallest id that is not NULL;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .tables import flat, give_back, share, slices, written
from .words import LOWER, SPACES, boundaries, distinct_per_text, mix, shingle_hashes, word_hashes

FREQUENT = 1 << 18      # shingles whose order follows their counts, a few MB
LIST_SIZE = 4096        # of a list; those of more frequent shingles are salted
MAP_BITS = 24
LEADERS = 4             # leader orders, and leaders that a set is compared with
PARITY = 256            # bits
LONG = 1000             # shingles from which lists are counted instead
COUNTED = 1 << 20       # shingles counted together inside a task
SKETCH = [f"s{i}" for i in range(PARITY // 64)]


def text_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, offsets, and a
    64-bit hash of each set."""
    data, at = flat(texts)
    data = LOWER[data]
    starts, ends, first = boundaries(data, at, SPACES)
    shingles, begin = shingle_hashes(word_hashes(data, starts, ends), first, width)
    values, begin = distinct_per_text(shingles, begin)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values + np.uint64(width)), dtype=np.uint64)])
    n = np.diff(begin)
    return values, begin, mix(sums[begin[1:]] - sums[begin[:-1]] + n.astype(np.uint64))


def parities(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each set, the parity of the number of members in each of PARITY bins."""
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    bins = np.bincount(owner * PARITY + (values % np.uint64(PARITY)).astype(np.int64),
                       minlength=(len(begin) - 1) * PARITY)
    return np.packbits((bins & 1).astype(np.uint8).reshape(-1, PARITY), axis=1).view(np.int64)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _described(docs: DataFrame, width: int) -> DataFrame:
    """Two kinds of rows from one pass: of each document (doc_id, text_hash,
    k, n, parities), and of shingles that several sets of an Arrow batch have
    (tok, c)."""
    share(docs.sparkSession, None)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_hash", T.LongType()),
                           T.StructField("k", T.LongType()), T.StructField("n", T.IntegerType()),
                           *[T.StructField(s, T.LongType()) for s in SKETCH],
                           T.StructField("tok", T.LongType()), T.StructField("c", T.IntegerType())])

    def counted(batch: pa.RecordBatch, kept: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not kept:
            return
        tokens, counts = np.unique(np.concatenate(kept), return_counts=True)
        tokens, counts = tokens[counts > 1], counts[counts > 1]
        if len(tokens):
            none = pa.nulls(len(tokens), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none.cast(batch.schema.field("doc_id").type), none, none, none.cast(pa.int32()),
                 *[none] * len(SKETCH), pa.array(tokens.view(np.int64)),
                 pa.array(counts.astype(np.int32))],
                ["doc_id", "text_hash", "k", "n", *SKETCH, "tok", "c"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, seen, kept = 0, set(), []
            for part in slices(_column(batch, "text")):
                values, begin, key = text_sets(part, width)
                n = np.diff(begin)
                bits = parities(values, begin)
                nothing = pa.nulls(len(part), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [_column(batch, "doc_id").slice(row, len(part)),
                     _column(batch, "text_hash").slice(row, len(part)),
                     pa.array(key.view(np.int64)), pa.array(n.astype(np.int32)),
                     *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(len(SKETCH))],
                     nothing, nothing.cast(pa.int32())],
                    ["doc_id", "text_hash", "k", "n", *SKETCH, "tok", "c"])
                row += len(part)
                fresh = np.zeros(len(part), bool)
                for i, x in enumerate(key.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[i] = True
                kept.append(values[np.repeat(fresh, n)])
                if sum(map(len, kept)) > COUNTED:
                    yield from counted(batch, kept)
                    kept = []
            yield from counted(batch, kept)
        give_back()

    return rows.mapInArrow(describe, schema)


def _index(docs: DataFrame, width: int, num: int, den: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(tok, salt, k, n, pos): each set's entries in the prefix lists."""
    sent = share(docs.sparkSession, frequent)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, count = sent.value
        for batch in batches:
            seen = set()
            for part in slices(_column(batch, "text")):
                values, begin, key = text_sets(part, width)
                where = np.minimum(np.searchsorted(common, values), max(len(common) - 1, 0))
                c = np.where(common[where] == values, count[where], 0) if len(common) else np.zeros(len(values), int)
                tokens, counts, which = [], [], []
                for i, x in enumerate(key.tolist()):
                    low, high = begin[i], begin[i + 1]
                    if low == high or x in seen:
                        continue
                    seen.add(x)
                    n = high - low
                    take = n - -(-n * num // den) + 1 + (n // 50 if n > LONG else 0)
                    mine = c[low:high]
                    if mine.any():
                        order = np.argsort(mine, kind="stable")[:take]
                        tokens.append(values[low:high][order])
                        counts.append(mine[order])
                    else:
                        tokens.append(values[low:low + take])
                        counts.append(mine[:take])
                    which.append(i)
                if not which:
                    continue
                size = np.array([len(t) for t in tokens])
                owner = np.repeat(np.array(which), size)
                heavy = np.concatenate(counts)
                lists = heavy // LIST_SIZE + 1
                salt = np.where(lists > 1, 1 + (key[owner] % lists.astype(np.uint64)).astype(np.int64), 0)
                pos = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(salt.astype(np.int32)),
                     pa.array(key[owner].view(np.int64)), pa.array(np.diff(begin)[owner].astype(np.int32)),
                     pa.array(pos.astype(np.int32))], ["tok", "salt", "k", "n", "pos"])
        give_back()

    return docs.select("text").mapInArrow(enter, "tok long, salt int, k long, n int, pos int")


def _sets_of(docs: DataFrame, width: int, needed: DataFrame) -> DataFrame:
    """(k, n, members) of the classes in ``needed`` (k), and of some others;
    one row each."""
    place = F.pmod(F.col("k"), F.lit(1 << MAP_BITS))
    words = (needed.select((place / 64).cast("int").alias("w"), F.expr(
                 f"shiftleft(1L, cast(pmod(k, {1 << MAP_BITS}) % 64 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    marked = np.zeros(1 << (MAP_BITS - 6), np.int64)
    marked[words.column("w").to_numpy()] = words.column("b").to_numpy()
    sent = share(docs.sparkSession, marked)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value.view(np.uint64)
        for batch in batches:
            seen = set()
            for part in slices(_column(batch, "text")):
                values, begin, key = text_sets(part, width)
                at = key & np.uint64((1 << MAP_BITS) - 1)
                want = (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)) > 0
                rows = []
                for i in np.flatnonzero(want & (np.diff(begin) > 0)).tolist():
                    if int(key[i]) not in seen:
                        seen.add(int(key[i]))
                        rows.append(i)
                if rows:
                    members = [values[begin[i]:begin[i + 1]].view(np.int64) for i in rows]
                    upto = np.concatenate([[0], np.cumsum([len(m) for m in members])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[rows].view(np.int64)), pa.array(np.diff(upto)),
                         pa.ListArray.from_arrays(pa.array(upto), pa.array(np.concatenate(members)))],
                        ["k", "n", "members"])
        give_back()

    found = docs.select("text").mapInArrow(gather, "k long, n int, members array<long>")
    return found.groupBy("k", "n").agg(F.any_value("members").alias("members"))


class Join:
    """The join of one table's sets; ``num / den`` is the least Jaccard similarity."""

    def __init__(self, docs: DataFrame, width: int, num: int, den: int):
        self.docs, self.width, self.num, self.den = docs, width, num, den

    def _least(self, n: Column, m: Column) -> Column:
        """Least intersection of linked sets of sizes n and m."""
        return F.ceil(F.lit(self.num) * (n + m) / F.lit(self.num + self.den))

    def _within(self, n: Column, m: Column, pos: Column, other: Column) -> Column:
        """Whether sizes, and positions of a first shared shingle, allow a link;
        of two long sets the sizes only."""
        rest = 1 + F.least(n - 1 - pos, m - 1 - other)
        return ((F.least(n, m) * self.den >= F.greatest(n, m) * self.num)
                & ((F.least(n, m) > LONG) | (rest * (self.num + self.den) >= self.num * (n + m))))

    def _met(self, n: Column, m: Column, lists: Column, share: int) -> Column:
        """Whether two sets meet in enough lists: any if one is short, more than
        ``min(n, m) // share`` if both are long."""
        return (F.least(n, m) <= LONG) | (lists > F.floor(F.least(n, m) / share))

    def _apart(self, n: Column, m: Column, one: str, two: str) -> Column:
        """Whether the parities of the sets ``one`` and ``two`` rule a link out:
        they differ in no more bits than the sets do in members."""
        bits = sum((F.bit_count(F.col(f"{one}.{s}").bitwiseXOR(F.col(f"{two}.{s}"))) for s in SKETCH), F.lit(0))
        return bits > n + m - 2 * self._least(n, m)

    def _verified(self, near: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes, structs of (k, n), that link."""
        if near.isEmpty():
            return near
        roots = components(near.select(F.col("a").alias("u"), F.col("b").alias("v")))
        home = roots.unionAll(roots.select("root", "root").distinct()).select("node.k", "node.n", "root")
        sets = _sets_of(self.docs, self.width, home.select("k").distinct()).join(home, ["k", "n"])
        sets = sets.select(F.struct("k", "n").alias("c"), "root", "members")     # one exchange for both uses
        base = sets.where(F.col("c") == F.col("root")).select("root", F.col("members").alias("base"))
        short = written(sets.join(base, "root").select("c", F.concat(
            F.array_except("members", "base"), F.array_except("base", "members")).alias("delta")), "differences")
        one, two = short.alias("one"), short.alias("two")
        n, m = F.col("a.n"), F.col("b.n")
        differ = (F.size(F.array_except("one.delta", "two.delta"))
                  + F.size(F.array_except("two.delta", "one.delta")))
        linked = (near.join(one, F.col("a") == F.col("one.c")).join(two, F.col("b") == F.col("two.c"))
                  .where(differ <= n + m - 2 * self._least(n, m)).select("a", "b"))
        return written(linked, "links")

    def groups(self) -> DataFrame:
        """One row a document: doc_id, text_hash, n_shingles, component (struct,
        NULL for an empty set) and component_id."""
        docs = self.docs
        described = written(_described(docs, self.width), "described")
        rows = described.where("k is not null")
        top = (described.where("tok is not null").groupBy("tok").agg(F.sum("c").alias("c"))
               .orderBy(F.desc("c"), "tok").limit(FREQUENT).toArrow())
        common = top.column("tok").to_numpy().view(np.uint64)
        order = np.argsort(common)
        frequent = common[order], np.minimum(top.column("c").to_numpy(), 2**31 - 1)[order]
        classes = written(rows.where("n > 0").groupBy("k", "n").agg(
            F.min("doc_id").alias("first_id"), *[F.any_value(s).alias(s) for s in SKETCH]), "classes")

        step = math.log(self.den / self.num) * (1 + 1e-9)
        block = F.floor(F.log(F.col("n").cast("double")) / step).cast("int").alias("block")
        in_list = Window.partitionBy("tok", "salt").orderBy("n", "k")
        before, after = F.lag("n").over(in_list), F.lead("n").over(in_list)
        entries = (_index(docs, self.width, self.num, self.den, frequent)
                   .repartition("tok", "salt").dropDuplicates(["tok", "salt", "k", "n", "pos"])
                   .withColumns({"before": before, "after": after})
                   .where((F.col("salt") > 0) | (F.col("before") * self.den >= F.col("n") * self.num)
                          | (F.col("n") * self.den >= F.col("after") * self.num))
                   .select("tok", block, F.struct("k", "n").alias("c"), "n", "pos"))
        entries = written(entries, "entries")

        rank = F.xxhash64("c.k", F.pmod("tok", F.lit(LEADERS)))
        leaders = entries.groupBy("tok", "block").agg(
            F.min(F.struct(rank.alias("r"), "c", "pos")).alias("lead"))
        # of the leaders that a set meets, the LEADERS it meets in most lists are asked
        most = Window.partitionBy("c").orderBy(F.desc("lists"), F.xxhash64("l"))
        asked = (entries.join(leaders, ["tok", "block"])
                 .where((F.col("c") != F.col("lead.c"))
                        & self._within(F.col("n"), F.col("lead.c.n"), F.col("pos"), F.col("lead.pos")))
                 .groupBy("c", F.col("lead.c").alias("l")).agg(F.count("*").alias("lists"))
                 .where(self._met(F.col("c.n"), F.col("l.n"), F.col("lists"), 200))
                 .withColumn("place", F.row_number().over(most)).where(F.col("place") <= LEADERS)
                 .select(F.least("c", "l").alias("a"), F.greatest("c", "l").alias("b")).distinct())
        asked = written(asked, "asked")
        bits = classes.select(F.struct("k", "n").alias("c"), F.struct(*SKETCH).alias("bits"))
        one = bits.select(F.col("c").alias("a"), F.col("bits").alias("one"))
        two = bits.select(F.col("c").alias("b"), F.col("bits").alias("two"))
        near = asked.join(one, "a").join(two, "b").where(~self._apart(F.col("a.n"), F.col("b.n"), "one", "two"))
        links = self._verified(written(near.select("a", "b"), "near"))
        roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))

        grouped = entries.join(roots, entries["c"] == roots["node"], "left").select(
            "tok", "block", "c", "n", "pos", F.coalesce("root", "c").alias("g"))
        parts = grouped.groupBy("tok", "g").agg(F.count("*").alias("m"))
        split = (parts.groupBy("tok").agg(F.max(F.struct("m", "g")).alias("main"), F.count("*").alias("parts"))
                 .where("parts > 1").select("tok", F.col("main.g").alias("main")))
        lists = written(grouped.join(split, "tok").join(bits, "c"), "lists")
        outside = lists.where("g <> main").select(
            "tok", F.col("c").alias("x"), F.col("n").alias("xn"), F.col("pos").alias("xpos"), F.col("g").alias("xg"),
            F.col("bits").alias("xbits"))
        pairs = (outside.join(lists, "tok")
                 .where((F.col("g") != F.col("xg")) & ((F.col("g") == F.col("main")) | (F.col("x") < F.col("c")))
                        & self._within(F.col("n"), F.col("xn"), F.col("pos"), F.col("xpos"))
                        & ~self._apart(F.col("n"), F.col("xn"), "bits", "xbits"))
                 .groupBy(F.least("c", "x").alias("a"), F.greatest("c", "x").alias("b"))
                 .agg(F.count("*").alias("lists"))
                 .where(self._met(F.col("a.n"), F.col("b.n"), F.col("lists"), 50)).select("a", "b"))
        more = self._verified(written(pairs.join(asked, ["a", "b"], "left_anti"), "pairs"))
        edges = roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(
            more.select(F.col("a").alias("u"), F.col("b").alias("v")))
        final = components(edges)

        own = classes.select(F.struct("k", "n").alias("c"), "first_id")
        of_class = own.join(final, own["c"] == final["node"], "left").select(
            "c", "first_id", F.coalesce("root", "c").alias("component"))
        ids = of_class.groupBy("component").agg(F.min("first_id").alias("component_id"))
        of_class = of_class.join(ids, "component").select("c", "component", "component_id")
        mine = rows.select("doc_id", "text_hash", F.struct("k", "n").alias("c"))
        return mine.join(of_class, "c", "left").select(
            "doc_id", "text_hash", F.col("c.n").cast("long").alias("n_shingles"), "component",
            F.when(F.col("c.n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def groups(docs: DataFrame, width: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """Every document's group of linked texts; see ``Join.groups``."""
    return Join(docs, width, num, den).groups()


def first_of_each(docs: DataFrame, width: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """``docs`` without near duplicates: of each group the row with the
    smallest (doc_id, text hash), NULL ids last; documents with an empty set
    stay, equal rows of them once."""
    def key(doc_id: str, text_hash: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), text_hash.cast("string"))

    made = groups(docs, width, num, den)
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    linked = made.where("component is not null").groupBy("component").agg(F.min(row).alias("row"))
    stay = linked.select("row.doc_id", "row.text_hash").unionAll(
        made.where("component is null").select("doc_id", "text_hash")).select(
        key("doc_id", F.col("text_hash")).alias("_key")).distinct()
    # the documents' own columns keep a prefix meanwhile, whatever their names
    keyed = docs.toDF(*[f"_own_{c}" for c in docs.columns]).withColumn(
        "_key", key("_own_doc_id", F.xxhash64("_own_text")))
    once = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    return (keyed.join(stay, "_key").withColumn("_once", once).where("_once = 1")
            .select(*[F.col(f"`_own_{c}`").alias(c) for c in docs.columns]))
