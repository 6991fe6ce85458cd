"""Operator 5: document fingerprints by SimHash.

Method: the terms of a text are its words and word pairs; each term's hash
gives ``BITS`` signed bits, and every term votes on them with its weight, the
square root of its count, a pair counting ``PAIR_WEIGHT`` times a word.  The signs of
the sums are the fingerprint.  The likeness of two fingerprints is the share
of equal bits.

The search for fingerprints within a Hamming radius uses permuted block
tables.  The bits are dealt, by a fixed permutation, into ``radius + SPARE``
blocks, so two fingerprints within the radius agree in at least ``SPARE`` of
them.  The blocks lie in ``SPARE - 1`` classes; two of the common blocks are
therefore in one class, and each pair of blocks of a class is a table keyed by
the bits of both (21 bits at radius 16, in 30 tables).  Equal fingerprints
enter once, so a group of copies is one entry.

``near_pairs`` reports every pair.  ``near_groups``, which the query uses,
gives each fingerprint the smallest document that it reaches by links.  The
entries are shuffled once, by key, and come to a task in order: up to ``FEW``
entries of a key are compared with each other; those of a larger key are
reached from leaders, each of which is compared with the entries not reached
yet.  Pairs that links connect already are left out, so a group of near copies
has about as many links in a key as members, and no connection is lost.  A task holds the fingerprints of one key at least, 40
bytes each, and compares members with what no member is near to.  ``RADIUS``
follows the measured distances of near copies; README gives the share it finds
by length of text.

``with_next`` gives every document the next one's text by ascending id.  The
ids are cut into ranges at approximate quantiles; a range's rows and the
first row of the range behind it meet in one task, in order, so every text
is shuffled once, compressed, and no window spans the table.

Defined results: NULL is an empty text; texts without words have the
fingerprint of no votes (all bits zero); rows are ordered by id, NULLs
first, then text hash; repeated rows are documents of their own; the only
document is its own next; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .components import components
from .tables import flat, give_back, share, slices, written
from .words import LOWER, SPACES, boundaries, mix, word_hashes

BITS = 256
PAIR_WEIGHT = 2.0
RADIUS = 16             # bits, of near copies
SPARE = 8               # blocks more than the radius
LEADERS = 64            # entries of a large key that are compared at once with those not reached
FEW = 16                # entries of a key that are compared with each other
PAIRS = 1 << 18         # distances taken at once
HELD = 1 << 16          # entries that a task takes at once, a key's being whole
WORDS = BITS // 64
RANGE_ROWS = 4096       # documents a range of ids, about
MAX_RANGES = 100_000    # their bounds are what the driver collects


def fingerprints(texts: pa.Array) -> np.ndarray:
    """A row of ``BITS / 8`` bytes for each text."""
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    row = 0
    for part in slices(texts, 1 << 20):
        data, at = flat(part)
        data = LOWER[data]
        starts, ends, first = boundaries(data, at, SPACES)
        word = word_hashes(data, starts, ends)
        n = np.diff(first)
        owner = np.repeat(np.arange(len(part)), n)
        inner = np.ones(len(word), bool)                 # words that end a pair
        inner[first[:-1][n > 0]] = False
        ends_pair = np.flatnonzero(inner)
        pair = mix(word[ends_pair - 1] * np.uint64(0x9E3779B97F4A7C15) + word[ends_pair])
        # the lowest bit of a term tells words and pairs apart
        terms = np.concatenate([word | np.uint64(1), pair & ~np.uint64(1)])
        whose = np.concatenate([owner, owner[ends_pair]])
        order = np.lexsort((terms, whose))
        terms, whose = terms[order], whose[order]
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (whose[1:] != whose[:-1])
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(terms)))
        terms, whose = terms[begin], whose[begin]
        weight = np.sqrt(count) * np.where(terms & np.uint64(1), 1.0, PAIR_WEIGHT)
        upto = np.searchsorted(whose, np.arange(len(part) + 1))
        lanes = np.stack([mix(terms + np.uint64(0x632BE59BD9B4E019 * (i + 1) % 2**64))
                          for i in range(BITS // 64)], axis=1)
        for i in range(len(part)):
            low, high = upto[i], upto[i + 1]
            if low == high:
                continue
            votes = np.zeros(BITS)
            for a in range(low, high, 8192):             # a long text votes in parts
                b = min(a + 8192, high)
                signs = np.unpackbits(lanes[a:b].view(np.uint8), axis=1).astype(np.float32)
                votes += weight[a:b].astype(np.float32) @ signs
            out[row + i] = np.packbits(2 * votes > weight[low:high].sum())
        row += len(part)
    return out


def likeness(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Share of equal bits, row by row."""
    return 1 - np.unpackbits(one ^ two, axis=1).sum(axis=1) / BITS


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint`` (binary) in place of a column so named."""
    share(docs.sparkSession, None)

    @F.arrow_udf("binary")
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([r.tobytes() for r in fingerprints(batch)], pa.binary())

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "fingerprint"]
    return docs.select(*kept, make(F.col(text)).alias("fingerprint"))


def with_next(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (part, extra, doc_id, text), each part in one partition and in
    order: every row that is not ``extra`` is followed by the next document
    (the last of all by the first), each part ends with an extra row.  The
    text is compressed (zstandard)."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).withColumns(
        {"known": F.col("doc_id").isNotNull(), "h": F.xxhash64("text")})
    ids = docs.where("doc_id is not null")
    ranges = max(1, min(MAX_RANGES, ids.count() // RANGE_ROWS))
    bounds = np.zeros(0, np.int64)
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        got = ids.agg(F.percentile_approx("doc_id", shares, 20 * ranges).alias("b")).first()["b"]
        bounds = np.unique(np.array(got, np.int64))
    sent = share(spark, bounds)

    def parts_of(batch: pa.Array) -> np.ndarray:
        at = np.searchsorted(sent.value, batch.fill_null(0).to_numpy(), "right").astype(np.int32)
        return np.where(batch.is_valid().to_numpy(zero_copy_only=False), at, 0)

    @F.arrow_udf("int")
    def range_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(parts_of(batch))

    @F.arrow_udf("part int, text binary")       # one function, so that a task needs one worker
    def placed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for ids, texts in batches:
            packed = pa.array([pack(t.as_py().encode()) for t in texts], pa.binary())
            yield pa.StructArray.from_arrays([pa.array(parts_of(ids)), packed], ["part", "text"])
        give_back()

    part = range_of(F.col("doc_id").cast("long")).alias("part")
    order = ["known", "doc_id", "h"]
    first = sorted(rows.select(part, *order).groupBy("part").agg(F.min(F.struct(*order)).alias("first")).collect(),
                   key=lambda r: r["part"])
    if not first:
        return rows.select(F.lit(0).alias("part"), F.lit(False).alias("extra"), "doc_id",
                           F.col("text").cast("binary").alias("text"))
    known = spark.createDataFrame(
        [(r["part"], first[i - 1]["part"], *r["first"]) for i, r in enumerate(first)],
        T.StructType([T.StructField("part", T.IntegerType()), T.StructField("before", T.IntegerType()),
                      *[T.StructField(f"f_{c}", rows.schema[c].dataType) for c in order]]))
    same = F.col("doc_id").eqNullSafe(F.col("f_doc_id")) & (F.col("h") == F.col("f_h"))
    extra = (rows.join(F.broadcast(known.drop("part")), same)               # at most MAX_RANGES rows
             .withColumnRenamed("before", "part").dropDuplicates(["part"]))
    here = placed(F.col("doc_id").cast("long"), F.col("text")).alias("placed")
    own = rows.select(here, *order).select("placed.part", F.lit(False).alias("extra"), "placed.text", *order)
    extra = extra.select("part", here, *order).select("part", F.lit(True).alias("extra"), "placed.text", *order)
    both = own.unionByName(extra)
    return (both.repartition("part").sortWithinPartitions("part", "extra", *order)
            .select("part", "extra", "doc_id", "text"))


def compare(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_chars, edited_sha256 (of the text whose
    last half of code points is replaced by the first as many of the next
    document), fingerprint and edited_fingerprint (hex), and the likeness of
    the fingerprint to the edited one and to the next document's."""
    rows = with_next(docs, text)
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)] + T._parse_datatype_string(
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double").fields)

    ids = to_arrow_type(rows.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: list[tuple] = []                  # rows whose next is still to come, 1 MiB of text about
        size = 0
        for batch in batches:
            for extra, doc_id, text in zip(*[batch.column(i) for i in (1, 2, 3)], strict=True):
                text = unpack(text.as_py()).decode()
                held.append((extra.as_py(), doc_id.as_py(), text))
                size += len(text)
                if size > 1 << 20 and len(held) > 1:
                    yield described(held)
                    held, size = held[-1:], len(text)
        if len(held) > 1:
            yield described(held)
        give_back()

    def described(rows: list[tuple]) -> pa.RecordBatch:
        """All rows but the last, those that are extra left out."""
        texts = [t for *_, t in rows]
        own = fingerprints(pa.array(texts, pa.string()))
        which = np.array([i for i, (extra, *_) in enumerate(rows[:-1]) if not extra], np.int64)
        edited = []
        for i in which.tolist():
            half = len(texts[i]) // 2
            edited.append(texts[i][:len(texts[i]) - half] + texts[i + 1][:half])
        other = fingerprints(pa.array(edited, pa.string()))
        hexes = [r.tobytes().hex() for r in own[which]]
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][1] for i in which.tolist()], ids), pa.array([len(texts[i]) for i in which.tolist()], pa.int64()),
             pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
             pa.array(hexes, pa.string()), pa.array([r.tobytes().hex() for r in other], pa.string()),
             pa.array(likeness(own[which], other)), pa.array(likeness(own[which], own[which + 1]))],
            names=schema.names)

    return rows.mapInArrow(run, schema)


def block_masks(radius: int) -> list[list[int]]:
    """The bits of each table's key, as ``WORDS`` signed 64-bit masks."""
    order = np.argsort(mix(np.arange(BITS, dtype=np.uint64)))       # the fixed permutation
    blocks = np.array_split(order, radius + SPARE)
    masks = []
    for members in (range(c, len(blocks), SPARE - 1) for c in range(SPARE - 1)):
        for one, two in combinations(members, 2):
            chosen = np.zeros(BITS, np.uint8)
            chosen[[*blocks[one], *blocks[two]]] = 1
            masks.append(np.packbits(chosen).view(">i8").tolist())
    return masks


_COLUMNS = [f"b{i}" for i in range(WORDS)]


def _entries(prints: DataFrame, masks: list[list[int]]) -> DataFrame:
    """(table, key, bits): every fingerprint's entry in every table."""
    bits = [F.conv(F.substring("fingerprint", 1 + 16 * i, 16), 16, -10).cast("long").alias(c) for i, c in enumerate(_COLUMNS)]
    rows = prints.select(*bits)
    keys = [F.xxhash64(F.lit(k), *[F.col(c).bitwiseAND(F.lit(m)) for c, m in zip(_COLUMNS, mask, strict=True)])
            for k, mask in enumerate(masks)]
    return rows.select(*_COLUMNS, F.posexplode(F.array(*keys)).alias("table", "key"))


def _distance(one: str, two: str) -> Column:
    return sum((F.bit_count(F.col(f"{one}.{c}").bitwiseXOR(F.col(f"{two}.{c}"))) for c in _COLUMNS), F.lit(0))


def _bits(side: str) -> Column:
    return F.struct(*[F.col(f"{side}.{c}") for c in _COLUMNS])


def _hex(bits: str) -> Column:
    """The hex string of a struct of words."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.col(f"{bits}.b{i}")), 16, "0") for i in range(WORDS)]))


def near_pairs(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b, distance): all pairs a < b of different fingerprints (hex
    strings in the column ``fingerprint``) at most ``radius`` bits apart, each
    reported by the first table that has it."""
    masks = block_masks(radius)
    known = prints.where("fingerprint is not null").select("fingerprint").distinct()
    entries = _entries(written(known, "prints"), masks)
    one, two = entries.alias("one"), entries.alias("two")
    apart = [F.col(f"one.{c}").bitwiseXOR(F.col(f"two.{c}")) for c in _COLUMNS]

    def agree(mask: list[int]) -> Column:
        found = F.lit(True)
        for x, m in zip(apart, mask, strict=True):
            found = found & (x.bitwiseAND(F.lit(m)) == 0)
        return found

    first = F.coalesce(*[F.when(agree(mask), F.lit(k)) for k, mask in enumerate(masks)], F.lit(-1))
    distance = _distance("one", "two")
    pairs = one.join(two, (F.col("one.key") == F.col("two.key")) & (_bits("one") < _bits("two"))
                     & (distance <= radius) & (F.col("one.table") == first) & (F.col("two.table") == first))
    pairs = pairs.select(_bits("one").alias("a"), _bits("two").alias("b"), distance.alias("distance"))
    pairs = pairs.select(_hex("a").alias("a"), _hex("b").alias("b"), "distance")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")


def _apart(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of words."""
    return np.bitwise_count(one ^ two).sum(axis=-1, dtype=np.int64)


def _forest(words: np.ndarray, radius: int, leaders: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (one, two) of links that connect the rows of ``words`` as all
    pairs within the radius do, each row but one of a component once as
    ``two``.  ``leaders`` reached rows at a time are compared with the rows
    that were not reached; those they are near to are compared next."""
    left = np.argsort(mix(np.bitwise_xor.reduce(words, axis=1)), kind="stable")     # tables agree on first leaders
    reached = left[:0]
    links = [(reached, reached)]
    while len(left):
        if not len(reached):
            reached, left = left[:1], left[1:]
        lead, reached = reached[:leaders], reached[leaders:]
        step = max(1, PAIRS // len(lead))
        kept, found = [], []
        for low in range(0, len(left), step):
            rest = left[low:low + step]
            near = _apart(words[lead][:, None], words[rest][None]) <= radius
            hit = near.any(axis=0)
            links.append((lead[near.argmax(axis=0)[hit]], rest[hit]))
            found.append(rest[hit])
            kept.append(rest[~hit])
        if kept:
            left, reached = np.concatenate(kept), np.concatenate([reached, *found])
    return tuple(np.concatenate(x) for x in zip(*links, strict=True))


def _key_links(keys: np.ndarray, words: np.ndarray, radius: int, leaders: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the entries of each of ``keys``, which are in order."""
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    size = np.diff(np.append(begin, len(keys)))
    behind = np.repeat(begin + size, size) - np.arange(len(keys))       # entries of the key from this one on
    behind[np.repeat(size, size) > FEW] = 0
    links = []
    root = np.arange(len(keys))                 # equal only if links so far connect
    for d in range(1, FEW):
        one = np.flatnonzero(behind > d)
        if not len(one):
            break
        one = one[_apart(words[one], words[one + d]) <= radius]
        one = one[root[one] != root[one + d]]
        links.append((one, one + d))
        np.minimum.at(root, np.maximum(root[one], root[one + d]), np.minimum(root[one], root[one + d]))
        while len(one) and (root[root] != root).any():
            root = root[root]
    for k in np.flatnonzero(size > FEW):
        one, two = _forest(words[begin[k]:begin[k] + size[k]], radius, leaders)
        links.append((begin[k] + one, begin[k] + two))
    if not links:
        return begin[:0], begin[:0]
    return tuple(np.concatenate(x) for x in zip(*links, strict=True))


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): links between fingerprints at most ``radius`` bits apart that
    connect the same fingerprints as all such pairs do; some repeat."""
    leaders = LEADERS
    share(prints.sparkSession, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []      # of keys in order, the last of which may go on
        size, limit = 0, HELD
        for batch in batches:
            held.append((batch.column(0).to_numpy(), np.column_stack([batch.column(1 + i).to_numpy() for i in range(WORDS)]).view(np.uint64)))
            size += len(batch)
            if size < limit:
                continue
            keys, words = map(np.concatenate, zip(*held, strict=True))
            last = int(np.searchsorted(keys, keys[-1]))
            yield from found(keys[:last], words[:last])
            held, size = [(keys[last:], words[last:])], len(keys) - last
            limit = max(HELD, 2 * size)
        if held:
            yield from found(*map(np.concatenate, zip(*held, strict=True)))
        give_back()

    def found(keys: np.ndarray, words: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        one, two = _key_links(keys, words, radius, leaders)
        for low in range(0, len(one), HELD):
            part = np.concatenate([words[one[low:low + HELD]], words[two[low:low + HELD]]], axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in part.T], names)

    names = [f"{side}_{c}" for side in "uv" for c in _COLUMNS]
    entries = _entries(prints, block_masks(radius)).select("key", *_COLUMNS).repartition("key").sortWithinPartitions("key")
    links = entries.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    return links.select(*[F.struct(*[F.col(f"{side}_{c}").alias(c) for c in _COLUMNS]).alias(side) for side in "uv"])


def near_groups(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, near_id) of ``prints`` (fingerprint, first_id): the
    smallest first_id that links reach."""
    prints = written(prints, "prints")
    roots = components(near_links(prints.where("fingerprint is not null"), radius))
    of = prints.join(roots.select(_hex("node").alias("fingerprint"), _hex("root").alias("root")), "fingerprint", "left")
    of = of.select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root"))
    least = of.groupBy("root").agg(F.min("first_id").alias("near_id"))
    return of.join(least, "root").select("fingerprint", "near_id")


def with_near(described: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``described`` (with ``fingerprint`` and ``doc_id``) and ``near_id``: the
    smallest id among the documents whose fingerprints are linked to its own,
    copies and itself included (NULL if none of them has an id)."""
    described = written(described, "described")
    groups = near_groups(described.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), radius)
    return described.join(groups, "fingerprint", "left").select(*described.columns, "near_id")
