"""Operator 3: toxicity by class-conditional Kneser-Ney models.

Method: toxic and ordinary training texts each give a bigram model with
modified Kneser-Ney discounting (discounts D1, D2, D3+ of each class and
order from its counts of counts):

    p(w|h) = (1 - B) * f(hw) / p(h) + B * ((1 - B) * g(hw) / g(h) + B * p(w))
    p(w)   = (1 - A) * f(w) + A * shared(w)

``f`` are a class's discounted relative frequencies, ``g`` those of both
classes together, and ``shared(w)`` follows the number of different words
before w in the texts of both (continuation counts).  Both classes back off
to the same counts with the same weights A and B, so an expression that is
rare or unknown in either class is as likely in both and says nothing.  A
text is described by the difference of its log-likelihoods per word: over
the whole text, in the ``WINDOW`` words where it is largest (few bad words in
a long text), and of the words that differ by more than ``CLEAR``, in all and
per word; and by its length.  A logistic regression turns that into a score.

Counts cover every labelled training text: all real words and pairs by class,
told apart by 64-bit hashes (the first word of a pair by 52 bits beside its
second), and the exact number of different words before each word.  Tasks sum
the pairs that they hold and send them packed, dealt by both words, so that a
common word's pairs go to ``2 ** SPREAD`` places; there each place's pairs are
summed, and Spark's groupBy sums the words.  Nothing is folded into tables of
fixed size, so the model grows with the vocabulary: broadcast are the words of
``WORD_SUPPORT`` and the pairs of ``PAIR_SUPPORT`` occurrences or more.  All
others back off to the same value in both classes, whose difference is zero
whatever it is, so leaving them out of the broadcast changes no score.

Only labelled texts are shuffled, deflated: a bitmap of the labels' ids of
fixed size goes before the join, which then decides exactly.  The regression is
fitted on another fold than the counts that describe it (folds 0 and 1 describe
at most about ``calibration_rows`` rows of fold 3, before these meet their
labels, so that no text moves); that fold is then counted too, and the final
model has the counts of all training folds.

Defined results: NULL and empty texts get the share of toxic training rows
as score; without toxic or without ordinary training texts every score is
0; labels are joined by id, repeated ones count once (toxic wins), NULL ids
or labels never; repeated documents are scored alike; extra columns stay, a
column named like an output is replaced; empty tables give empty tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import SLICE_BYTES, flat, give_back, share, slices, written
from .words import LOWER, boundaries, mix, word_hashes

WINDOW = 32
WORD_SUPPORT, PAIR_SUPPORT = 2, 8    # occurrences from which an expression is not rare
CLEAR = 1.0                     # difference of log-likelihoods
HELD = 1 << 20                  # different pairs that a task holds before it sends them
PLACES, SPREAD = 8, 4           # bits of the last and of the first word by which pairs are dealt
MAP_BITS = 24
MADE = ["score", "predicted"]
FEATURES = ["whole", "worst", "clear", "clear_share", "size"]

#: Bits by which the first word of a pair is known, 48 and ``SPREAD``.
HEAD = np.uint64((1 << 48 + SPREAD) - 1)

#: Bytes between words: ASCII other than letters and digits.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def pairs_of(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of each pair of words."""
    return mix(head * np.uint64(0x9E3779B97F4A7C15) + word)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words of all texts: hash, ``HEAD`` bits of the word before, and
    whether there is one in its text; and each text's first word."""
    data, at = flat(texts)
    data = LOWER[data]
    starts, ends, first = boundaries(data, at, BETWEEN)
    h = word_hashes(data, starts, ends)
    begins = first[:-1][first[:-1] < len(h)]
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[begins] = 7
    inner = np.ones(len(h), bool)
    inner[begins] = False
    return h, before & HEAD, inner, first


@dataclass
class Counts:
    """Of the words and pairs with support, in order of their hashes: counts
    by class (0 ordinary, 1 toxic); of words also the number of different
    words before, and of all words the sum of those."""

    words: np.ndarray
    word: np.ndarray
    before: np.ndarray
    all_before: int
    pairs: np.ndarray
    pair: np.ndarray


#: Counts of a pair: folds 0 and 1 by class, fold 3 by class.
KINDS = ["a0", "a1", "b0", "b1"]


Pairs = tuple[np.ndarray, np.ndarray, np.ndarray]       # first words, last words, counts as in KINDS


def _narrow(counts: np.ndarray) -> np.ndarray:
    """``counts`` in the smallest type that holds them all."""
    most = counts.max(initial=0)
    return counts.astype(next((k for k in (np.uint8, np.uint16, np.uint32) if most <= np.iinfo(k).max), np.int64))


def _summed(parts: list[Pairs]) -> Pairs:
    """Each pair once, in order of its place, last and first word; empties
    ``parts``, to hold them once."""
    head, word, counts = map(np.concatenate, zip(*parts, strict=True))
    parts.clear()
    order = np.lexsort((head, word, _place_of(head, word)))
    head, word = head[order], word[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (head[1:] != head[:-1])
    begin = np.flatnonzero(new)
    if not len(begin):
        return head, word, counts
    return head[begin], word[begin], np.column_stack(
        [_narrow(np.add.reduceat(column[order], begin, dtype=np.int64)) for column in counts.T])


def _place_of(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    return ((word >> np.uint64(64 - PLACES)) << np.uint64(SPREAD) | head >> np.uint64(48)).astype(np.int32)


def _packed(pairs: Pairs) -> Iterator[pa.RecordBatch]:
    """(place, data): the pairs of each place; a word's pairs follow it, as the
    lower 48 bits of their first words and their counts."""
    head, word, counts = pairs
    place = _place_of(head, word)
    cuts = np.append(np.flatnonzero(np.append(True, place[1:] != place[:-1])), len(place)) if len(place) else [0]
    data = []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        words, sizes = np.unique(word[low:high], return_counts=True)
        kind = np.uint8 if counts[low:high].max() < 256 else np.int64
        data.append(np.array([len(words), high - low, kind == np.uint8], np.int64).tobytes() + words.tobytes()
                    + np.ascontiguousarray(head[low:high].view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
                    + zlib.compress(sizes.astype(np.int64).tobytes() + counts[low:high].astype(kind).T.tobytes(), 1))
    yield pa.RecordBatch.from_arrays([pa.array(place[cuts[:-1]] if len(data) else [], pa.int32()),
                                      pa.array(data, pa.binary())], ["place", "data"])


def _unpacked(place: int, data: bytes) -> Pairs:
    n_words, n, small = np.frombuffer(data, np.int64, 3).tolist()
    words = np.frombuffer(data, np.uint64, n_words, 24)
    at = 24 + 8 * n_words
    head = np.zeros((n, 8), np.uint8)
    head[:, :6] = np.frombuffer(data, np.uint8, 6 * n, at).reshape(n, 6)
    rest = zlib.decompress(data[at + 6 * n:])
    sizes = np.frombuffer(rest, np.int64, n_words)
    counts = np.frombuffer(rest, np.uint8 if small else np.int64, offset=8 * n_words).reshape(len(KINDS), n).T
    above = np.uint64((place & (1 << SPREAD) - 1) << 48)
    return head.reshape(-1).view(np.uint64) | above, np.repeat(words, sizes), counts


def _inflated(deflated: pa.Array) -> Iterator[pa.Array]:
    """The texts (NULL: empty) in parts of about ``SLICE_BYTES``."""
    held: list[bytes] = []
    size = 0
    for t in deflated:
        held.append(zlib.decompress(t.as_buffer()) if t.is_valid else b"")
        size += len(held[-1])
        if size >= SLICE_BYTES:
            yield pa.array(held, pa.large_binary())
            held, size = [], 0
    if held:
        yield pa.array(held, pa.large_binary())


def _counted(labelled: DataFrame) -> DataFrame:
    """Of rows (deflated, toxic, fold), two kinds of rows: of pairs with support
    (pair, counts as in ``KINDS``), and of words, once for each place that has
    pairs of it, (word, counts, before_a, before): different words before in
    folds 0 and 1, and in all."""
    share(labelled.sparkSession, None)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Pairs] = []
        size = 0
        for batch in batches:
            kind = batch.column(1).to_numpy(zero_copy_only=False) + 2 * (batch.column(2).to_numpy(zero_copy_only=False) == 3)
            row = 0
            for part in _inflated(batch.column(0)):
                h, before, _, first = tokens(part)
                mine = np.repeat(kind[row:row + len(part)], np.diff(first))
                row += len(part)
                held.append(_summed([(before, h, (mine[:, None] == np.arange(len(KINDS))).view(np.uint8))]))
                size += len(held[-1][0])
                if size > 2 * HELD:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size > HELD:
                        yield from _packed(held[0])
                        held, size = [], 0
        if held:
            yield from _packed(_summed(held))
        held = []
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Pairs] = []
        size, last = 0, None
        for batch in batches:
            for place, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if place != last and size > HELD // 4:
                    yield from totals(held)
                    held, size = [], 0
                last = place
                held.append(_unpacked(place, data.as_py()))
                size += len(held[-1][0])
        if held:
            yield from totals(held)
        held = []
        give_back()

    def totals(held: list[Pairs]) -> Iterator[pa.RecordBatch]:
        """The places in ``held``, which are whole."""
        head, word, counts = _summed(held)
        often = np.flatnonzero(counts.sum(axis=1) >= PAIR_SUPPORT)
        yield rows("pair", pairs_of(head[often], word[often]), np.column_stack(
            [counts[often], np.zeros((len(often), 2), np.int64)]))
        order = np.argsort(word, kind="stable")
        word, counts = word[order], counts[order]
        begin = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
        if len(begin):
            seen = np.column_stack([counts, counts[:, :2].any(axis=1), np.ones(len(word), np.int64)])
            yield rows("word", word[begin], np.add.reduceat(seen, begin, axis=0))

    def rows(name: str, keys: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
        none, own = pa.nulls(len(keys), pa.int64()), pa.array(np.ascontiguousarray(keys).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [own if name == "pair" else none, own if name == "word" else none,
             *[pa.array(np.ascontiguousarray(numbers[:, i])) for i in range(numbers.shape[1])]],
            ["pair", "word", *KINDS, "before_a", "before"])

    sent = labelled.select("deflated", "toxic", "fold").mapInArrow(count, "place int, data binary")
    numbers = ", ".join(f"{k} long" for k in [*KINDS, "before_a", "before"])
    return (sent.repartition("place").sortWithinPartitions("place")
            .mapInArrow(add, f"pair long, word long, {numbers}"))


def _gathered(counted: DataFrame) -> tuple[Counts, Counts]:
    """Counts of folds 0 and 1, and of all training folds."""
    every = sum((F.col(k) for k in KINDS[1:]), F.col(KINDS[0]))
    numbers = [*KINDS, "before_a", "before"]
    words = counted.where("word is not null").groupBy("word").agg(*[F.sum(k).alias(k) for k in numbers])
    totals = counted.where("word is not null").agg(
        F.coalesce(F.sum("before_a"), F.lit(0)), F.coalesce(F.sum("before"), F.lit(0))).first()
    words = words.where(every >= WORD_SUPPORT).toArrow()
    most = counted.where("pair is not null").select("pair", *KINDS).toArrow()

    def ordered(table: pa.Table, key: str, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        keys = table.column(key).to_numpy().view(np.uint64)
        order = np.argsort(keys)
        return keys[order], np.array([table.column(n).to_numpy()[order] for n in names], np.int64).reshape(len(names), -1)

    w, wn = ordered(words, "word", [*KINDS, "before_a", "before"])
    p, pn = ordered(most, "pair", KINDS)

    def chosen(word: np.ndarray, pair: np.ndarray, before: np.ndarray, total: int) -> Counts:
        some, often = word.sum(axis=0) >= WORD_SUPPORT, pair.sum(axis=0) >= PAIR_SUPPORT
        return Counts(w[some], word[:, some], before[some], total, p[often], pair[:, often])

    return (chosen(wn[:2], pn[:2], wn[4], totals[0]),
            chosen(wn[:2] + wn[2:4], pn[:2] + pn[2:4], wn[5], totals[1]))


def _place(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Positions in the sorted ``known``; its length for what is not in it."""
    if not len(known):
        return np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return np.where(known[at] == asked, at, len(known))


class Model:
    """The two models and the regression over their scores."""

    def __init__(self, counts: Counts):
        self.words, self.pairs = counts.words, counts.pairs
        shared = counts.before / max(counts.all_before, 1)
        words, a = zip(*[self._discounted(counts.word[k]) for k in (0, 1)], strict=True)
        pairs, b = zip(*[self._discounted(counts.pair[k]) for k in (0, 1)], strict=True)
        a, self.back = max(a), min(max(b), 0.5)
        # the last entry stands for all without support: the same in both classes
        self.word = [np.append((1 - a) * f + a * shared, 1).astype(np.float32) for f in words]
        self.pair = [np.append((1 - self.back) * f, 0).astype(np.float32) for f in pairs]
        both, _ = self._discounted(counts.word.sum(axis=0))
        self.both = np.append((1 - a) * both + a * shared, 1).astype(np.float32)
        both, _ = self._discounted(counts.pair.sum(axis=0))
        self.both_pair = np.append((1 - self.back) * both, 0).astype(np.float32)
        self.weights: np.ndarray | None = None
        self.center = self.scale = np.zeros(0)
        self.base = 0.0

    @staticmethod
    def _discounted(count: np.ndarray) -> tuple[np.ndarray, float]:
        """Discounted relative frequencies, and the share of what was taken."""
        n = np.bincount(np.minimum(count, 5), minlength=6).astype(np.float64)
        y = n[1] / max(n[1] + 2 * n[2], 1)
        d = np.array([0.0, *[i - (i + 1) * y * n[i + 1] / max(n[i], 1) for i in (1, 2, 3)]])
        left = count - np.clip(d, 0, [0, 1, 2, 3])[np.minimum(count, 3)]
        total = max(left.sum(), 1e-9)
        return left / total, float(np.clip(1 - total / max(count.sum(), 1), 0.01, 0.99))

    def features(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A row a text, as the module says; and its number of words."""
        h, before, inner, first = tokens(texts)
        word, pair = _place(self.words, h), np.full(len(h), len(self.pairs))
        head = np.roll(word, 1)
        both = np.flatnonzero(inner & (word < len(self.words)) & (head < len(self.words)))
        pair[both] = _place(self.pairs, pairs_of(before[both], h[both]))
        logs = []
        common = self.both_pair[pair] / self.both[head]
        for k in (0, 1):
            known = self.pair[k][pair] / self.word[k][head]
            logs.append(np.log(known + self.back * (common + self.back * self.word[k][word])))
        clear = np.concatenate([[0.0], np.cumsum(np.maximum(logs[1] - logs[0] - CLEAR, 0).astype(np.float64))])
        gain = np.concatenate([[0.0], np.cumsum((logs[1] - logs[0]).astype(np.float64))])
        n = np.diff(first)
        whole = (gain[first[1:]] - gain[first[:-1]]) / np.maximum(n, 1)
        # of each position, the window that begins there, cut at the text's end
        last = np.minimum(np.arange(len(word)) + WINDOW, np.repeat(first[1:], n))
        window = (gain[last] - gain[np.arange(len(word))]) / WINDOW
        worst = np.zeros(len(n))
        some = np.flatnonzero(n)
        if len(some):
            worst[some] = np.maximum.reduceat(window, first[some])
        total = clear[first[1:]] - clear[first[:-1]]
        return np.column_stack([whole, worst, np.log1p(total), np.log1p(100 * total / np.maximum(n, 1)),
                                np.log1p(n)]), n

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Logistic regression by Newton's method, lightly regularised."""
        self.base = float(y.mean()) if len(y) else 0.0
        if not len(y) or y.min() == y.max():
            return
        self.center, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._expanded(x)
        w = np.zeros(z.shape[1])
        penalty = np.eye(z.shape[1]) * 1e-3 * len(y)
        penalty[-1, -1] = 0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hessian = (z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(z.shape[1])
            step = np.linalg.solve(hessian, z.T @ (y - p) - penalty @ w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def _expanded(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.center) / self.scale
        return np.column_stack([z, z[:, :-1] * z[:, -1:], np.ones(len(z))])

    def score(self, texts: pa.Array) -> np.ndarray:
        """Score of each text, 0 to 1."""
        x, n = self.features(texts)
        if self.weights is None:
            return np.full(len(n), self.base)
        p = 1 / (1 + np.exp(-np.clip(self._expanded(x) @ self.weights, -30, 30)))
        return np.where(n > 0, p, self.base)


def _known(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic), each labelled id once."""
    return (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
            .agg(F.max("toxic").cast("int").alias("toxic")))


def _maybe_labelled(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``docs`` without most rows that have no label, by a bitmap of the ids."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << MAP_BITS)).alias("place")
    words = (known.select(place).select((F.col("place") / 64).cast("int").alias("w"),
                                        F.expr("shiftleft(1L, cast(place % 64 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    bitmap = np.zeros(1 << (MAP_BITS - 6), np.int64)
    bitmap[words.column("w").to_numpy()] = words.column("b").to_numpy()
    sent = share(docs.sparkSession, bitmap)

    @F.arrow_udf("boolean")
    def maybe(places: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for p in places:
            at = p.to_numpy(zero_copy_only=False).astype(np.uint64)
            yield pa.array((sent.value.view(np.uint64)[at >> np.uint64(6)] >> (at & np.uint64(63))
                            & np.uint64(1)).astype(bool))
        give_back()

    return docs.where("doc_id is not null").withColumn("place", place).where(maybe("place")).drop("place")


def _with_labels(docs: DataFrame, labels: DataFrame, text: str) -> DataFrame:
    """(doc_id, deflated, toxic, fold) of the labelled documents: their texts
    cross the join's shuffle deflated."""
    @F.arrow_udf("binary")
    def deflate(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([zlib.compress(t.as_buffer()) if t.is_valid else None for t in batch], pa.binary())
        give_back()

    known = _known(labels)
    rows = _maybe_labelled(docs.select("doc_id", F.col(text).alias("text")), known)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return (rows.select("doc_id", deflate("text").alias("deflated")).join(known, "doc_id")
            .select("doc_id", "deflated", "toxic", fold.alias("fold")))


def _described(docs: DataFrame, labels: DataFrame, text: str, model: Model) -> DataFrame:
    """(x, toxic) of the labelled documents: the numbers in ``FEATURES`` and the
    number of words, made before the join, so that no text is shuffled."""
    sent = share(docs.sparkSession, model)

    @F.arrow_udf("array<double>")
    def describe(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [np.column_stack(sent.value.features(part)) for part in slices(batch)]
            x = np.concatenate(found or [np.zeros((0, len(FEATURES) + 1))])
            at = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
            yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x.reshape(-1)))
        give_back()

    known = _known(labels)
    rows = _maybe_labelled(docs.select("doc_id", F.col(text).alias("text")), known)
    return rows.select("doc_id", describe("text").alias("x")).join(known, "doc_id").select("x", "toxic")


def train(docs: DataFrame, labels: DataFrame, text: str = "text", calibration_rows: int = 20_000) -> Model:
    """Model of the labelled rows: folds 0, 1 and 3 of crc32(doc_id) mod 4 are
    counted; described by folds 0 and 1 alone, about ``calibration_rows`` of
    fold 3 fit the regression; fold 2 is never read."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    counted = written(_counted(_with_labels(docs.where(fold != 2), labels, text)), "toxicity-counts")
    early, every = _gathered(counted)
    model, final = Model(early), Model(every)
    if not early.word.any(axis=1).all():
        return final
    ids = labels.where("doc_id is not null and toxic is not null").where(fold == 3).select("doc_id").distinct()
    n = ids.count()
    some = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1, calibration_rows / max(n, 1)))
    got = _described(docs.where((fold == 3) & some), labels, text, model).toArrow()
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES) + 1)
    some_words = x[:, -1] > 0
    final.fit(x[some_words, :-1], got.column("toxic").to_numpy()[some_words].astype(float))
    return final


def judge(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    sent = share(docs.sparkSession, model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [sent.value.score(part) for part in slices(batch)]
            yield pa.array(np.concatenate(found or [np.zeros(0)]), pa.float64())
        give_back()

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in MADE]
    return docs.select(*kept, score(F.col(text)).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
