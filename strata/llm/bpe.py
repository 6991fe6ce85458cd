"""Operator 9: byte-level BPE encoding and decoding.

Method: the pieces (pattern matches) of a slice of texts that are not known
yet are laid out in padded numpy matrices, one matrix per length bucket, a
row per piece.  In every round each row merges its leftmost pair of minimum
rank: ranks of all adjacent pairs sit in a second matrix, ``argmin`` finds
the pair, both matrices are compacted by one column behind it, and only the
two pairs that touch the new token are looked up again in an open-addressing
hash table of pairs.  Rows without a mergeable pair leave the matrix.

A piece that is itself a token becomes that token, as the rank files'
library does.  Pieces longer than ``LONG_PIECE`` bytes would make very wide
matrices of very few rows; they follow the same rule (leftmost pair of
minimum rank first) with a heap over a linked list.

Spark partitions the texts; the rank file is read on the driver and its
bytes are broadcast (a vocabulary file, its size checked).  A task keeps
the pieces it has encoded in a dictionary that is emptied at
``KNOWN_PIECES`` entries, so memory is bounded and no result depends on it.

Defined results: a NULL or empty text has no ids and decodes to nothing;
repeated rows each give a row; the extra columns of ``docs`` stay, a column
that clashes with an output name is replaced; an empty table gives an empty
table.  Decoding is the concatenation of the tokens' bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import give_back, share, slices

NONE = np.int32(2**31 - 1)
LONG_PIECE = 1024
KNOWN_PIECES = 120_000
SLICE = 1 << 20                     # bytes of text encoded at once
MAX_RANK_FILE_BYTES = 64 << 20      # bound of what encode() broadcasts


class Ragged:
    """Numbered rows of different lengths in one array."""

    def __init__(self, dtype: type):
        self.n, self.used = 0, 0
        self.data, self.begin, self.size = np.empty(1024, dtype), np.empty(64, np.int64), np.empty(64, np.int32)

    def append(self, values: np.ndarray, sizes: np.ndarray) -> None:
        """Rows of the given sizes, whose values stand one after another."""
        n, used = self.n + len(sizes), self.used + len(values)
        for name, need in (("data", used), ("begin", n), ("size", n)):
            old = getattr(self, name)
            if need > len(old):
                setattr(self, name, np.resize(old, max(need, 2 * len(old))))
        self.data[self.used:used] = values
        self.begin[self.n:n] = self.used + np.cumsum(sizes) - sizes
        self.size[self.n:n] = sizes
        self.n, self.used = n, used

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of these rows one after another, and each row's size."""
        size = self.size[rows].astype(np.int64)
        shift = self.begin[rows] - (np.cumsum(size) - size)
        at = np.repeat(shift, size)
        at += np.arange(len(at))
        return self.data[at], size


class ByteBpe:
    """Tables of one vocabulary and the pieces encoded with it so far."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.rank = {}
        for line in rank_file.splitlines():
            if line:
                token, number = line.split()
                self.rank[base64.b64decode(token)] = int(number)
        tokens = [b""] * (max(self.rank.values()) + 1)
        for token, number in self.rank.items():
            tokens[number] = token
        self.tokens = tokens
        self.token = Ragged(np.uint8)
        self.token.append(np.frombuffer(b"".join(tokens), np.uint8), np.array([len(t) for t in tokens]))
        shown = [b" %d" % i for i in range(len(tokens))]
        self.decimal = Ragged(np.uint8)
        self.decimal.append(np.frombuffer(b"".join(shown), np.uint8), np.array([len(t) for t in shown]))
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.find = regex.compile(pattern).findall
        self._hash_pairs()
        self._forget()

    # -- pairs ---------------------------------------------------------
    def _hash_pairs(self) -> None:
        """Every (left, right) whose bytes together are a token, in a table
        with linear probing, at most a quarter full."""
        keys, values = [], []
        for token, number in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(number)
        self.bits = max(10, int(len(keys) * 4).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]          # the last writer of a slot holds it
            placed = self.keys[slot] == keys
            self.values[slot[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slot = (slot[~placed] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the pair is no token."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    # -- pieces --------------------------------------------------------
    def merge_rows(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of similar lengths, by rounds over a padded matrix:
        the matrix of their ids and the number of ids in each row."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(size.max())
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        out, count = ids, size.copy()
        ids = ids.copy()
        ranks = np.full((len(pieces), max(width - 1, 1)), NONE, np.int32)
        pairs = np.arange(1, width) < size[:, None]
        ranks[:, :width - 1][pairs] = self.pair_rank(ids[:, :-1][pairs], ids[:, 1:][pairs])
        row = np.arange(len(pieces))
        while True:
            each = np.arange(len(row))
            at = ranks.argmin(axis=1)
            best = ranks[each, at]
            done = best == NONE
            if done.any():
                out[row[done], :ids.shape[1]] = ids[done]
                count[row[done]] = size[done]
                left = np.flatnonzero(~done)
                if not len(left):
                    return out, count
                row, size, at, best = row[left], size[left], at[left], best[left]
                width = int(size.max())
                ids, ranks = ids[left, :width], ranks[left, :max(width - 1, 1)]
                each = np.arange(len(row))
            # compaction: what stands behind the merged pair moves one to the left
            ids[each, at] = best
            behind = np.arange(ids.shape[1] - 1) > at[:, None]
            np.copyto(ids[:, :-1], ids[:, 1:].copy(), where=behind)
            np.copyto(ranks[:, :-1], ranks[:, 1:].copy(), where=behind[:, :ranks.shape[1] - 1])
            ranks[:, -1] = NONE
            size = size - 1
            for p in (at - 1, at):
                beside = p + 1 >= size
                ranks[each[beside], p[beside]] = NONE
                ok = np.flatnonzero((p >= 0) & ~beside)
                q = p[ok]
                ranks[ok, q] = self.pair_rank(ids[ok, q], ids[ok, q + 1])

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one very long piece."""
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        first = self.pair_rank(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        token, rank = self.tokens, self.rank

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                r = rank.get(token[ids[i]] + token[ids[after[i]]])
                if r is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[after[i]]))

        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each piece has."""
        number = [self.rank.get(p, -1) for p in pieces]
        count = np.zeros(len(pieces), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        whole = np.array([i for i, n in enumerate(number) if n >= 0], np.int64)
        if len(whole):
            found.append((whole, np.array(number, np.int32)[whole][:, None], np.ones(len(whole), np.int64)))
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if number[i] >= 0 or not p:
                continue
            if len(p) > LONG_PIECE:
                ids = np.array(self.merge_long(p), np.int32)
                found.append((np.array([i]), ids[None, :], np.array([len(ids)])))
            else:
                width = len(p) if len(p) <= 16 else 1 << (len(p) - 1).bit_length()
                buckets.setdefault(width, []).append(i)
        for width, members in buckets.items():
            rows = max(1, (1 << 17) // width)
            for low in range(0, len(members), rows):
                part = members[low:low + rows]
                found.append((np.array(part), *self.merge_rows([pieces[i] for i in part])))
        for which, _, n in found:
            count[which] = n
        begin = np.cumsum(count) - count
        flat_ids = np.empty(int(count.sum()), np.int32)
        for which, ids, n in found:
            real = np.arange(ids.shape[1]) < n[:, None]
            flat_ids[(begin[which][:, None] + np.arange(ids.shape[1]))[real]] = ids[real]
        return flat_ids, count

    # -- texts ---------------------------------------------------------
    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = Ragged(np.int32)         # ids of each known piece
        self.shown = Ragged(np.uint8)       # its ids as decimals, a space before each

    def _learn(self, new: list[str]) -> None:
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        ids, count = self.encode_pieces([p.encode() for p in new])
        self.ids.append(ids, count)
        signs, each = self.decimal.take(ids)
        upto = np.concatenate([[0], np.cumsum(each)])
        ends = np.cumsum(count)
        self.shown.append(signs, upto[ends] - upto[ends - count])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ids of all texts in a row, their offsets, and each text's ids as
        decimals joined by one space."""
        pieces = [self.find(t) for t in texts]
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        self._learn(list(set().union(*pieces) - self.known.keys()))
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(pieces)),
                            np.int64, int(bounds[-1]))
        ids, count = self.ids.take(which)
        signs, wide = self.shown.take(which)
        upto = np.concatenate([[0], np.cumsum(count)])[bounds]
        shown = np.concatenate([[0], np.cumsum(wide)])[bounds].tolist()
        signs = signs.tobytes()
        return ids, upto, [signs[a + 1:b] for a, b in zip(shown[:-1], shown[1:], strict=True)]

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of the tokens one after another, and each token's length."""
        raw, size = self.token.take(ids.astype(np.int64))
        return raw.tobytes(), size


@lru_cache(maxsize=4)
def _tables(rank_file: bytes, pattern: str) -> ByteBpe:
    return ByteBpe(rank_file, pattern)


def rank_bytes(path: str) -> bytes:
    """A rank file, read on the driver; larger ones are refused."""
    with open(path, "rb") as f:
        raw = f.read(MAX_RANK_FILE_BYTES + 1)
    if len(raw) > MAX_RANK_FILE_BYTES:
        raise ValueError(f"{path} is over {MAX_RANK_FILE_BYTES} bytes: not a vocabulary file")
    return raw


def encode(docs: DataFrame, rank_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>), ``n_tokens`` (long), and the digests
    ``ids_sha256`` (decimal ids joined by one space) and ``decoded_sha256``
    (the bytes that the ids decode to), in place of any columns so named."""
    raw = share(docs.sparkSession, rank_bytes(rank_path))

    @F.arrow_udf("ids array<int>, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _tables(raw.value, pattern)
        try:
            yield from encoded(bpe, batches)
        finally:
            bpe._forget()       # the worker may go on with another operator
            give_back()

    def encoded(bpe: ByteBpe, batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for part in slices(batch, SLICE):
                ids, upto, decimals = bpe.encode(["" if t is None else t for t in part.to_pylist()])
                text_bytes, size = bpe.decode(ids)
                at = np.concatenate([[0], np.cumsum(size)])[upto].tolist()
                decoded = [text_bytes[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                parts.append(pa.StructArray.from_arrays([
                    pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(np.diff(upto), pa.int64()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decimals], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())],
                    ["ids", "n_tokens", "ids_sha256", "decoded_sha256"]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([
                ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()),
                ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]))

    made = ["ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    kept = [c for c in docs.columns if c.lower() not in made and c != "_bpe"]
    return (docs.withColumn("_bpe", digest(F.col(text)))
            .select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"_bpe.{c}").alias(c) for c in made]))


def decode(df: DataFrame, rank_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (binary): the bytes of ``ids``; NULL ids decode
    to no bytes, an id outside the vocabulary is an error."""
    raw = share(df.sparkSession, rank_bytes(rank_path))

    @F.arrow_udf("binary")
    def join(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = _tables(raw.value, pattern).tokens
        for batch in batches:
            yield pa.array([b"".join([token[i] for i in x or []]) for x in batch.to_pylist()],
                           pa.binary())

    return df.withColumn("decoded", join(F.col(ids)))
