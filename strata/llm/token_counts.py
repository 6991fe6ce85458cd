"""Operator 4: token counts of a document's sections.

Method: offset-mapped attribution.  Every document is encoded once, whole
(so no token is cut by a section's border), its tokens' character spans
follow from the lengths of their bytes, and the spans are joined to the
sections as intervals, by binary search over the sorted borders of a whole
slice of documents.

Rule for tokens that cross a border: a token belongs to the section that
holds most of its characters; between equals, to the earlier one.  A token
that is part of a character spans that character.  A token that touches no
section counts for section -1.  So the counts of a document add up to its
tokens.

Sections are the text's lines, each with its line feed, or any array column
of (start, end), code points with the end exclusive: they are sorted, cut to
the text, and one that overlaps an earlier one begins behind it.

Defined results: a NULL or empty text has one empty line with no tokens;
NULL or empty arrays have no sections; repeated rows each give their rows;
documents of any length are encoded whole; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import SLICE, _tables, rank_bytes
from .tables import flat, share, slices


def attribute(start: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """For each token span [start, end) the number of its section among the
    sorted, disjoint sections [low, high), or -1; and whether it touches
    another section too or leaves its own."""
    if not len(low):
        return np.full(len(start), -1), np.zeros(len(start), bool)
    first = np.searchsorted(high, start, "right")               # the first that ends behind the start
    last = np.searchsorted(low, end, "left") - 1                # the last that begins before the end
    touches = last >= first
    owner = np.where(touches, first, -1)
    inside = touches & (low[np.minimum(first, len(low) - 1)] <= start) & (high[np.minimum(first, len(low) - 1)] >= end)
    several = np.flatnonzero(last > first)
    if len(several):
        s, e, f, n = start[several], end[several], first[several], last[several] - first[several]
        most = np.zeros(len(several), np.int64)
        for k in range(int(n.max()) + 1):
            at = np.minimum(f + k, last[several])
            shared = np.minimum(e, high[at]) - np.maximum(s, low[at])
            better = (k <= n) & (shared > most)
            most[better] = shared[better]
            owner[several[better]] = at[better]
    return owner, touches & ~inside


def _lines(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all lines, and each line's text; an empty text has one."""
    behind = np.flatnonzero(data == 10) + 1
    behind = behind[np.searchsorted(at, behind, "left") == np.searchsorted(at, behind, "right")]
    text = np.concatenate([np.arange(len(at) - 1), np.searchsorted(at, behind, "right") - 1])
    begin = np.concatenate([at[:-1], behind])
    order = np.lexsort((begin, text))
    return begin[order], text[order]


def count_tokens(docs: DataFrame, rank_path: str, pattern: str, text: str = "text",
                 sections: str | None = None) -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_crossing) of every section;
    ``n_crossing`` of its tokens reach beyond it."""
    raw = share(docs.sparkSession, rank_bytes(rank_path))
    wanted = ([F.transform(F.array_sort(sections), lambda s: s[part]).alias(f"_{part}") for part in ("start", "end")]
              if sections else [])
    rows = docs.select("doc_id", F.col(text).alias("_text"), *wanted)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)] + T._parse_datatype_string(
        "section int, start int, end int, n_tokens long, n_crossing long").fields)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _tables(raw.value, pattern)
        for batch in batches:
            row = 0
            for part in slices(batch.column(1), SLICE):
                own = batch.slice(row, len(part))
                row += len(part)
                data, at = flat(part)
                ids, upto, _ = bpe.encode(["" if t is None else t for t in part.to_pylist()])
                size = bpe.token.size[ids].astype(np.int64)
                ends = np.cumsum(size)
                point = np.cumsum((data & 0xC0) != 0x80)        # characters up to each byte
                base = np.concatenate([[0], point])[at]         # and before each text
                start, end = point[ends - size] - 1, point[ends - 1]
                if sections:
                    which, low, high = _given(own, base)
                else:
                    begin, which = _lines(data, at)
                    low = np.concatenate([[0], point])[begin]
                    high = np.append(low[1:], base[-1])
                owner, crossing = attribute(start, end, low, high)
                n = np.bincount(owner + 1, minlength=len(low) + 1)
                crossed = np.bincount(owner + 1, crossing, len(low) + 1).astype(np.int64)
                first = np.searchsorted(which, np.arange(len(part)), "left")
                yield _made(own, which, np.arange(len(which)) - first[which], low - base[which],
                            high - base[which], n[1:], crossed[1:])
                if n[0]:
                    text_of = np.searchsorted(upto, np.flatnonzero(owner < 0), "right") - 1
                    outside = np.bincount(text_of, minlength=len(part))
                    at_all = np.flatnonzero(outside)
                    nothing = np.zeros(len(at_all), np.int64)
                    yield _made(own, at_all, nothing - 1, nothing, nothing, outside[at_all], nothing)

    def _made(own, which, section, start, end, n, crossed) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [own.column(0).take(pa.array(which)), pa.array(section, pa.int32()), pa.array(start, pa.int32()),
             pa.array(end, pa.int32()), pa.array(n, pa.int64()), pa.array(crossed, pa.int64())],
            names=schema.names)

    def _given(own: pa.RecordBatch, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        which, low, high = [], [], []
        for i, (starts, ends) in enumerate(zip(own.column(2).to_pylist(), own.column(3).to_pylist(), strict=True)):
            free, size = 0, int(base[i + 1] - base[i])
            for a, b in zip(starts or [], ends or [], strict=True):
                if a is None or b is None:
                    continue
                a, b = min(max(a, free), size), min(b, size)
                free = max(free, b)
                which.append(i)
                low.append(base[i] + a)
                high.append(base[i] + max(a, b))
        return (np.array(which, np.int64), np.array(low, np.int64), np.array(high, np.int64))

    return rows.mapInArrow(count, schema)
