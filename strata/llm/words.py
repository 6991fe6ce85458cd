"""Words and word hashes of many texts at once, on numpy arrays."""

from __future__ import annotations

import hashlib

import numpy as np

#: Bytes that end a word in the shingle operators: space and \x09-\x0D.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z become a-z, every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_LONG = 64      # bytes; longer words are hashed one by one


def boundaries(data: np.ndarray, at: np.ndarray, separators: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's first word number
    (``len(at)`` entries); no word spans two texts."""
    inside = ~separators[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    edges = at[(at > 0) & (at < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (uint64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes.  Words are taken in order of length,
    so step j touches only the words that have a byte j."""
    size = ends - starts
    out = np.zeros(len(starts), np.uint64)
    for i in np.flatnonzero(size > _LONG):
        raw = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(raw, "little")
    short = np.where(size > _LONG, 0, size).astype(np.uint8)
    order = np.argsort(short, kind="stable")[::-1]
    at, left = starts[order], short[order]
    have = np.searchsorted(-left.astype(np.int16), -np.arange(_LONG + 1, dtype=np.int16), "left")
    h = np.zeros(len(order), np.uint64)
    multiplier = np.uint64(0x9E3779B97F4A7C15)
    for j in range(int(left[0]) if len(left) else 0):
        n = have[j]
        h[:n] = (h[:n] + data[at[:n] + j] + np.uint64(1)) * multiplier
        h[:n] ^= h[:n] >> np.uint64(29)
    n = have[0] if len(left) else 0
    out[order[:n]] = mix(h[:n])
    return out


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each text, in text order, and
    each text's first run.  A text of fewer words, but not none, is one run."""
    count = np.diff(first)
    h = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for j in range(width):
        h = h * np.uint64(0xD1342543DE82EF95) + words[j:j + len(h)]
    runs = np.where(count >= width, count - width + 1, (count > 0).astype(count.dtype))
    begin = np.concatenate([[0], np.cumsum(runs)]).astype(np.int64)
    out = np.empty(begin[-1], np.uint64)
    long = np.flatnonzero(count >= width)
    if len(long):
        take = runs[long]
        pos = np.arange(int(take.sum())) - np.repeat(np.cumsum(take) - take, take)
        out[np.repeat(begin[long], take) + pos] = mix(h[np.repeat(first[long], take) + pos])
    short = np.flatnonzero((count > 0) & (count < width))
    one = count[short].astype(np.uint64)
    for j in range(width - 1):
        more = count[short] > j
        one[more] = one[more] * np.uint64(0xD1342543DE82EF95) + words[first[short[more]] + j]
    out[begin[short]] = mix(one ^ np.uint64(0xA5A5A5A5))
    return out, begin


def distinct_per_text(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values in ascending order, with offsets."""
    values = values.copy()
    for low, high in zip(begin[:-1], begin[1:], strict=True):
        if high - low > 1:
            values[low:high].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[begin[:-1][begin[:-1] < len(values)]] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], upto[begin]
