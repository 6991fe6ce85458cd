"""Operator 1: language identification by compression.

Method: texts are folded to lower case without punctuation; every language owns a raw-content zstandard dictionary made of
labelled texts.  A text is encoded with each dictionary in independent
blocks of ``BLOCK`` bytes (so that the dictionary, not the text's own past,
explains each block of a long text), the sizes are added up, and the
smallest total names the language.  Where the second smallest is within
``min_margin`` of it, relative to the text's bytes, the text is rejected.

Fitting takes a bounded sample of the labelled rows: ``sample_docs`` texts a
language, chosen by a hash of the text at a rate that follows from the
language's count, and ``dict_bytes`` bytes of them in all.  The sample, at
most ``max_languages * dict_bytes``, is the only thing that the driver
collects and broadcasts.  Everything else is one pass of an Arrow UDF over
the text column: no shuffle.

Defined results: a text that is NULL, empty or without a letter is ``und``
with score 0 and is rejected; ties go to the language that sorts first and
are rejected when the margin asks for one; repeated rows are judged alike;
rows with a NULL language are predicted but never learned from; a table with
no labelled text gives ``und`` everywhere.  Extra columns stay; a column that
clashes with an output name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import share, slices

BLOCK = 1024            # bytes that are encoded on their own
LEVEL = 6
SHORT = 512             # bytes; texts up to here are encoded behind a page of their language
SHORT_LEVEL = 12
PAGE = 8 << 10
_LETTERS = bytes(32 if i < 128 and not chr(i).isalpha() else i for i in range(256))
SCALE = 40.0            # of the score: exponent of a size difference a byte of text
UNKNOWN = "und"
MADE = ["lang_pred", "score", "margin", "rejected"]


def has_letter(text: str = "text") -> Column:
    """Whether the text has a letter of any script (NULL: no)."""
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = 256,
        dict_bytes: int = 64 << 10, max_languages: int = 256) -> dict[str, bytes]:
    """Raw-content dictionaries by language, from rows with text and lang.

    At most ``max_languages`` languages, those with most rows; of each, about
    ``sample_docs`` texts whose middle ``dict_bytes / sample_docs`` characters
    fill the dictionary.
    """
    rows = labelled.where(F.col(lang).isNotNull() & has_letter(text)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = (rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
              .limit(max_languages).collect())
    if not counts:
        return {}
    million = 1_000_000
    rate = F.create_map(*[F.lit(x) for r in counts for x in (
        r["lang"], min(million, 1 + 2 * sample_docs * million // r["count"]))])
    order = F.xxhash64("text")
    piece = max(1, dict_bytes // sample_docs)
    middle = F.greatest(F.lit(1), ((F.length("text") - piece) / 2).cast("int") + 1)
    sample = (rows.where(F.pmod(order, F.lit(million)) < rate[F.col("lang")])
              .select("lang", order.alias("h"), F.substring("text", middle, F.lit(piece)).alias("part"))
              .distinct())
    best = (sample.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("h", "part"))),
                                               1, 2 * sample_docs).alias("parts")))
    out = {}
    for r in best.collect():
        joined = folded("\n".join(p["part"] for p in r["parts"]))
        out[r["lang"]] = joined[:dict_bytes]
    return dict(sorted(out.items()))


def folded(text: str | None) -> bytes:
    """The bytes that are encoded: lower case, a space for every ASCII
    character that is no letter."""
    return (text or "").lower().encode().translate(_LETTERS)


def compressor(raw: bytes, level: int, min_match: int) -> zstandard.ZstdCompressor:
    """An encoder that begins with the raw content ``raw``."""
    settings = zstandard.ZstdCompressionParameters.from_level(
        level, dict_size=len(raw), source_size=BLOCK, min_match=min_match,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=zstandard.ZstdCompressionDict(
        raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


class Encoder:
    """Sizes of texts under one dictionary."""

    def __init__(self, raw: bytes):
        self.long = compressor(raw, LEVEL, 0)
        # A short text is encoded behind a page of the language that the
        # dictionary lacks: on its own it would be stored plainly, as zstandard
        # does with blocks that it can't shorten by some bytes.
        cut = len(raw) - min(PAGE, len(raw) // 2)
        self.page, self.short = raw[cut:] + b" ", compressor(raw[:cut], SHORT_LEVEL, 3)
        self.empty = len(self.short.compress(self.page))

    def size(self, text: bytes) -> int:
        """Encoded bytes of a text, over blocks of equal length, so that no
        short rest is left over."""
        if len(text) <= SHORT:
            return len(self.short.compress(self.page + text)) - self.empty
        n = -(-len(text) // BLOCK)
        return sum([len(self.long.compress(text[i * len(text) // n:(i + 1) * len(text) // n]))
                    for i in range(n)])


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text",
             min_margin: float = 0.0005) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1), ``margin`` (second
    smallest less smallest size, a byte of text) and ``rejected``."""
    names = sorted(dictionaries)
    spark = docs.sparkSession
    sent = share(spark, [dictionaries[n] for n in names])

    @F.arrow_udf("best int, margin double, score double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoders = [Encoder(raw) for raw in sent.value]
        for batch in batches:
            best, margin, score = [], [], []
            for part in slices(batch):
                texts = [folded(t) for t in part.to_pylist()]
                sizes = np.array([[e.size(t) for e in encoders] for t in texts], np.int64)
                plain = np.maximum([len(t) for t in texts], 1)
                first = sizes.argmin(axis=1)
                ordered = np.sort(sizes, axis=1)
                second = ordered[:, 1] if sizes.shape[1] > 1 else 2 * ordered[:, 0]
                best.append(first)
                margin.append((second - ordered[:, 0]) / plain)
                score.append(1 / np.exp(-SCALE * (sizes - ordered[:, :1]) / plain[:, None]).sum(axis=1))
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(best or [np.zeros(0)]), pa.int32()),
                 pa.array(np.concatenate(margin or [np.zeros(0)]), pa.float64()),
                 pa.array(np.concatenate(score or [np.zeros(0)]), pa.float64())],
                ["best", "margin", "score"])

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in MADE and c != "_judged"]
    if not names:
        return docs.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0.0).alias("margin"), F.lit(True).alias("rejected"))
    ok = has_letter(text)
    by_number = F.array(*[F.lit(n) for n in names])
    judged = F.col("_judged")
    return (docs.withColumn("_judged", judge(F.col(text)))
            .select(*kept,
                    F.when(ok, F.get(by_number, judged["best"])).otherwise(UNKNOWN).alias("lang_pred"),
                    F.when(ok, judged["score"]).otherwise(0.0).alias("score"),
                    F.when(ok, judged["margin"]).otherwise(0.0).alias("margin"),
                    (~ok | (judged["margin"] < min_margin)).alias("rejected")))
