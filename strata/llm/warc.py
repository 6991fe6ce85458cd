"""Operator 12: WARC archives, written from pages and read back by chains of
verified record boundaries.

Writing.  Every page becomes one WARC/1.1 record.  Pages with equal payloads
(SHA-1 and length; ``min_bytes`` or more) share one ``response``, that of the
largest page_id, which carries the payload; the others are ``revisit``
records that name it and carry the HTTP header alone.  Equal payloads are
reduced to one before they are shuffled, so a payload that a third of all
pages have moves once a map task.  The records go through Spark's text sink
with the record end as line separator: its commit protocol is what makes a
lost executor harmless.

Reading.  Spark's text source, with the magic line as separator, deals byte
ranges of the files to tasks, which see every occurrence of the magic, in a
payload too.  Each is a candidate: a task reads its header and emits where,
by the declared length, the next record begins.  Only offsets on the chain
from the start of a file are records, found by pointer jumping: with every
round the jumps double, so a file of n records takes log2(n) rounds of joins.
A chain that doesn't end at the end of its file is an error.  A record whose
payload holds the magic was cut there, and is put together again from the
parts that its length covers.  Payload bytes and digest of a response are
computed from the bytes read and compared with its header; those of a
revisit are the ones that its header declares.

Bounds: a file holds ``records_per_file`` records; a record is handled whole,
as the page it came from.  Nothing is collected to the driver.

Defined results: a NULL html is an empty payload; a NULL url has no target
header; a line break in a url is percent-encoded; repeated rows are a record
each, one of them the response; a NULL page_id is read back as NULL and
sorts below all others; an empty table gives no records; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import heavy_keys, join_heavy
from ..session import checkpoint_root
from .tables import share, written

# The record format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# --- end of fixed values
KEY = ["digest", "payload_bytes"]
_URN = "urn:page:"


def base32_sha1(col: str) -> Column:
    """Upper-case base32 of the SHA-1 of a string's UTF-8 bytes: five
    hexadecimal digits are four of base 32, and 40 are 32 without padding."""
    hexed = F.sha1(F.col(col).cast("binary"))
    parts = [F.lpad(F.conv(F.substring(hexed, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """One row a page: ``page_id, url, record_type, refers_to, digest,
    payload_bytes, payload`` (the payload of responses only)."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns({
        "digest": base32_sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    small = rows.where(F.col("payload_bytes") < min_bytes)
    large = rows.where(F.col("payload_bytes") >= min_bytes)
    nobody = F.lit(None).cast(pages.schema["page_id"].dataType)
    out = ["page_id", "url", "record_type", "refers_to", *KEY, "payload"]

    first = large.groupBy(*KEY).agg(F.max(F.struct("page_id", "url")).alias("first"),
                                    F.any_value("payload").alias("payload"))
    whole = first.select("first.*", *KEY, "payload").unionByName(small.select("page_id", "url", *KEY, "payload"))
    whole = whole.withColumns({"record_type": F.lit("response"), "refers_to": nobody})

    # the others, without payloads: one row for equal rows, less the response
    same = written(large.groupBy("page_id", "url", *KEY).agg(F.count(F.lit(1)).alias("n")), "warc-pages")
    firsts = same.groupBy(*KEY).agg(F.max(F.struct("page_id", "url")).alias("first"), F.sum("n").alias("all"))
    firsts = firsts.where("all > 1")
    total = same.agg(F.sum("n")).first()[0] or 0
    again = join_heavy(same, firsts, KEY, heavy_keys(firsts, total, "all"))
    mine = F.struct("page_id", "url").eqNullSafe(F.col("first"))
    again = again.withColumn("left", F.col("n") - F.when(mine, 1).otherwise(0)).where("`left` > 0")
    again = again.withColumn("copy", F.explode(F.sequence(F.lit(1), "left")))
    again = again.withColumns({"record_type": F.lit("revisit"), "refers_to": F.col("first.page_id"),
                               "payload": F.lit("")})
    return whole.select(*out).unionByName(again.select(*out))


def record_text(made: DataFrame) -> Column:
    """The bytes of a record, without the two line breaks that end it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit(f"<{_URN}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    body = F.concat(http, F.col("payload"))
    return F.concat(
        F.lit(MAGIC), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(DATE)), F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn("refers_to")), line("WARC-Profile", F.lit(PROFILE))))
        .otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"), body)


def write(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, compression: str = "gzip",
          records_per_file: int = 100_000) -> str:
    """Writes ``pages`` (page_id, url, html) as archives below ``folder`` (a
    new one in the shared checkpoint folder) and returns it.  ``compression``
    is a codec of the text sink; ``none`` lets several tasks read one file."""
    folder = folder or f"{checkpoint_root(pages.sparkSession)}/strata-llm/warc-{uuid.uuid4().hex[:12]}"
    made = records(pages, min_bytes)
    (made.select(record_text(made).alias("value")).write.option("lineSep", END)
     .option("compression", compression).option("maxRecordsPerFile", records_per_file).text(folder))
    return folder


# ------------------------------------------------------------------ reading --
def header(text: bytes) -> tuple[dict[str, str], int, int] | None:
    """Fields of the record that begins with ``text`` (what follows its magic
    line), the header's bytes, and the declared bytes of its block; None if
    ``text`` begins no record."""
    head, end, _ = text.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    size = fields.get("content-length", "")
    if not end or not size.isdecimal():
        return None
    return fields, len(head) + len(END), int(size)


_FIELDS = ("id string, url string, record_type string, refers string, payload_bytes long, payload_digest string, "
           "digest_ok boolean")


def described(fields: dict[str, str], block: bytes) -> tuple:
    """Values of ``_FIELDS`` of a record."""
    http, _, payload = block.partition(b"\r\n\r\n")
    said = fields.get("warc-payload-digest", "").rpartition(":")[2]
    urn = lambda name: fields[name].strip("<>").removeprefix(_URN) or None if name in fields else None
    kind = fields.get("warc-type")
    if kind == "revisit":
        size = [line.partition(b":")[2] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
        n, digest = int(size[0]) if size else None, said
    else:
        n, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return (urn("warc-record-id"), fields.get("warc-target-uri"), kind, urn("warc-refers-to"), n, digest,
            digest == said)


def _parts(spark: SparkSession, folder: str, wanted: bool = False) -> DataFrame:
    """One row for each part between magics: its file and block, its place
    ``rel`` in the block and its bytes (magic included); and, of a part that
    begins a record, the record's declared bytes ``size`` and, if the part
    holds all of it, its fields.  With ``wanted`` the text instead."""
    share(spark, None)
    raw = (spark.read.option("lineSep", MAGIC).text(folder)
           .select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.col("value").cast("binary").alias("value")))
    places = "file long, block long, rel long, bytes long, "
    schema = places + ("text binary" if wanted else f"size long, whole boolean, {_FIELDS}")
    names = [c.split()[0] for c in schema.split(", ")]
    magic = len(MAGIC)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rel = None, 0
        for batch in batches:
            rows = []
            for file, block, value in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                first = (file, block) != at
                if first:           # a file's first part has no magic before it
                    at, rel = (file, block), 0 if block else -magic
                place, n = rel, len(value) + magic
                rel += n
                if wanted:
                    rows.append((file, block, place, n, value))
                    continue
                begun = None if place < 0 else header(value)
                if begun is None:
                    rows.append((file, block, place, n, None, None, *[None] * 7))
                    continue
                fields, skip, size = begun
                all_ = magic + skip + size + len(END)
                if all_ <= n:
                    rows.append((file, block, place, n, all_, True, *described(fields, value[skip:skip + size])))
                else:
                    rows.append((file, block, place, n, all_, False, *[None] * 7))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            types = [pa.binary() if x == "text" else pa.string() if x in _TEXTS else
                     pa.bool_() if x in ("whole", "digest_ok") else pa.int64() for x in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return raw.mapInArrow(read, schema)


_TEXTS = ("id", "url", "record_type", "refers", "payload_digest")


def _placed(parts: DataFrame) -> DataFrame:
    """``parts`` with their offset ``at`` in the file: blocks begin where the
    parts of the blocks before them end."""
    blocks = parts.groupBy("file", "block").agg(F.sum("bytes").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.when(F.col("block") == 0, 0).otherwise(-len(MAGIC))
    starts = blocks.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) + first).alias("start"))
    return parts.join(starts, ["file", "block"]).withColumn("at", F.col("start") + F.col("rel")).drop("start")


def reachable(jumps: DataFrame) -> DataFrame:
    """(file, at) of all offsets on the chains from offset 0 over ``jumps``
    (file, at, to), the ends of the chains included.  Round k knows the first
    2 ** k offsets of a chain and jumps that far."""
    known = written(jumps.where("at = 0").select("file", "at"), "warc-known")
    jumps = written(jumps, "warc-jumps")
    while True:
        step = written(known.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at")), "warc-step")
        if step.isEmpty():
            return known
        known = known.unionAll(step)
        onward = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("_on"))
        jumps = written(jumps.join(onward, ["file", "to"]).select("file", "at", F.col("_on").alias("to")), "warc-jumps")


def read(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """One row a record of the archives in ``folder``: ``page_id, url,
    record_type, refers_to, payload_bytes, payload_digest, digest_ok``.
    Raises ValueError if a file is no unbroken chain of records."""
    parts = _placed(written(_parts(spark, folder), "warc-parts"))
    # a file's first offset must begin a record, and its chain must end where the file does
    jumps = parts.where("size is not null").select("file", "at", (F.col("at") + F.col("size")).alias("to"))
    known = reachable(jumps)
    length = parts.groupBy("file").agg(F.max(F.col("at") + F.col("bytes")).alias("at"))
    broken = length.where("at > 0").join(known, ["file", "at"], "left_anti").count()
    if broken:
        raise ValueError(f"{broken} files below {folder} are no unbroken chain of records")
    found = parts.join(known, ["file", "at"], "left_semi").where("size is not null")
    whole = found.where("whole")
    cut = found.where("not whole").select("file", F.col("at").alias("record"), (F.col("at") + F.col("size")).alias("to"))
    if not cut.isEmpty():
        whole = whole.select(*_names()).unionByName(_joined(spark, folder, parts, cut).select(*_names()))
    return whole.select(F.col("id").cast(id_type).alias("page_id"), "url", "record_type",
                        F.col("refers").cast(id_type).alias("refers_to"), "payload_bytes", "payload_digest", "digest_ok")


def _names() -> list[str]:
    return [c.split()[0] for c in _FIELDS.split(", ")]


def _joined(spark: SparkSession, folder: str, parts: DataFrame, cut: DataFrame) -> DataFrame:
    """The records ``cut`` (file, record, to) at magics inside them, described
    after their parts were put together; only such records' parts are read
    again and shuffled."""
    marks = parts.select("file", "block", "rel", "at", F.lit(None).cast("long").alias("record"),
                         F.lit(None).cast("long").alias("to"))
    starts = cut.select("file", F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("rel"),
                        F.col("record").alias("at"), "record", "to")
    order = Window.partitionBy("file").orderBy("at", F.col("record").isNull())
    inside = (marks.select("*", F.lit(None).cast("struct<record:long,to:long>").alias("own"))
              .unionByName(starts.select("*", F.struct("record", "to").alias("own")))
              .withColumn("own", F.last("own", ignorenulls=True).over(order))
              .where("rel is not null and at < own.to")
              .select("file", "block", "rel", "at", F.col("own.record").alias("record")))
    texts = _parts(spark, folder, wanted=True).join(inside, ["file", "block", "rel"])
    one = texts.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("at", "text"))).alias("parts"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cells in batch.column(0).to_pylist():
                text = MAGIC.encode().join(c["text"] for c in cells)
                fields, skip, size = header(text)
                rows.append(described(fields, text[skip:skip + size]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(_names())
            types = [pa.string() if x in _TEXTS else pa.bool_() if x == "digest_ok" else pa.int64() for x in _names()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                                             _names())

    return one.select("parts").mapInArrow(describe, _FIELDS)
