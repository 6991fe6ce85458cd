"""Shared helpers of the training-data operators: table reads, scratch
folders, and numpy access to the bytes of an Arrow string array."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: Text bytes handled at once inside a task; bounds a Python worker's memory.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows whose crc32(doc_id as text) mod 4 is 2; a NULL id is
    never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` materialised as Parquet below the shared checkpoint folder and
    read back: cuts lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/strata-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def share(spark: SparkSession, value: Any) -> Broadcast:
    """``value`` broadcast to the tasks of an Arrow function.  Callers state
    its bound.  The first call also sends this package to the executors, so
    that they need no installation of it."""
    context = spark.sparkContext
    if getattr(share, "sent_to", None) != context.applicationId:
        package = Path(__file__).resolve().parent.parent
        folder = tempfile.mkdtemp(prefix="strata-package-")     # served by the driver
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/strata", "zip", package.parent, package.name))
        share.sent_to = context.applicationId
    return context.broadcast(value)


def give_back() -> None:
    """Returns a Python worker's freed memory to the machine: workers outlive
    their tasks, and what one operator freed the next one's heap needs."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # not the GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def flat(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings and their ``len + 1`` offsets (NULL: empty)."""
    if isinstance(strings, pa.ChunkedArray):
        strings = strings.combine_chunks()
    if strings.null_count:
        strings = strings.fill_null("")
    if len(strings) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(strings.type) or pa.types.is_large_binary(strings.type)
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(strings: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive parts of ``strings`` of about ``limit`` bytes each; a longer
    string is a part of its own."""
    _, at = flat(strings)
    low = 0
    while low < len(strings):
        high = int(np.searchsorted(at, at[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(strings))
        yield strings.slice(low, high - low)
        low = high
