"""Helpers shared by the training-data operators: scratch tables and vectorised word hashing.

Operators that return results of their own read only the columns they are told to (id and text),
under private names. Those that return the caller's rows carry a row as one struct, or add columns
under names that the row does not have (``unused``), so extra columns of any name cannot clash.
"""

from __future__ import annotations

import ctypes
import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat.session import ensure_checkpoint_dir, ship_package

#: Bytes of text that one vectorised step holds; a longer document is a step of its own.
STEP_BYTES = 2 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/kvadrat-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage, and
    the columns that later steps need can be read alone."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null text: empty), as ``doc_id`` and ``text``."""
    ship_package(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def row_struct(df: DataFrame) -> Column:
    """The whole row as one struct ``row``, whatever its columns are called."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")


def unused(names: list[str], *wanted: str) -> list[str]:
    """``wanted`` with as many underscores before them as keep them apart from ``names``."""
    taken = {n.lower() for n in names}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def lean(make: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """``make``, giving freed memory back to the system when a task ends: Python workers live on
    between tasks, and what their allocators keep counts against the executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from make(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library than glibc
                pass

    return run


def steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of an Arrow batch of about ``limit`` bytes of text each."""
    n = batch.num_rows
    if not n:
        return
    ends = text_buffer(batch.column(column))[1][1:]
    first = 0
    while first < n:
        base = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(first, last - first)
        first = last


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each row in them (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LONG_WORD = 64


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text column, without a Python object per word.

    ``starts``/``ends``: byte range of each word in ``data``; ``first``: index of the first
    word of each row (one more than rows). A subclass may give ``fold``, what each byte counts as.
    """

    fold: np.ndarray | None = None

    def __init__(self, column: pa.Array, lower: bool = False):
        data, self.offsets = text_buffer(column)
        fold = LOWER if lower else self.fold
        self.data = data if fold is None else fold[data]
        solid = ~_SPACE[self.data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.offsets] = True
        before = np.empty(len(data), bool)
        if len(data):
            before[0] = True
            before[1:] = ~solid[:-1]
        self.starts = np.flatnonzero(solid & (before | edge[:-1]))
        after = np.empty(len(data), bool)
        if len(data):
            after[-1] = True
            after[:-1] = ~solid[1:]
        self.ends = np.flatnonzero(solid & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        size = self.ends - self.starts
        out = np.zeros(len(size), np.uint64)
        live = np.flatnonzero(size <= _LONG_WORD)
        k = 0
        while len(live):
            out[live] = out[live] * _BASE + _BYTES[self.data[self.starts[live] + k]]
            k += 1
            live = live[size[live] > k]
        out = mix(out + size.astype(np.uint64))
        for i in np.flatnonzero(size > _LONG_WORD):
            word = self.data[self.starts[i] : self.ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def grams(hashes: np.ndarray, k: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of each run of ``k`` consecutive hashes (rows are the caller's concern)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if k <= 16:
        out = np.zeros(n, np.uint64)
        for j in range(k):
            out = out * np.uint64(base) + hashes[j : j + n]
        return mix(out)
    power = np.full(len(hashes), np.uint64(base), np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    back = np.full(n, np.uint64(pow(base, -1, 1 << 64)), np.uint64)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power, dtype=np.uint64)])
    return mix((total[k:] - total[:-k]) * back)


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's long."""
    return np.ascontiguousarray(h).view(np.int64)
