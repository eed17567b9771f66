"""Operator 1: token ids in bit-plane files.

File layout: magic; chunks; footer; trailer (footer offset, footer crc32, magic). A chunk holds
``chunk_ids`` ids (the last one fewer) transposed into planes, each compressed with zstandard;
a plane of zeros takes no bytes. The footer is the chunk index (offset, ids, length of each
plane) and the documents of the file (id, null flag, number of ids), so any chunk or document
can be read alone.

Null text counts as empty and gives the end id alone; a null doc_id sorts first and stays null;
rows with one doc_id follow each other, ordered by a hash of the text and the text; equal rows
are written once each; an empty table gives an empty manifest. A document may span chunks.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kvadrat.llm.common import id_text, lean, scratch, steps
from kvadrat.llm.tokens import encoder

MAGIC = b"KVPLANE1"
CHUNK_IDS = 1 << 16
_TRAILER = struct.Struct("<QI8s")
_CHUNK = struct.Struct("<QIB")

MANIFEST = "part int, file string, n_docs long, n_ids long, n_bytes long"


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """4 byte planes or 32 bit planes of uint32 ids; zero planes are empty."""
    planes = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        planes = np.packbits(np.unpackbits(planes, axis=1, bitorder="little").T, axis=1)
    else:
        planes = np.ascontiguousarray(planes.T)
    return [p.tobytes() if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    bits = len(planes) == 32
    width = (n + 7) // 8 if bits else n
    rows = np.zeros((len(planes), width), np.uint8)
    for row, plane in zip(rows, planes):
        if plane:
            row[:] = np.frombuffer(plane, np.uint8)
    if bits:
        rows = np.packbits(np.unpackbits(rows, axis=1)[:, :n].T, axis=1, bitorder="little")
    else:
        rows = np.ascontiguousarray(rows.T)
    return rows.reshape(-1).view("<u4")


class PlaneWriter:
    def __init__(self, out, chunk_ids: int = CHUNK_IDS, bits: bool = False):
        import zstandard

        self.out, self.chunk_ids, self.bits = out, chunk_ids, bits
        self.pack = zstandard.ZstdCompressor(level=3).compress
        self.rest, self.n_rest, self.index = [], 0, []
        self.doc_ids, self.nulls, self.sizes = [], [], []
        self.n_ids = 0
        self.at = out.write(MAGIC) or len(MAGIC)

    def add(self, ids: np.ndarray, doc_ids: list, sizes: np.ndarray) -> None:
        """The ids of some documents, one after another."""
        self.doc_ids += [0 if d is None else d for d in doc_ids]
        self.nulls += [d is None for d in doc_ids]
        self.sizes.append(np.asarray(sizes, "<u8"))
        self.n_ids += len(ids)
        self.rest.append(ids)
        self.n_rest += len(ids)
        if self.n_rest >= self.chunk_ids:
            ids = np.concatenate(self.rest)
            full = len(ids) - len(ids) % self.chunk_ids
            for at in range(0, full, self.chunk_ids):
                self._chunk(ids[at : at + self.chunk_ids])
            self.rest, self.n_rest = [ids[full:]], len(ids) - full

    def _chunk(self, ids: np.ndarray) -> None:
        planes = [self.pack(p) if p else b"" for p in to_planes(ids, self.bits)]
        self.index.append(_CHUNK.pack(self.at, len(ids), len(planes)) + np.array([len(p) for p in planes], "<u4").tobytes())
        for p in planes:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.n_rest:
            self._chunk(np.concatenate(self.rest))
        docs = np.array(self.doc_ids, "<i8").tobytes() + np.array(self.nulls, np.uint8).tobytes()
        docs = self.pack(docs + (np.concatenate(self.sizes).tobytes() if self.sizes else b""))
        footer = struct.pack("<IQI", len(self.index), len(self.doc_ids), len(docs)) + docs + b"".join(self.index)
        self.out.write(footer)
        self.out.write(_TRAILER.pack(self.at, zlib.crc32(footer), MAGIC))
        self.at += len(footer) + _TRAILER.size


class PlaneReader:
    """Reads the footer at once and chunks on demand from a file that can seek."""

    def __init__(self, file, size: int):
        import zstandard

        self.file, self.unpack = file, zstandard.ZstdDecompressor().decompress
        file.seek(size - _TRAILER.size)
        at, crc, magic = _TRAILER.unpack(file.read(_TRAILER.size))
        file.seek(at)
        footer = file.read(size - _TRAILER.size - at)
        if magic != MAGIC or zlib.crc32(footer) != crc:
            raise ValueError("not a complete plane file")
        n_chunks, n_docs, n_packed = struct.unpack_from("<IQI", footer)
        pos = struct.calcsize("<IQI")
        docs = self.unpack(footer[pos : pos + n_packed])
        self.doc_ids = np.frombuffer(docs, "<i8", n_docs)
        self.nulls = np.frombuffer(docs, np.uint8, n_docs, 8 * n_docs).astype(bool)
        self.sizes = np.frombuffer(docs, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        pos, self.index = pos + n_packed, []
        for _ in range(n_chunks):
            offset, n, planes = _CHUNK.unpack_from(footer, pos)
            pos += _CHUNK.size
            self.index.append((offset, n, np.frombuffer(footer, "<u4", planes, pos)))
            pos += 4 * planes

    def chunk(self, i: int) -> np.ndarray:
        offset, n, lengths = self.index[i]
        self.file.seek(offset)
        return from_planes([self.unpack(self.file.read(int(k))) if k else b"" for k in lengths], n)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) in file order; holds a chunk and one document."""
        chunks = (self.chunk(i) for i in range(len(self.index)))
        rest = np.zeros(0, "<u4")
        for doc_id, null, size in zip(self.doc_ids, self.nulls, self.sizes):
            parts, have = [], 0
            while have < size:
                if not len(rest):
                    rest = next(chunks)
                parts.append(rest[: size - have])
                rest = rest[size - have :]
                have += len(parts[-1])
            yield None if null else int(doc_id), np.concatenate(parts) if len(parts) != 1 else parts[0]


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_ids: int = CHUNK_IDS,
    bits: bool = False,
) -> DataFrame:
    """Encode whole texts and write them under ``path`` in ascending id order; returns the
    manifest (``MANIFEST``), itself stored beside the files.

    The id ranges are Spark's range partitions, one file each. A task writes a file of its own
    name and reports it; only reported files count, so a lost or repeated task leaves at most a
    file that no manifest names. ``path`` is any location pyarrow's file systems and Spark share.
    """
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        part, out = TaskContext.get().partitionId(), None
        enc = encoder(tokenizer)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            for step in steps(batch):
                if out is None:
                    files, root = fs.FileSystem.from_uri(path)
                    files.create_dir(f"{root}/ids", recursive=True)
                    name = f"ids/part-{part:06d}-{uuid.uuid4().hex}.planes"
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                    writer = PlaneWriter(out, chunk_ids, bits)
                ids, at = enc.encode(step.column("text"))
                ids = np.insert(ids, np.repeat(at[1:], len(end)), np.resize(end, len(end) * step.num_rows)) if len(end) else ids
                writer.add(ids, step.column("doc_id").to_pylist(), np.diff(at) + len(end))
        if out is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [name], "n_docs": [len(writer.doc_ids)],
                "n_ids": [writer.n_ids], "n_bytes": [writer.at],
            })

    rows.mapInArrow(lean(write), MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` (of the ids as little-endian uint32) and, if asked, ``ids``."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    # one row a file: the number of files is the number of write tasks
    base = manifest.withColumn("start", F.sum("n_ids").over(Window.orderBy("part")) - F.col("n_ids"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for name, size, start in zip(*(batch.column(c).to_pylist() for c in ("file", "n_bytes", "start"))):
                files, root = fs.FileSystem.from_uri(path)
                with files.open_input_file(f"{root}/{name}") as file:
                    rows, held = [], 0
                    for doc_id, ids in PlaneReader(file, size).documents():
                        rows.append((doc_id, start, len(ids), zlib.crc32(np.ascontiguousarray(ids)), ids))
                        start, held = start + len(ids), held + (len(ids) if with_ids else 0)
                        if len(rows) == 10_000 or held > 1 << 20:
                            yield _rows(rows, with_ids)
                            rows, held = [], 0
                    yield _rows(rows, with_ids)

    n_files = max(1, manifest.count())
    return base.select("file", "n_bytes", "start").repartition(n_files).mapInArrow(lean(read), schema)


def _rows(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    if with_ids:
        columns.append(pa.array([r[4].astype(np.int64) for r in rows], pa.list_(pa.int64())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)


def token_file_index(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` to scratch files and read their document index back."""
    path = scratch(spark, "token-planes")
    write_token_files(docs, path, tokenizer)
    return read_token_files(spark, path, with_ids=False)
