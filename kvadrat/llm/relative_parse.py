"""Operator 3: substring dedup by relative Lempel-Ziv parsing.

Documents are factored against the text of documents with smaller ids; factors of at least
``window`` words become duplicate spans. The reference is an index of blocks, spread by key:

* Every window of ``window`` words selects its smallest ``gram``-word hash as anchor; the run of
  windows with one anchor, with all its words, is a block. Equal windows have equal anchors, so
  whatever repeats meets in the index under its anchor.
* A block whose words stand in a document with a smaller id is a factor as it is.
* At factor boundaries, where a repeated passage is only part of a block, blocks that share an
  anchor with a different block are checked window by window in the same way. Only the first
  document of each block is, so copies add nothing.
* Each document is then parsed greedily: from the first covered word on, the factor that reaches
  furthest is taken, then the next.

Anchor and block (or window) hash together are a 128-bit key. Keys are counted before they are
joined; no pair of occurrences is formed, so a passage with any number of copies costs a row a
copy. Null text has no words; rows with a null doc_id are neither changed nor referred to; rows
with one doc_id never refer to each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvadrat.llm.common import Words, grams, id_text, lean, mix, signed, steps, stored

WINDOW, GRAM = 50, 10


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by block-wise running minima."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pad = np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([values, pad]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Parsed:
    """Words of a step's documents, and the anchor of every window, row by row."""

    def __init__(self, column: pa.Array, window: int, gram: int):
        self.words = Words(column)
        self.hashes = self.words.hashes()
        self.window = window
        first = self.words.first
        g = grams(self.hashes, gram)
        self.anchor = _least(g, window - gram + 1) if len(g) else g
        n = np.maximum(np.diff(first) - window + 1, 0)  # windows of each row
        self.row = np.repeat(np.arange(len(n)), n)
        self.start = first[:-1][self.row] + np.arange(len(self.row)) - np.repeat(np.cumsum(n) - n, n)

    def blocks(self) -> tuple[np.ndarray, ...]:
        """(row, anchor, block hash, place of the first window in its row, windows) per block."""
        anchor = self.anchor[self.start] if len(self.start) else np.zeros(0, np.uint64)
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (self.row[1:] != self.row[:-1])
        at = np.flatnonzero(new)
        n = np.diff(np.concatenate([at, [len(anchor)]]))
        base = 0xD6E8FEB86659FD93
        power = np.full(len(self.hashes) + 1, np.uint64(base), np.uint64)
        back = np.full(len(self.hashes) + 1, np.uint64(pow(base, -1, 1 << 64)), np.uint64)
        power[0] = back[0] = 1
        power, back = np.cumprod(power, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * power[:-1], dtype=np.uint64)])
        first = self.start[at] if len(at) else at
        end = first + n + self.window - 1
        block = mix((total[end] - total[first]) * back[first] + n.astype(np.uint64))
        return self.row[at], anchor[at], block, first - self.words.first[self.row[at]], n


def _blocks(rows: DataFrame, window: int, gram: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                row, anchor, block, at, n = Parsed(step.column("text"), window, gram).blocks()
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id").take(row), step.column("tie").take(row), pa.array(signed(anchor)),
                     pa.array(signed(block)), pa.array(at, pa.int32()), pa.array(n, pa.int32())],
                    names=["doc_id", "tie", "anchor", "block", "at", "n"])

    return rows.mapInArrow(lean(make), "doc_id long, tie long, anchor long, block long, at int, n int")


def _windows(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Windows of the blocks asked for: rows have doc_id, tie, text, asked (places and lengths)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                parsed = Parsed(step.column("text"), window, gram)
                whole = grams(parsed.hashes, window)
                rows, place = [], []
                for i, asked in enumerate(step.column("asked").to_pylist()):
                    for a in asked:
                        place.append(np.arange(a["at"], a["at"] + a["n"]))
                        rows.append(np.full(a["n"], i))
                row, place = np.concatenate(rows), np.concatenate(place)
                at = place + parsed.words.first[row]
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id").take(row), step.column("tie").take(row), pa.array(signed(parsed.anchor[at])),
                     pa.array(signed(whole[at])), pa.array(place, pa.int32())],
                    names=["doc_id", "tie", "anchor", "whole", "at"])

    return rows.mapInArrow(lean(make), "doc_id long, tie long, anchor long, whole long, at int")


def _parse(spans: list[dict]) -> list[tuple[int, int, int]]:
    """Greedy factors (start, end, source) that cover the union of the spans."""
    spans = sorted((s["at"], -s["end"], s["source"]) for s in spans)
    factors, done, i = [], 0, 0
    while i < len(spans):
        if -spans[i][1] <= done:
            i += 1
            continue
        start = max(done, spans[i][0])
        best = i
        while i < len(spans) and spans[i][0] <= start:
            best = i if spans[i][1] < spans[best][1] else best
            i += 1
        factors.append((start, -spans[best][1], spans[best][2]))
        done = -spans[best][1]
    return factors


def parse(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_words, n_removed, kept_text (kept words joined by one
    blank) and the copied factors array<struct<start, end, source>> in words."""
    rows = id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    blocks = _blocks(rows.where("doc_id IS NOT NULL"), window, gram)
    shared = blocks.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")
    repeated = stored(blocks.join(shared, "anchor", "left_semi"), "blocks")
    index = repeated.groupBy("anchor", "block").agg(F.min("doc_id").alias("source"))
    kinds = index.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    found = repeated.join(index, ["anchor", "block"])
    end = (F.col("at") + F.col("n") + window - 1).alias("end")
    whole = found.where("doc_id > source").select("doc_id", "tie", "at", end, "source")
    asked = found.where("doc_id = source").join(kinds.where("kinds > 1").select("anchor"), "anchor", "left_semi")
    asked = asked.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("at", "n")).alias("asked"))
    # rows equal in id and text give equal windows: one of them is enough
    checked = stored(_windows(rows.join(asked, ["doc_id", "tie"]), window, gram), "windows")
    sources = checked.groupBy("anchor", "whole").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("z")).where("source < z").drop("z")
    parts = checked.join(sources, ["anchor", "whole"]).where("doc_id > source").select(
        "doc_id", "tie", "at", (F.col("at") + window).alias("end"), "source")
    spans = whole.union(parts).groupBy("doc_id", "tie").agg(F.collect_set(F.struct("at", "end", "source")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, removed, kept, factors = [], [], [], []
            for text, some in zip(batch.column("text"), batch.column("spans").to_pylist()):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                n_words.append(len(words))
                factors.append(_parse(some) if some else [])
                if some:
                    keep = np.ones(len(words), bool)
                    for a, b, _ in factors[-1]:
                        keep[a:b] = False
                    words = list(compress(words, keep))
                removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            struct = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("source", pa.int64())])
            factors = [[{"start": a, "end": b, "source": c} for a, b, c in f] for f in factors]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string()), pa.array(factors, pa.list_(struct))],
                names=["doc_id", "n_words", "n_removed", "kept_text", "factors"])

    joined = rows.join(spans, ["doc_id", "tie"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept_text string, factors array<struct<start:long,end:long,source:long>>")
