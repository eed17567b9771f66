"""Operator 6: packing into fixed-size sequences by exact-complement hashing.

Documents become pieces of at most ``capacity`` tokens. Only the histogram of piece lengths
(at most ``capacity`` entries) reaches the driver. There the longest remaining length is filled
up exactly: an index of available lengths, of pair sums and of triple sums is asked for the gap,
and the combination found is consumed as often as the counts allow. What has no exact
complement goes to the fullest open sequence that takes it (best fit). The plan is a list of
fills, each a tuple of lengths and how many sequences take it; pieces find their place by their
rank among the pieces of their length, so no piece and no sequence passes through the driver.

Null or empty text is a document of the end id alone; a null doc_id stays null; equal rows are
packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kvadrat.llm.common import id_text, lean, steps, stored
from kvadrat.llm.tokens import encoder

Fill = tuple[int, tuple[int, ...]]  # number of sequences, lengths in each


def plan_fills(counts: np.ndarray, capacity: int) -> list[Fill]:
    """``counts[n]``: available pieces of length n. Uses every piece exactly once."""
    left = np.zeros(capacity + 1, np.int64)
    left[: len(counts)] = counts
    fills: list[Fill] = []
    open_: dict[int, list[Fill]] = {}  # residual gap -> fills with that gap
    for n in range(capacity, 0, -1):
        while left[n]:
            mates = _complement(left, n, capacity - n)
            if mates is None:
                break
            used = np.bincount((n, *mates), minlength=capacity + 1)
            times = int((left[used > 0] // used[used > 0]).min())
            left -= times * used
            fills.append((times, (n, *mates)))
        if left[n]:
            _best_fit(open_, n, int(left[n]), capacity)
            left[n] = 0
            # a residual may now be closed exactly by shorter lengths still available
            fills += open_.pop(0, [])
            for gap in [g for g in open_ if g < n]:
                _close(open_, gap, left, fills)
    for some in open_.values():
        fills += some
    return fills


def _complement(left: np.ndarray, n: int, gap: int) -> tuple[int, ...] | None:
    """Available lengths, at most three and the longest first, that sum up to ``gap`` while a
    piece of length ``n`` is held (0: none)."""
    if gap == 0:
        return ()
    have = left[: gap + 1].copy()
    if n <= gap:
        have[n] -= 1
    if have[gap] > 0:
        return (gap,)
    pair = _pair(have, gap)
    if pair:
        return pair
    for a in np.flatnonzero(have[: gap - 1] > 0)[::-1]:
        if 3 * a < gap:
            break
        have[a] -= 1
        pair = _pair(have[: a + 1], gap - int(a))
        have[a] += 1
        if pair:
            return (int(a), *pair)
    return None


def _pair(have: np.ndarray, total: int) -> tuple[int, int] | None:
    top = min(len(have) - 1, total - 1)
    low = (total + 1) // 2
    if top < low:
        return None
    a = np.arange(top, low - 1, -1)
    ok = (have[a] > 0) & (have[total - a] > (a == total - a))
    return (int(a[ok.argmax()]), int(total - a[ok.argmax()])) if ok.any() else None


def _close(open_: dict[int, list[Fill]], gap: int, left: np.ndarray, fills: list[Fill]) -> None:
    while open_.get(gap):
        mates = _complement(left, 0, gap)
        if mates is None:
            return
        used = np.bincount(mates, minlength=len(left))
        times, lengths = open_[gap].pop()
        some = min(times, int((left[used > 0] // used[used > 0]).min()))
        left -= some * used
        fills.append((some, lengths + mates))
        if times > some:
            open_[gap].append((times - some, lengths))


def _best_fit(open_: dict[int, list[Fill]], n: int, count: int, capacity: int) -> None:
    def put(gap: int, fill: Fill) -> None:
        open_.setdefault(gap, []).append(fill)

    for gap in sorted(g for g in open_ if g >= n):
        while count and open_[gap]:
            times, lengths = open_[gap].pop()
            fit = min(gap // n, max(1, count // times))
            some = min(times, count)
            put(gap - fit * n, (some, lengths + (n,) * fit))
            count -= some * fit
            if times > some:
                put(gap, (times - some, lengths))
    each = capacity // n
    if count >= each:
        put(capacity - each * n, (count // each, (n,) * each))
    if count % each:
        put(capacity - (count % each) * n, (1, (n,) * (count % each)))


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """One row per piece, with its place among the pieces of its length that its task made."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long" + ", ids array<long>" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for step in steps(batch):
                ids, at = enc.encode(step.column("text"))
                ids = np.insert(ids, at[1:], end_id).astype("<u4")
                at = at + np.arange(len(at))
                size = np.diff(at)
                n = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(size[row] - start, capacity)
                first = at[row] + start
                place = np.empty(len(row), np.int64)
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                place[order] = np.arange(len(row)) - np.searchsorted(ranked, ranked) + seen[ranked]
                seen += np.bincount(length, minlength=capacity + 1)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(first, first + length)]
                out = {
                    "doc_id": step.column("doc_id").take(pa.array(row)), "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()),
                    "part": pa.array(np.full(len(row), part), pa.int32()), "place": pa.array(place),
                }
                if with_ids:
                    out["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in zip(first, first + length)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    return id_text(docs, id_col, text_col).mapInArrow(lean(cut), schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Ranks come from counts: each task numbers its pieces of a length, and a table of at most
    (tasks x lengths) counts gives every task its base, so a length that a third of all pieces
    share is not gathered anywhere.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids), "pieces")
    counts = stored(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    bases = counts.select(
        "length", "part",
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("base"),
    )
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most capacity rows
        histogram[row["length"]] = row["n"]
    slots = spark.sparkContext.broadcast(_slots(plan_fills(histogram, capacity), capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, first, offset = slots.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            # ranks of all lengths on one line: slot k of a length serves ranks [bounds[k-1], bounds[k])
            key = length * _LINE + batch.column("rank").to_numpy()
            k = np.searchsorted(bounds, key, side="right")
            before = np.where(k > 0, bounds[np.maximum(k, 1) - 1], 0)
            before = np.maximum(before, length * _LINE)
            sequence = first[k] + (key - before)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset[k])], schema=None,
                names=[*keep, "sequence_id", "offset"])

    keep = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    ranked = cut.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("place"))
    return ranked.select(*keep, "rank").mapInArrow(lean(place), schema + ", sequence_id long, offset long")


_LINE = np.int64(1) << 48  # more pieces of one length than any table has


def _slots(fills: list[Fill], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per length and slot, in rank order: end of the ranks it serves, the sequence of its
    first rank, and the offset there. At most a few slots per length of the plan."""
    by_length: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for times, lengths in fills:
        offset = 0
        for n in lengths:
            by_length.setdefault(n, []).append((times, sequence, offset))
            offset += n
        sequence += times
    bounds, first, offsets = [], [], []
    for n in sorted(by_length):
        end = int(n * _LINE)
        for times, seq, offset in by_length[n]:
            end += times
            bounds.append(end)
            first.append(seq)
            offsets.append(offset)
    return np.array(bounds, np.int64), np.array(first, np.int64), np.array(offsets, np.int64)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from ``pack(..., with_ids=True)``: sequence_id and ids.
    A sequence has at most ``capacity`` ids, so no group is larger than that."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
