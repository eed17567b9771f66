"""Operator 9: benchmark decontamination with one Aho-Corasick automaton.

Texts and benchmark items are normalised alike: A-Z to a-z, every ASCII character that is no
letter or digit to a blank, words joined by one blank. Each window of ``window`` item words (an
item of fewer words is one window) becomes a key of the automaton, with a blank at both ends so
that only whole words match. A text is scanned once; hits are mapped back to code points of the
original text.

The automaton holds at most ``max_chars`` characters of item text; a larger benchmark is dealt
into as many automata as needed, which scan one after another and add to the same hits, so the
result does not depend on it. Null text has no words, null items have no windows; a null item_id
counts for hits but not as an item; every document row gives one row; an empty benchmark marks
nothing.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvadrat.llm.common import id_text, lean, stored, text_buffer, unused
from kvadrat.session import ship_package

_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)
_STATE = "doc_id long, text string, items array<long>, hits array<int>"
_RESULT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean,"
    " items array<long>, spans array<struct<start:long,end:long>>"
)
_AUTOMATA: dict[str, object] = {}


def windows(text: str | None, size: int) -> list[list[bytes]]:
    words = (text or "").encode().translate(_KEEP).split()
    return [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []


def _automaton(key: str, items: list[tuple[int | None, str | None]], size: int):
    """Built once per worker; the one before it is let go."""
    if key not in _AUTOMATA:
        import ahocorasick

        owners: dict[bytes, tuple[int, set]] = {}
        for item_id, text in items:
            for words in windows(text, size):
                owners.setdefault(b" " + b" ".join(words) + b" ", (len(words), set()))[1].add(item_id)
        automaton = ahocorasick.Automaton()
        for pattern, (n, ids) in owners.items():
            automaton.add_word(pattern.decode("latin-1"), (n, ids - {None}))
        automaton.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[key] = automaton
    return _AUTOMATA[key]


def _scan(docs: DataFrame, items: list[tuple], size: int, last: bool) -> DataFrame:
    shared, key = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, shared.value, size)
        ready = bool(len(automaton))
        for batch in batches:
            data, at = text_buffer(batch.column("text"))
            rows = []
            for i in range(batch.num_rows):
                raw = data[at[i] : at[i + 1]]
                found, hits = set(), []
                if not first:
                    found, hits = set(batch.column("items")[i].as_py()), batch.column("hits")[i].as_py()
                words = raw.tobytes().translate(_KEEP).split()
                if ready and words:
                    text = (b" " + b" ".join(words) + b" ").decode("latin-1")
                    matches = list(automaton.iter(text))
                    if matches:
                        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                        for end, w in zip(matches, np.searchsorted(ends, [m[0] for m in matches])):
                            n, ids = end[1]
                            found |= ids
                            hits += [int(w) - n + 1, int(w) + 1]
                rows.append((raw, len(words), found, hits))
            doc_ids = batch.column("doc_id")
            yield _result(doc_ids, rows) if last else pa.RecordBatch.from_arrays(
                [doc_ids, batch.column("text"), pa.array([sorted(r[2]) for r in rows], pa.list_(pa.int64())),
                 pa.array([r[3] for r in rows], pa.list_(pa.int32()))], names=["doc_id", "text", "items", "hits"])

    first = "items" not in docs.columns
    return docs.mapInArrow(lean(scan), _RESULT if last else _STATE)


def _result(doc_ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    n_hit, spans, items, digest = [], [], [], []
    for raw, n, found, hits in rows:
        spans.append([])
        if hits:
            change = np.zeros(n + 1, np.int64)
            np.add.at(change, hits[0::2], 1)
            np.add.at(change, hits[1::2], -1)
            hit = np.cumsum(change)[:n] > 0
            solid = np.frombuffer(raw.tobytes().translate(_KEEP), np.uint8) != 32
            edge = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            starts, ends = points[np.flatnonzero(edge == 1)], points[np.flatnonzero(edge == -1)]
            runs = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
            spans[-1] = [
                {"start": int(starts[a]), "end": int(ends[b - 1])}
                for a, b in zip(np.flatnonzero(runs == 1), np.flatnonzero(runs == -1))
            ]
            n_hit.append(int(hit.sum()))
        else:
            n_hit.append(0)
        items.append(sorted(found))
        digest.append(hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest())
    return pa.RecordBatch.from_pydict({
        "doc_id": doc_ids, "n_words": pa.array([r[1] for r in rows], pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([len(i) for i in items], pa.int64()), "items_sha256": pa.array(digest, pa.string()),
        "contaminated": pa.array([n > 0 for n in n_hit], pa.bool_()), "items": pa.array(items, pa.list_(pa.int64())),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    })


def _parts(benchmark: DataFrame, max_chars: int, item_id_col: str, item_text_col: str) -> Iterator[tuple[list[tuple], bool]]:
    """The benchmark in parts of about ``max_chars`` characters, and whether it is the last."""
    items = benchmark.select(F.col(item_id_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(chars / max_chars))
    for part in range(n):
        mine = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == part)
        yield [tuple(r) for r in mine.collect()], part == n - 1


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    max_chars: int = 400_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256 (of the item ids,
    sorted as strings), contaminated, items, spans (code points, end exclusive)."""
    state = id_text(docs, id_col, text_col)
    for items, last in _parts(benchmark, max_chars, item_id_col, item_text_col):
        if "items" in state.columns:
            state = stored(state, "contamination")
        state = _scan(state, items, window, last)
    return state


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    max_chars: int = 400_000,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark, all columns kept; rows are
    judged one by one where they lie, without a shuffle."""
    ship_package(docs.sparkSession)
    spark, names = docs.sparkSession, docs.columns
    if dict(docs.dtypes)[text_col] != "string":  # judged as its string
        (text,) = unused(names, text_col)
        docs, text_col = docs.withColumn(text, F.col(f"`{text_col}`").cast("string")), text
    for items, _ in _parts(benchmark, max_chars, item_id_col, item_text_col):
        docs = docs.mapInArrow(lean(_clean_rows(spark.sparkContext.broadcast(items), window, text_col)), docs.schema)
    return docs.select(*(F.col(f"`{c}`") for c in names))


def _clean_rows(shared, window: int, text_col: str):
    key = uuid.uuid4().hex

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, shared.value, window)
        ready = bool(len(automaton))
        for batch in batches:
            data, at = text_buffer(batch.column(text_col))
            keep = []
            for a, b in zip(at[:-1], at[1:]):
                words = data[a:b].tobytes().translate(_KEEP).split() if ready else []
                text = (b" " + b" ".join(words) + b" ").decode("latin-1")
                keep.append(not words or next(automaton.iter(text), None) is None)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return clean
