"""Operator 11: fill-in-middle transformation by in-place block rotation.

A text is cut into units (white space with the word after it; white space at the end is a unit of its
own). A scan over a step's bytes finds where units end; two hashes of the id choose two cuts, which
make prefix, middle and suffix. The sentinels are inserted into a bytearray of the text at the
cuts, and segments change places in it by rotations of three reversals each: reverse both parts,
then the whole. ``restore`` finds the sentinels, turns the rotations back and takes the sentinels
out, which gives the text exactly.

``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` is <S>suffix<P>prefix<M>middle. A text stays
``plain`` if it is empty, holds a sentinel (it could not be restored) or is not drawn. Cuts lie at
code points, for words and white space begin at them. Null text counts as empty; a null id is
hashed as no digits; equal rows give equal results; a row is handled on its own, so nothing is
shuffled, and a very long text is a step of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvadrat.llm.common import Words, id_text, lean, steps, text_buffer

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_DRAWS = ["h1", "h2", "h3", "h4"]


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four groups of eight hex digits of the hash of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.sha2(key, 256)
    return [F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long").alias(h) for i, h in enumerate(_DRAWS)]


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange the segments [start, cut) and [cut, end) in place."""
    for a, b in ((start, cut), (cut, end), (start, end)):
        buffer[a:b] = buffer[a:b][::-1]


def scramble(text: bytes, cut1: int, cut2: int, form: str) -> bytearray:
    """``text`` in the given form, its middle being the bytes [cut1, cut2)."""
    buffer = bytearray(text)
    buffer[cut2:cut2] = SUFFIX
    buffer[cut1:cut1] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix, end = cut1 + 3, cut2 + 6, len(buffer)
    if form == "psm":
        rotate(buffer, middle, suffix, end)
    else:
        rotate(buffer, 0, suffix, end)
    return buffer


def unscramble(output: bytes, form: str) -> bytearray:
    """The text that ``scramble`` was given."""
    buffer = bytearray(output)
    if form == "plain":
        return buffer
    end, middle = len(buffer), buffer.rindex(MIDDLE)
    if form == "psm":
        suffix = buffer.index(SUFFIX)
        rotate(buffer, suffix, middle, end)  # <P>prefix<M>middle<S>suffix again
        middle = suffix
    else:
        prefix = buffer.index(PREFIX)
        rotate(buffer, 0, prefix, end)
        middle -= prefix
    suffix = buffer.rindex(SUFFIX)
    for at in (suffix, middle, 0):
        del buffer[at : at + 3]
    return buffer


def _marked(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row holds a sentinel."""
    out = np.zeros(len(offsets) - 1, bool)
    if len(data) > 2:
        at = np.flatnonzero((data[:-2] == 60) & (data[2:] == 62) & np.isin(data[1:-1], (80, 83, 77)))
        row = np.searchsorted(offsets, at, "right") - 1
        out[row[at + 3 <= offsets[row + 1]]] = True
    return out


def _strings(parts: list[bytes | bytearray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.StringArray.from_buffers(len(parts), pa.py_buffer(ends), pa.py_buffer(b"".join(parts)))


def transform(
    docs: DataFrame,
    seed: int = 42,
    percent: int = 50,
    spm_percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document row: doc_id, n (units), form, prefix_chars, middle_chars (null if plain),
    output. ``percent`` of the ids are drawn, ``spm_percent`` of those get the form spm."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                words = Words(step.column("text"))
                data, offsets, first = words.data, words.offsets, words.first
                h1, h2, h3, h4 = (step.column(h).to_numpy() for h in _DRAWS)
                solid = np.diff(first)
                last = offsets[:-1].copy()
                last[solid > 0] = words.ends[first[1:][solid > 0] - 1]
                n = solid + (offsets[1:] > last)
                cuts = []
                for unit in (np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))):
                    at = np.where(unit > solid, offsets[1:], offsets[:-1])
                    inside = (unit > 0) & (unit <= solid)
                    at[inside] = words.ends[(first[:-1] + unit - 1)[inside]]
                    cuts.append(at)
                plain = (np.diff(offsets) == 0) | _marked(data, offsets) | (h3 % 100 >= percent)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                form = np.where(plain, "plain", np.where(h4 % 100 < spm_percent, "spm", "psm"))
                raw, out = data.tobytes(), []
                for a, b, cut1, cut2, kind in zip(offsets[:-1].tolist(), offsets[1:].tolist(), cuts[0].tolist(), cuts[1].tolist(), form):
                    text = raw[a:b]
                    out.append(text if kind == "plain" else scramble(text, cut1 - a, cut2 - a, kind))
                chars = [points[cuts[0]] - points[offsets[:-1]], points[cuts[1]] - points[cuts[0]]]
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), pa.array(n), pa.array(form.tolist(), pa.string()),
                     *(pa.array(c, pa.int64(), mask=plain) for c in chars), _strings(out)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = id_text(docs, id_col, text_col)
    drawn = rows.select("doc_id", "text", *_draws(F.col("doc_id"), seed))
    return drawn.mapInArrow(lean(make), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(transformed: DataFrame) -> DataFrame:
    """``transformed`` (any rows with form and output) with the exact text as ``restored``."""
    names = transformed.columns

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch, "output"):
                data, at = text_buffer(step.column("output"))
                raw, forms = data.tobytes(), step.column("form").to_pylist()
                texts = [unscramble(raw[a:b], form) for a, b, form in zip(at[:-1].tolist(), at[1:].tolist(), forms)]
                yield pa.RecordBatch.from_arrays([*step.columns, _strings(texts)], names=[*names, "restored"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in transformed.schema)
    return transformed.mapInArrow(lean(make), f"{fields}, restored string")
