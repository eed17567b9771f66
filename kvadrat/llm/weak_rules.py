"""Operator 5: quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a text. The votes of all documents are
counted by pattern, expectation-maximisation over the patterns (at most 3 ** rules) estimates how
often each rule says what about good and bad documents, and a document is kept when the posterior
probability that it is good reaches ``keep_at``. A document that fails the base rules is never
kept.

Null text has no words, fails the base rules and is not kept. Every row gives one row; rows are
judged one by one, so repeated ids and ties need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvadrat.llm.common import Words, grams, id_text, lean, mix, steps

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True

RULES = ("length", "symbols", "upper", "repeats", "lines", "letters", "word_length", "variety")
_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])


def _measure(column: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base statistics and the votes (rows x rules) of a step's texts."""
    words = Words(column)
    data, at, first = words.data, words.offsets, words.first
    n = np.diff(first)
    solid = np.zeros(len(data) + 1, np.int64)
    np.add.at(solid, words.starts, 1)
    np.add.at(solid, words.ends, -1)
    chars = _per_row((np.cumsum(solid)[:-1] > 0) & ((data & 0xC0) != 0x80), at)
    hashes = words.hashes()
    row = np.repeat(np.arange(len(n)), n)
    g = grams(hashes, 5)
    repeat, distinct = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    if len(hashes):
        _, one = np.unique(mix(hashes + mix(row.astype(np.uint64))), return_index=True)
        distinct = np.bincount(row[one], minlength=len(n))
    if len(g):
        inside = np.flatnonzero(row[: len(g)] == row[4:])
        _, which, count = np.unique(mix(g[inside] + mix(row[inside].astype(np.uint64))), return_inverse=True, return_counts=True)
        twice = inside[count[which] > 1]
        cover = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + 5, -1)
        repeat = np.bincount(row[np.cumsum(cover)[:-1] > 0], minlength=len(n))
    dup, n_lines = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    for i in range(len(n)):
        lines = [x for x in data[at[i] : at[i + 1]].tobytes().split(b"\n") if x.split(None, 1)]
        n_lines[i] = len(lines)
        dup[i] = len(lines) - len(set(lines))
    symbols = _per_row(_SYMBOLS[data], at)
    upper, lower = _per_row(_UPPER[data], at), _per_row(_LOWER[data], at)
    other = _per_row((data > 127) & ((data & 0xC0) != 0x80), at)
    share = lambda a, b: a / np.maximum(b, 1)
    some = n > 0

    def vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
        return np.where(some & bad, -1, np.where(some & good, 1, 0))

    letters = upper + lower + other
    votes = np.stack([
        vote(n >= 40, n < 5),
        vote(share(symbols, n) < 0.02, share(symbols, n) > 0.2),
        vote((share(upper, letters) < 0.15), (share(upper, letters) > 0.4) & (n >= 5)),
        vote(share(repeat, n) < 0.05, share(repeat, n) > 0.3),
        vote((dup == 0) & (n_lines > 1), share(dup, n_lines) > 0.3),
        vote(share(letters, chars) > 0.9, share(letters, chars) < 0.7),
        vote((share(chars, n) > 2.5) & (share(chars, n) < 12), (share(chars, n) < 2) | (share(chars, n) > 15)),
        vote((share(distinct, n) > 0.3) & (n >= 20), (share(distinct, n) < 0.15) & (n >= 20)),
    ], axis=1)
    return dict(zip(_STATS, (n, chars, symbols, dup, repeat))), votes


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base statistics, and ``pattern``: the votes as a number in base 3."""
    power = 3 ** np.arange(len(RULES))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps(batch):
                stats, votes = _measure(step.column("text"))
                pattern = ((votes + 1) * power).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), *(pa.array(s.astype(np.int64)) for s in stats.values()), pa.array(pattern, pa.int32())],
                    names=["doc_id", *_STATS, "pattern"])

    schema = "doc_id long, " + ", ".join(f"{s} long" for s in _STATS) + ", pattern int"
    return id_text(docs, id_col, text_col).mapInArrow(lean(make), schema)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray, np.ndarray]:
    """Prior of good, P(vote | class) by rule, and the posterior of good of each pattern."""
    votes = (patterns[:, None] // 3 ** np.arange(len(RULES))) % 3
    # start: one bad vote outweighs the good ones, which most rules give to most texts
    good = 1 / (1 + np.exp(4.0 * (votes == 0).sum(axis=1) - 0.25 * (votes == 2).sum(axis=1)))
    prior, table = 0.5, np.zeros((2, len(RULES), 3))
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        for v in range(3):
            table[:, :, v] = weight @ (votes == v)
        table += 0.5  # no vote is impossible
        table /= table.sum(axis=2, keepdims=True)
        prior = (weight[1].sum() + 1) / (counts.sum() + 2)
        logs = np.log(np.stack([1 - prior, prior]))[:, None] + sum(
            np.log(table[:, r, :][:, votes[:, r]]) for r in range(len(RULES)))
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
        if np.abs(new - good).max(initial=0) < 1e-9:
            break
        good = new
    return prior, table, good


def judge(docs: DataFrame, keep_at: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, base statistics, base_failed, quality (posterior), kept."""
    found = measured(docs, id_col, text_col)
    rows = found.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").toArrow()
    patterns, counts = rows["pattern"].to_numpy().astype(np.int64), rows["n"].to_numpy()
    _, _, good = estimate(patterns, counts)
    # at most 3 ** rules rows
    posterior = docs.sparkSession.createDataFrame(
        [(int(p), float(g)) for p, g in zip(patterns, good)], "pattern int, quality double")
    n, repeat = F.col("n_words"), F.col("n_repeat_words")
    base_failed = (n < 10) | (100 * repeat > 20 * n)
    return found.join(F.broadcast(posterior), "pattern").select(
        "doc_id", *_STATS, base_failed.alias("base_failed"), "quality",
        (~base_failed & (F.col("quality") >= keep_at)).alias("kept"))
