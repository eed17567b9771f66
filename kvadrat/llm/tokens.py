"""Text encoding with the tokenizers library, one library call per distinct text piece.

BPE tokenizers split a text before they merge, so a text cut where the splitter always cuts
gives the same ids piece by piece. The pieces of a step are hashed and made distinct at once
(numpy on Arrow's buffer); pieces that this worker has not met yet go through the library, and
the ids of all pieces are gathered from an array. Pieces are told apart by 64-bit hashes: two
of a worker's million pieces meet with a probability of about 3e-8.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from kvadrat.llm.common import Words

#: Bytes of remembered pieces (keys, places, sizes and ids) after which a worker forgets all of them.
MEMO_BYTES = 48 << 20

# White space outside ASCII can join a run of blanks; texts with it are encoded whole.
_ODD_SPACE = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)


class Encoder:
    def __init__(self, path: str, memo: int = MEMO_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are plain text
        with open(path, encoding="utf-8") as f:
            self.cut = _cutter(json.load(f))
        self.limit = memo
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of the known pieces
        self.at = np.zeros(0, np.int64)  # place of each one's ids in the pool
        self.size = np.zeros(0, np.int32)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _library_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for part in _parts(texts):
            found = [e.ids for e in self.library.encode_batch_fast(part, add_special_tokens=False)]
            size = np.fromiter(map(len, found), np.int64, len(found))
            ids.append(np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(size.sum())))
            sizes.append(size)
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in one array, and where each row's ids start (one more than rows)."""
        if self.cut is None or not len(column):
            ids, size = self._library_ids([t or "" for t in column.to_pylist()])
            return ids, np.concatenate([[0], np.cumsum(size)])
        words = Words(column)
        if self.cut == "spaced":
            _with_blanks(words)
        ids, starts = self._gather(words)
        if self.cut == "spaced":
            odd = {int(np.searchsorted(words.offsets, m.start(), "right")) - 1
                   for m in _ODD_SPACE.finditer(words.data)}
            if odd:
                rows = [ids[a:b] for a, b in zip(starts[:-1], starts[1:])]
                for row in odd:
                    rows[row] = self._library_ids([column[row].as_py()])[0]
                ids = np.concatenate(rows)
                starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        return ids, starts

    def _gather(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        if not len(words.starts):
            return np.zeros(0, np.uint32), np.zeros(len(words.first), np.int64)
        distinct, sample, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if 20 * len(self.keys) + 4 * self.used > self.limit:
            self._forget()
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        if not known.all():
            self._learn(distinct[~known], [words.word(i).decode() for i in sample[~known]])
            place = np.searchsorted(self.keys, distinct)
        size = self.size[place][which].astype(np.int64)
        end = np.cumsum(size)
        # position of each id in the pool: its piece's place plus its place in the piece
        at = np.repeat(self.at[place][which] - (end - size), size) + np.arange(end[-1])
        return self.pool[at], np.concatenate([[0], end])[words.first]

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        ids, size = self._library_ids(texts)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used // 2 + len(ids), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(size) - size
        self.used += len(ids)
        order = np.argsort(merged := np.concatenate([self.keys, keys]), kind="stable")
        self.keys = merged[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size.astype(np.int32)])[order]


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """Texts in calls of the library of about a quarter of a million characters: what it makes of a
    call (far larger than the ids) is freed before the next."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 32
        if size >= 1 << 18:
            yield texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield texts[first:]


def _with_blanks(words: Words) -> None:
    """Make the pieces of a byte-level splitter out of words: the last blank before a word
    goes with it, the rest of a run of white space is one piece, and so is its last character
    if that is no blank; white space at a text's end is one piece."""
    data, n = words.data, len(words.starts)
    filled = np.diff(words.first) > 0
    begin = np.empty(n, np.int64)  # where the white space before each word begins
    begin[1:] = words.ends[:-1]
    begin[words.first[:-1][filled]] = words.offsets[:-1][filled]
    blank = (words.starts > begin) & (data[np.maximum(words.starts, 1) - 1] == 32)
    starts = words.starts - blank
    gap = starts - begin
    alone = (gap > 0) & ~blank  # its last character is a piece of its own
    rest_end = starts - alone
    rest = rest_end > begin
    last = words.offsets[:-1].copy()
    last[filled] = words.ends[words.first[1:][filled] - 1]
    tail = words.offsets[1:] > last
    all_starts = np.concatenate([starts, starts[alone] - 1, begin[rest], last[tail]])
    all_ends = np.concatenate([words.ends, starts[alone], rest_end[rest], words.offsets[1:][tail]])
    order = np.argsort(all_starts, kind="stable")
    words.starts, words.ends = all_starts[order], all_ends[order]
    words.first = np.searchsorted(words.starts, words.offsets)


def _cutter(spec: dict) -> str | None:
    """How texts may be cut for this tokenizer: "spaced", "words" or not at all."""
    pre, norm, model = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec["model"]
    if model.get("type") != "BPE" or spec.get("truncation") or spec.get("padding") or spec.get("post_processor"):
        return None
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "spaced"
    parts = [p.get("type") for p in pre.get("pretokenizers", [])]
    kinds = [n.get("type") for n in (norm or {}).get("normalizers", [])]
    if model.get("end_of_word_suffix") and parts == ["Split", "ByteLevel"] and kinds == ["NFC", "Replace", "Lowercase"]:
        split = pre["pretokenizers"][0]
        if split.get("behavior") == "Removed" and split.get("invert"):  # white space is dropped
            return "words"
    return None


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per path and Python worker, kept over its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
