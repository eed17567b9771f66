"""Operator 7: secret scan by dictionary-primed zstandard novelty.

Base patterns find assignments, access keys and hex strings. Beyond them, every key-like string
after a sensitive word is a candidate: it is compressed after the text around it by a zstandard
compressor primed with the corpus's identifiers, and the bytes it adds are measured. Strings that
cost at least ``novelty`` bytes per character cannot be told from what surrounds them or from
known identifiers, and are reported with kind ``novel``.

The dictionary holds the identifiers that stand near sensitive words, most documents first, at
most ``dictionary_bytes`` of them; they are counted over all documents. Runs of letters and digits
that could be keys themselves take no part, and other places of a candidate in the text around it
are blanked before it is measured, so a secret with copies is as novel as one without. Null or empty text gives
no spans; every row gives one row; rows are judged one by one; an empty table gives an empty
result. Spans are code points, end exclusive, in order of start, then of kind.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvadrat.llm.common import LOWER, id_text, lean, text_buffer

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")  # whole runs: a match starts where a run starts
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: Words that make what follows sensitive.
SENSITIVE = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key", b"credential", b"private_key",
             b"access_key", b"bearer", b"authorization", b"signature")
_SENSITIVE = re.compile(b"|".join(SENSITIVE))
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
_IDENTIFIER = re.compile(rb"[A-Za-z_][A-Za-z0-9_]{3,}")
#: Runs as long as a candidate, and values after "=": keys themselves if they mix letters and digits.
_KEY = re.compile(rb"[A-Za-z0-9+/_-]{16,}|(?<==)[A-Za-z0-9+/_-]+")
_REACH, _AROUND = 48, 512  # bytes after a sensitive word; bytes of context on either side


def base_spans(raw: bytes, low: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes; ``low`` is ``raw`` in lower case."""
    out = []
    if any(name in low for name in _NAMES):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(raw) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(raw) if m.end() - m.start() >= 20]
    return out + [(m.start(), m.end(), "hex") for m in _HEX.finditer(raw)]


def candidates(raw: bytes, low: bytes) -> list[tuple[int, int]]:
    """Key-like strings that begin within reach of a sensitive word."""
    found = set()
    for m in _SENSITIVE.finditer(low):
        for c in _CANDIDATE.finditer(raw, m.end(), m.end() + _REACH + 4096):
            if c.start() - m.end() > _REACH:
                break
            end = c.end()
            while end < len(raw) and _CANDIDATE.fullmatch(raw, c.start(), end + 1):
                end += 1
            found.add((c.start(), end))
    return sorted(found)


def marginal_bytes(pack, raw: bytes, start: int, end: int) -> int:
    """Compressed bytes that the string adds to the text around it, other places of it blanked."""
    text, more = raw[start:end], _AROUND + end - start
    blank = b" " * len(text)  # whole occurrences are looked for, also across the ends of the context
    before = raw[max(0, start - more) : start].replace(text, blank)[-_AROUND:]
    around = before + raw[end : end + more].replace(text, blank)[:_AROUND]
    return len(pack(around + text)) - len(pack(around))


def _without_keys(text: bytes) -> bytes:
    """The text with key-like runs blanked, in place."""
    return _KEY.sub(lambda m: b" " * len(m[0]) if re.search(rb"[0-9]", m[0]) and re.search(rb"[A-Za-z]", m[0]) else m[0], text)


def _novel(pack, raw: bytes, low: bytes, base: list[tuple[int, int, str]], novelty: float) -> list[tuple[int, int, str]]:
    out = []
    for start, end in candidates(raw, low):
        if any(a < end and start < b for a, b, _ in base):
            continue
        text = raw[start:end]
        if sum(bool(re.search(p, text)) for p in (rb"[0-9]", rb"[a-z]", rb"[A-Z]")) >= 2 and (
            marginal_bytes(pack, raw, start, end) >= novelty * len(text)
        ):
            out.append((start, end, "novel"))
    return out


def identifiers(docs: DataFrame, dictionary_bytes: int) -> bytes:
    """The zstandard dictionary: identifiers near sensitive words, the commonest last, where
    references to them are cheapest."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_buffer(batch.column("text"))
            low = LOWER[data]
            found: Counter[str] = Counter()
            for a, b in zip(at[:-1], at[1:]):
                text = low[a:b].tobytes()
                names, plain = set(), None
                for m in _SENSITIVE.finditer(text):
                    plain = _without_keys(text) if plain is None else plain
                    near = plain[max(0, m.start() - _AROUND) : m.end() + _AROUND]
                    names.update(x for x in _IDENTIFIER.findall(near) if len(x) <= 40)
                found.update(x.decode() for x in names)
            yield pa.RecordBatch.from_pydict({"name": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

    names = docs.select("text").mapInArrow(lean(count), "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))
    top = names.where("n > 1").orderBy(F.desc("n"), "name").limit(dictionary_bytes // 5).toArrow()["name"].to_pylist()
    out, size = [], 0
    for name in top:
        size += len(name) + 1
        if size > dictionary_bytes:
            break
        out.append(name.encode())
    return b" ".join(reversed(out))


def scan(docs: DataFrame, novelty: float = 0.7, dictionary_bytes: int = 1 << 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_assign, n_access, n_hex, n_novel, base_sha256 and
    spans (kind:start:end, comma-joined)."""
    rows = id_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(identifiers(rows, dictionary_bytes))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        words = shared.value
        primed = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(words) >= 8 else None
        pack = zstandard.ZstdCompressor(level=6, dict_data=primed, write_checksum=False, write_content_size=False).compress
        for batch in batches:
            data, at = text_buffer(batch.column("text"))
            low = LOWER[data]
            counts, digests, spans = [], [], []
            for a, b in zip(at[:-1], at[1:]):
                raw, lower = data[a:b].tobytes(), low[a:b].tobytes()
                base = base_spans(raw, lower)
                every = base + _novel(pack, raw, lower, base, novelty)
                counts.append([sum(s[2] == k for s in every) for k in KINDS])
                points = np.cumsum((data[a:b] & 0xC0) != 0x80) if every else None
                told = [_told(points, found) for found in (base, every)]
                digests.append(hashlib.sha256(told[0].encode()).hexdigest())
                spans.append(told[1])
            columns = np.array(counts, np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c) for c in columns), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return rows.mapInArrow(lean(find), schema)


def _told(points: np.ndarray, spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    at = lambda i: int(points[i - 1]) if i else 0  # noqa: E731  code points before byte i
    return ",".join(f"{kind}:{at(a)}:{at(b)}" for a, b, kind in ordered)
