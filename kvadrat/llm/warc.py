"""Operator 8: WARC archives and a salvage reader.

Every record is a gzip member of its own. A page whose payload equals another's is a revisit
record of the one with the largest page_id: it keeps the HTTP head with the payload's length and
digest but not the payload. The reader checks each member, its records' lengths and, where a record
tells one, its digest; after a failure it looks for the next gzip member or version line,
goes on there and logs the bytes between as a quarantined gap. A member may hold any number of
records: it is unpacked piece by piece and read record by record, what lies between its
records is logged with its place inside, and of a damaged member the whole records before the
damage are kept.

Null html is an empty payload. A page with a null page_id is a response that no other page
revisits. Rows equal in page_id and payload are all responses if that id is the largest. An empty
table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvadrat.llm.common import lean, scratch
from kvadrat.session import ship_package

MANIFEST = "file string, n_records long, n_bytes long"
RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
)
#: inside: place in the unpacked bytes of the member at ``offset``; null for bytes of the archive itself.
GAP = "file string, offset long, n_bytes long, inside long, reason string"
_ROLL = 64 << 20  # an archive is closed once it is this large
_FEED = 1 << 13
_HEAD = 1 << 16  # the longest head of a record
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_LENGTH = re.compile(rb"(?i)\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n")
_MEMBER = b"\x1f\x8b\x08"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The bytes of a response, or of a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}",
            f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_urn(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, digest and refers_to (the largest page_id with an equal payload of at
    least ``min_bytes`` bytes, null for itself). Only payloads that occur twice are joined."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1("html")).withColumn("size", F.octet_length("html"))
    known = rows.where((F.col("size") >= min_bytes) & F.col("page_id").isNotNull())
    last = known.groupBy("sha", "size").agg(F.max("page_id").alias("last"), F.min("page_id").alias("least")).where("least < last").drop("least")
    joined = rows.join(last, ["sha", "size"], "left")
    refers = F.when(F.col("page_id") < F.col("last"), F.col("last"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write archives under ``path`` and return their manifest, stored beside them. Files have
    names of their own; only files of tasks that ended are in the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        part, files, out, done = TaskContext.get().partitionId(), None, None, []
        for batch in batches:
            for page_id, url, html, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    files, root = fs.FileSystem.from_uri(path)
                    files.create_dir(f"{root}/warc", recursive=True)
                    name, n, size = f"warc/part-{part:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                payload = html.encode()
                data = _member(record(page_id, url, payload, digest_of(payload), refers))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= _ROLL:
                    out.close()
                    done.append((name, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, n, size))
        if done:
            yield pa.RecordBatch.from_pydict({k: [d[i] for d in done] for i, k in enumerate(("file", "n_records", "n_bytes"))})

    plan_records(pages, min_bytes).mapInArrow(lean(write), MANIFEST).write.parquet(f"{path}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _parse(data: bytes) -> dict | None:
    """A whole record's fields, or nothing if it is damaged."""
    if not _VERSION.match(data):
        return None
    head, sep, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        name = name.strip().lower().decode("latin-1")
        if not colon or name == "warc-type" and name in fields:  # a second head began inside this one
            return None
        fields[name] = value.strip().decode("utf-8", "replace")
    try:
        size = int(fields["content-length"])
    except (KeyError, ValueError):
        return None
    if not sep or len(rest) < size + 4 or rest[size : size + 4] != b"\r\n\r\n":
        return None
    block = rest[:size]
    http, split, payload = block.partition(b"\r\n\r\n")
    if not split:  # a block without a head of its own is all payload
        http, payload = b"", block
    kind = fields.get("warc-type")
    if kind == "response" and not _agrees(fields.get("warc-payload-digest"), payload):
        return None
    if not _agrees(fields.get("warc-block-digest"), block):
        return None
    algorithm, _, digest = fields.get("warc-payload-digest", "").rpartition(":")
    if kind == "response" and algorithm.lower() != "sha1":  # none told, or another one
        digest = digest_of(payload)
    told = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    number = lambda k: int(fields[k]) if fields.get(k, "").lstrip("-").isdigit() else None
    return {"page_id": number("x-page-id"), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": len(payload) if kind == "response" else int(told[1]) if told else None,
            "payload_digest": digest or None, "refers_to": number("x-refers-to-page"),
            "payload": payload if kind == "response" else None}


def _agrees(told: str | None, data: bytes) -> bool:
    """Whether ``data`` has the digest that is told; an absent one or one of an unknown algorithm
    rules nothing out. The algorithm's name is read in any case, digests as base32 or hex."""
    algorithm, colon, digest = (told or "").partition(":")
    algorithm = algorithm.strip().lower().replace("-", "")
    if not colon or algorithm not in ("md5", "sha1", "sha256", "sha512"):
        return True
    raw = hashlib.new(algorithm, data).digest()
    digest = digest.strip()
    return digest.upper().rstrip("=") == base64.b32encode(raw).decode().rstrip("=") or digest.lower() == raw.hex()


def _at(data: bytes, at: int, more: bool) -> tuple[dict | None, int]:
    """The whole record at ``at`` and where it ends; (None, 0) if none is there, (None, -1) if that
    cannot be told before ``more`` bytes come."""
    if not _VERSION.match(data, at):
        return None, -1 if more and len(data) - at < 10 else 0
    head = data.find(b"\r\n\r\n", at, at + _HEAD)
    if head < 0:
        return None, -1 if more and len(data) - at < _HEAD else 0
    size = _LENGTH.search(data, at, head + 2)
    if not size:
        return None, 0
    end = head + 8 + int(size[1])
    if end > len(data):
        return None, -1 if more else 0
    found = _parse(data[at:end])
    return found, end if found else 0


def _inside(unpacked: Iterator[bytes]) -> Iterator[tuple[str, dict]]:
    """Events of the unpacked bytes of a member, whose gaps tell their place ``inside``."""
    held, base, bad = b"", 0, None  # base: place of held[0]; bad: where a gap began
    for piece in [*_pieces(unpacked), None]:
        more = piece is not None
        held, at = held + (piece or b""), 0
        while at < len(held):
            found, end = _at(held, at, more)
            if end < 0:
                break
            if found:
                if bad is not None:
                    yield "gap", {"inside": bad, "n_bytes": base + at - bad, "reason": "no record inside a member"}
                    bad = None
                yield "record", found
                at = end
                continue
            bad = base + at if bad is None else bad
            line = _VERSION.search(held, at + 1)
            at = line.start() if line else max(at + 1, len(held) - 9) if more else len(held)
        held, base = held[at:], base + at
    if bad is not None:
        yield "gap", {"inside": bad, "n_bytes": base - bad, "reason": "no record inside a member"}


def _pieces(unpacked: Iterator[bytes], least: int = 1 << 20) -> Iterator[bytes]:
    """The bytes in larger pieces, so that a long record is looked at a few times only."""
    parts, size = [], 0
    for part in unpacked:
        parts.append(part)
        size += len(part)
        if size >= least:
            yield b"".join(parts)
            parts, size, least = [], 0, min(2 * least, 1 << 26)
    yield b"".join(parts)


class _Unpacked:
    """Pieces of the member at ``at``; ``end``: where it ends, None if it is damaged or cut."""

    def __init__(self, data: bytes, at: int):
        self.data, self.at, self.end = data, at, None

    def __iter__(self) -> Iterator[bytes]:
        unpack, pos = zlib.decompressobj(31), self.at
        while not unpack.eof and pos < len(self.data):  # unused_data copies what it is given
            before = unpack.copy()
            try:
                part = unpack.decompress(self.data[pos : pos + _FEED])
            except zlib.error:
                yield from self._last(before, pos)
                return
            yield part
            pos += _FEED
        if unpack.eof:
            self.end = min(pos, len(self.data)) - len(unpack.unused_data)

    def _last(self, unpack, pos: int) -> Iterator[bytes]:
        """What the piece at ``pos`` gives before it fails."""
        with contextlib.suppress(zlib.error):
            for at in range(pos, pos + _FEED, 16):
                yield unpack.decompress(self.data[at : at + 16])


def salvage(data: bytes) -> Iterator[tuple[str, dict]]:
    """("record", fields) of every whole record of an archive, compressed by member or plain, and
    ("gap", offset, n_bytes, inside, reason) of every stretch of bytes that belongs to none. Every byte
    of the archive is in a record, in a whole member with a record, or in a gap."""
    at, bad = 0, None

    def gap(end: int) -> Iterator[tuple[str, dict]]:
        if bad:
            yield "gap", {"offset": bad[0], "n_bytes": end - bad[0], "inside": None, "reason": bad[1]}

    while at < len(data):
        end, reason = 0, "no record starts here"
        if data.startswith(_MEMBER, at):
            member, some, reason = _Unpacked(data, at), False, "damaged member"
            for kind, found in _held_back(_inside(iter(member))):
                if kind == "record" and not some:
                    some = True
                    yield from gap(at)
                    bad = None
                if kind == "record" or some and member.end:
                    yield kind, found if kind == "record" else found | {"offset": at}
            if member.end:
                end, reason = member.end if some else 0, "damaged record"
        elif _VERSION.match(data, at):
            reason = "damaged record"
            found, end = _at(data, at, False)
            if found:
                yield from gap(at)
                bad = None
                yield "record", found
        if end:
            at = end
            continue
        bad = bad or (at, reason)
        member = data.find(_MEMBER, at + 1)
        line = _VERSION.search(data, at + 1)
        at = min([len(data), *([member] if member >= 0 else []), *([line.start()] if line else [])])
    yield from gap(len(data))


def _held_back(events: Iterator[tuple[str, dict]]) -> Iterator[tuple[str, dict]]:
    """Gaps after the record that follows them, or at the end: they count once a record is known and
    the member has been read. There are at most as many as there are records, and one."""
    gaps = []
    for kind, found in events:
        if kind == "gap":
            gaps.append((kind, found))
        else:
            yield kind, found
    yield from gaps


def read_archives(spark: SparkSession, path: str, with_payload: bool = False, gaps: bool = False) -> DataFrame:
    """Records of all archives under ``path``, or with ``gaps`` the quarantined stretches. An
    archive of at most 64 MB and a record is read at once."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    names = GAP if gaps else RECORD + ", payload binary" * with_payload
    columns = [c.split()[0] for c in names.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        types = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary(),
                 "offset": pa.int64(), "n_bytes": pa.int64(), "inside": pa.int64()}

        def made(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], types.get(c, pa.string())) for c in columns], names=columns)

        for batch in batches:
            for name in batch.column("file").to_pylist():
                files, root = fs.FileSystem.from_uri(path)
                with files.open_input_stream(f"{root}/{name}", compression=None) as f:
                    data = f.read()
                rows, held = [], 0
                for kind, found in salvage(data):
                    if (kind == "gap") == gaps:
                        rows.append(found | {"file": name})
                        held += len(found.get("payload") or b"") * with_payload
                        if not with_payload:
                            found.pop("payload", None)
                            rows[-1].pop("payload", None)
                        if len(rows) == 10_000 or held > 1 << 22:
                            yield made(rows)
                            rows, held = [], 0
                yield made(rows)

    n = max(1, manifest.count())
    return manifest.select("file").repartition(n).mapInArrow(lean(read), names)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    path = scratch(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)
