"""Salvage of archives with planted damage, against what was written byte by byte."""

import gzip
import random

import pytest

from kvadrat.llm import warc
from kvadrat.llm.common import scratch


def one(i, size=300, head=b""):
    payload = (b"page %d " % i) * (size // 7)
    made = warc.record(i, f"http://e.x/{i}", payload, warc.digest_of(payload), None)
    return made.replace(b"WARC-Type", head + b"WARC-Type", 1) if head else made


def found(data):
    events = list(warc.salvage(data))
    return [v["page_id"] for k, v in events if k == "record"], [v for k, v in events if k == "gap"]


def test_many_records_in_one_member():
    whole = gzip.compress(b"".join(one(i) for i in range(40)))
    assert found(whole) == (list(range(40)), [])
    large = gzip.compress(b"".join(one(i, 400_000) for i in range(9)))
    assert found(large + whole)[0] == [*range(9), *range(40)]


def test_gap_inside_a_member():
    parts = [one(0), b"junk " * 7, one(1), one(2)[:-60], one(3), b"end"]
    records, gaps = found(gzip.compress(b"".join(parts)))
    assert records == [0, 1, 3]
    places = [sum(map(len, parts[:k])) for k in range(7)]
    assert [(g["inside"], g["n_bytes"], g["offset"]) for g in gaps] == [
        (places[1], 35, 0), (places[3], len(parts[3]), 0), (places[5], 3, 0)]


def test_cut_member_keeps_the_records_before_the_cut():
    r = random.Random(2)
    parts = [one(i, 70) + b"" for i in range(30)]
    noise = [warc.record(100 + i, "u", p, warc.digest_of(p), None) for i in range(30) for p in [r.randbytes(400)]]
    member = gzip.compress(b"".join(parts[:1] + noise))
    records, gaps = found(member[: len(member) // 2] + gzip.compress(one(7)))
    assert records[0] == 0 and records[-1] == 7 and 10 < len(records) < 25
    assert [(g["offset"], g["n_bytes"], g["reason"]) for g in gaps] == [(0, len(member) // 2, "damaged member")]


@pytest.mark.parametrize("change", [
    lambda d: d.replace(b"sha1:", b"SHA1:"),
    lambda d: b"".join(x for x in d.splitlines(True) if not x.startswith(b"WARC-Payload-Digest")),
    lambda d: d.replace(b"sha1:", b"unknown:"),
])
def test_digest_is_checked_only_where_it_can_be(change):
    data = change(one(5)) + one(6)
    assert found(data) == ([5, 6], []) and found(gzip.compress(data)) == ([5, 6], [])
    rows = [v for k, v in warc.salvage(data) if k == "record"]
    assert rows[0]["payload_digest"] == warc.digest_of((b"page 5 ") * 42) or b"unknown" in data


def test_wrong_digest_is_damage():
    bad = one(5).replace(b"page 5 page", b"page 5 pagE", 1)
    assert found(bad + one(6)) == ([6], [{"offset": 0, "n_bytes": len(bad), "inside": None, "reason": "damaged record"}])


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_every_byte_is_accounted_for(seed, pack):
    """Random damage between and in records: what is not in a whole record is in the log, once. (Heads
    have no checksum of their own, so damage to them alone cannot be seen in a plain archive.)"""
    r = random.Random(seed)
    data, kept = b"", []
    for i in range(60):
        plain = one(i, r.choice([7, 70, 700]))
        part, fate = pack(plain), r.random()
        if fate < 0.15:
            part = part[: r.randrange(12, len(part) - 9)]
        elif fate < 0.3:  # one byte of the payload
            at = len(plain) - r.randrange(5, 11)
            part = pack(plain[:at] + bytes([plain[at] ^ 255]) + plain[at + 1 :])
        elif fate < 0.4:
            part, kept = b"\x00\x01" * r.randrange(1, 40) + part, [*kept, i]
        else:
            kept.append(i)
        data += part
    records, gaps = found(data)
    assert records == kept
    ends = [(g["offset"], g["offset"] + g["n_bytes"]) for g in gaps]
    assert all(a < b for a, b in ends) and all(b < c for (_, b), (c, _) in zip(ends, ends[1:]))
    whole = sum(len(pack(v)) for v in rebuilt(data, ends))
    assert whole + sum(b - a for a, b in ends) == len(data)


def rebuilt(data, gaps):
    """The records that lie between the gaps, unpacked."""
    at = 0
    for a, b in [*gaps, (len(data), len(data))]:
        part = data[at:a]
        at = b
        while part:
            if part[:2] == b"\x1f\x8b":
                import zlib

                unpack = zlib.decompressobj(31)
                yield unpack.decompress(part)
                part = unpack.unused_data
            else:
                head = part.index(b"\r\n\r\n")
                size = int(warc._LENGTH.search(part)[1])
                yield part[: head + 8 + size]
                part = part[head + 8 + size :]


def test_archives_of_pages_match_brute_force(spark):
    r = random.Random(4)
    rows = [(i, f"u{i}", r.choice(["", "same", "é" * 50, f"own {i}", None])) for i in range(300)] + [(7, "again", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    top = {}
    for i, _, html in rows:
        top[html or ""] = max(top.get(html or "", i), i)
    want = sorted((i, len((h or "").encode()), warc.digest_of((h or "").encode()),
                   "response" if top[h or ""] == i else "revisit", None if top[h or ""] == i else top[h or ""]) for i, _, h in rows)
    got = sorted(tuple(x[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for x in warc.round_trip(spark, pages).collect())
    assert got == want
    path = scratch(spark, "archive")
    warc.write_archives(pages, path)
    assert warc.read_archives(spark, path, gaps=True).count() == 0
    texts = {x["page_id"]: x["payload"] for x in warc.read_archives(spark, path, with_payload=True).collect() if x["payload"] is not None}
    assert all(bytes(texts[i]).decode() == h for h, i in top.items())
