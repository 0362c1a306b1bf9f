"""WARC archive: record types and digests against plain Python, exact bytes, payloads stored once, odd rows."""

import base64
import hashlib

import pytest

from contentspark.llm import warc_archive as op

SCHEMA = "page_id long, url string, html string, type string, digest int, payload string"
ROWS = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, "http://c/\r\nX: y", "<p>x</p>"), (4, None, None), (5, "u", ""),
        (6, "é", "漢字\r\n\r\nWARC/1.1\r\n"), (None, "n", "only"), (None, "n", "<p>x</p>"), (7, "r", "same"), (7, "r", "same"),
        (8, "long", "z" * 300_000), (9, "crlf", "\r\n\r\n"), (10, "", "null\x00byte"), (None, "m", "twice"), (None, "m", "twice")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA)


def plain(rows, least=0):
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "") == (html or "")]
        last = max((j for j in ids if j is not None), default=None)
        response = i == last or len(raw) < least
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if response else "revisit",
                    None if response else last))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows, least", [(ROWS, 0), (ROWS, 5), ([(i, "u", f"page {i % 3}") for i in range(200)], 0), ([], 0)])
def test_round_trip(spark, rows, least):
    got = op.read_records(op.write_archive(frame(spark, rows), least)).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == plain(rows, least)
    assert all(r.verified for r in got)


def test_payloads_are_stored_once_and_records_are_exact(spark):
    archive = op.write_archive(frame(spark, ROWS))
    stored = archive.payloads.collect()
    assert sorted(bytes(r.payload) for r in stored) == sorted({(h or "").encode() for *_, h in ROWS})
    assert all(hashlib.sha256(r.payload).digest() == r.digest for r in stored)
    records = {}
    for r in op.reconstruct(archive).collect():
        headers, payload = op.parse_record(bytes(r.record))
        records[headers["WARC-Record-ID"], headers["WARC-Type"]] = headers, payload, bytes(r.record)
    headers, payload, raw = records["<urn:page:3>", "response"]
    assert headers["WARC-Target-URI"] == "http://c/%0D%0AX: y" and payload == b"<p>x</p>"
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(b"\r\n\r\n<p>x</p>\r\n\r\n")
    headers, payload, _ = records["<urn:page:1>", "revisit"]
    assert headers["WARC-Refers-To"] == "<urn:page:3>" and payload == b"" and "WARC-Profile" in headers


def test_damage_is_noticed(spark):
    archive = op.write_archive(frame(spark, ROWS[:3]))
    broken = archive._replace(payloads=spark.createDataFrame(
        [(r.digest, b"<p>y</p>") for r in archive.payloads.collect()], archive.payloads.schema))
    assert not any(r.verified for r in op.read_records(broken).collect())
    with pytest.raises(ValueError):
        op.parse_record(b"WARC/1.1\r\nContent-Length: 9\r\nWARC-Record-ID: <x>\r\n\r\nshort\r\n\r\n")
    with pytest.raises(ValueError):
        op.parse_record(b"HTTP/1.1 200 OK\r\n\r\n")
