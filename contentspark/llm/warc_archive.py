"""Content-addressed WARC archive: payloads once by digest, exact record heads apart, records by joins.

Writing: every page becomes a WARC record. Its payload (the html in UTF-8) is addressed by
SHA-256. Of the pages with one payload the largest page_id is a ``response`` record, the
others are ``revisit`` records that refer to it; so is it for payloads of at least
``min_revisit_bytes`` bytes, while smaller ones are all responses. Two Parquet tables in the
shared folder make the archive:

* ``payloads`` (digest, payload): each payload once. Payloads that only one page has go
  straight from the scan; the others are grouped by digest *and bytes*, after a partial
  grouping in each task. Reading refuses a digest that stands for different bytes.
* ``heads`` (digest, has_payload, head): each record's exact bytes up to its payload (WARC
  header, blank line, HTTP header, blank line).

Reading: ``reconstruct`` joins heads with payloads and gives each record's bytes; ``read_records``
parses those bytes and takes SHA-1 and length of the payload it finds in them, checks them
against the record's headers, and gives revisits the values of the response they refer to.

Defined results: null html is the empty payload. Null page_ids: a page without id is a
response only where no page with its payload has one. Rows that repeat page_id and html are
records of their own and share the type. Line ends in urls are percent-encoded in headers;
a null url has no target header. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentspark.llm.common import by_key, materialize, small_batches

MIN_REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"  # pages have no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


class Archive(NamedTuple):
    heads: DataFrame
    payloads: DataFrame


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: eight times five hex digits are four letters."""
    code = F.sha1(payload)
    letters = []
    for i in range(8):
        number = F.conv(F.substring(code, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(number, s).bitwiseAND(F.lit(31)) + F.lit(1), F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _head(url: Column, min_bytes: int) -> Column:
    """The bytes of a record before its payload, as text."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.col("type") == "revisit"
    http = len(HTTP_HEAD)
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("type")), line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)), F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", _record_id(F.col("response_id")))))
        .otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (http + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string")),
        F.lit("\r\n" + HTTP_HEAD))


def write_archive(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> Archive:
    """Writes both tables of the archive of pages (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    addressed = pages.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    rows = materialize(addressed.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"),
                                        base32_sha1(F.col("payload")).alias("sha1")), "warc-rows")
    owners = materialize(rows.groupBy("digest").agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")), "warc-owners")

    shared = materialize(owners.where("n > 1").select("digest"), "warc-shared")
    keys = by_key(shared)
    stored = addressed.select("digest", "payload")
    once = stored.join(keys, "digest", "left_anti")
    several = stored.join(keys, "digest", "left_semi").groupBy("digest", "payload").agg(F.count("*").alias("n")).drop("n")
    payloads = materialize(once.unionByName(several), "warc-payloads")

    typed = rows.join(owners, "digest").withColumn("type", F.when(
        (F.col("bytes") < min_revisit_bytes) | F.col("page_id").eqNullSafe(F.col("response_id")), "response").otherwise("revisit"))
    heads = materialize(typed.select("digest", (F.col("type") == "response").alias("has_payload"),
                                     F.encode(_head(F.col("url"), min_revisit_bytes), "UTF-8").alias("head")), "warc-heads")
    return Archive(heads, payloads)


def reconstruct(archive: Archive) -> DataFrame:
    """(digest, record): the exact bytes of every record of the archive."""
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    full = archive.heads.where("has_payload").join(archive.payloads, "digest").select(
        "digest", F.concat("head", "payload", end).alias("record"))
    bare = archive.heads.where("not has_payload").select("digest", F.concat("head", end).alias("record"))
    return full.unionByName(bare)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers of a WARC record and its payload: the block behind the HTTP header."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(headers["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"wrong length of record {headers['WARC-Record-ID']}")
    return headers, block.partition(b"\r\n\r\n")[2]


PARSED = "page_id bigint, type string, declared string, target bigint, bytes bigint, sha1 string, intact boolean"


def _page(uri: str | None) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">") if uri else "none"
    return None if number == "none" else int(number)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for digest, record in zip(batch["digest"], batch["record"]):
            headers, payload = parse_record(record.as_py())
            declared = headers["WARC-Payload-Digest"].removeprefix("sha1:")
            found = response = headers["WARC-Type"] == "response"
            sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode() if response else None
            if response:
                found = sha1 == declared and hashlib.sha256(payload).digest() == digest.as_py()
            out.append((_page(headers["WARC-Record-ID"]), headers["WARC-Type"], declared, _page(headers.get("WARC-Refers-To")),
                        len(payload) if response else None, sha1, found))
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        names = [x.split()[0] for x in PARSED.split(", ")]
        yield pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)


def read_records(archive: Archive) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, verified.

    ``verified``: the payload in the record (for revisits: in the response that has the
    declared digest) has the digests that the headers and the store claim.
    """
    small_batches(archive.heads.sparkSession)
    parsed = materialize(reconstruct(archive).mapInArrow(_parse, PARSED), "warc-parsed")
    responses = parsed.where("type = 'response'")
    by_digest = responses.groupBy(F.col("declared").alias("d")).agg(
        F.min("bytes").alias("b"), F.min("sha1").alias("s"), F.min("intact").alias("ok"))
    revisits = parsed.where("type = 'revisit'").join(by_digest, F.col("declared") == F.col("d"), "left")
    return responses.select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
        F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), F.col("intact").alias("verified")
    ).unionByName(revisits.select(
        "page_id", F.col("b").alias("payload_bytes"), F.col("s").alias("payload_digest"), F.col("type").alias("record_type"),
        F.col("target").alias("refers_to"), F.coalesce("ok", F.lit(False)).alias("verified")))
