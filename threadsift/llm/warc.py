"""WARC archives: one gzip member per record, read sequentially.

Writing. Every page becomes one record. Of pages with equal payloads of at least ``min_revisit``
bytes the one with the smallest page_id is the ``response`` and the others are ``revisit`` records,
which carry the HTTP headers (with the length) and the digest of the payload but not the payload.
The records of one file are complete gzip members, so any tool can read the file from any member on.
The files are written by Spark's own text writer, whose commit protocol survives lost executors and
whose file systems are those of the cluster: a gzip member ends with the record's length in four
little-endian bytes, the last of which is zero up to 16 MiB, and this zero is what the writer puts as
its line separator. A longer record is followed by one zero byte of padding, which readers of gzip skip.

Reading. A file is read front to back in chunks; ``zlib`` inflates them as they come, a record's block
is framed by Content-Length, and payload and block digests are computed on the way and compared with
those in the headers. A damaged member gives a row whose ``error`` says why, and reading goes on at the
next gzip member.

Defined results: NULL html is an empty payload; a NULL url leaves the header out; control characters in
a url are percent-encoded. Rows without page_id get a record id made from their digest, and lose against
any page_id; if no row of equal payloads has one, all of them are responses. Repeated rows with the same
smallest page_id are all responses. An empty table gives an archive without records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 100
_CHUNK = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC = b"\x1f\x8b\x08"

RECORD_SCHEMA = (
    "path string, offset long, record_id string, record_type string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary, error string"
)


def page_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Pages with payload, digest and the page they revisit (NULL for a response).

    First pages are found by a map-side combined aggregate over digests; the join back is keyed by
    digest with the pages on its left, where adaptive execution splits a hot digest.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    long_enough = F.octet_length("payload") >= min_revisit
    firsts = (
        base.filter(long_enough)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1 and first_id is not null")
        .select(F.col("digest").alias("_digest"), "first_id")
    )
    joined = base.join(firsts, (base.digest == firsts._digest) & long_enough, "left")
    revisits = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(revisits, F.col("first_id")).alias("refers_to"))


def record_id(page_id: int | None, digest: str, url: str | None) -> str:
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{digest} {url}')}>"
    return f"<urn:x-page:{page_id}>"


def page_of(record: str | None) -> int | None:
    match = re.fullmatch(r"<urn:x-page:(-?\d+)>", record or "")
    return int(match[1]) if match else None


def member(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest, url)}",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to, digest, url)}", f"WARC-Profile: {_PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    record = "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(record) + packer.flush()


def write_archives(records: DataFrame, path: str, date: str = "2020-01-01T00:00:00Z") -> None:
    """Writes the records, one file per partition: after the join of ``page_records`` adaptive execution sizes
    partitions, so a file holds at most about one advisory partition size of payloads."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for page_id, url, payload, digest, first in zip(*(rows[c] for c in rows.columns), strict=True):
                one = None if pd.isna(page_id) else int(page_id)
                refers = None if pd.isna(first) else int(first)
                out.append(member(one, None if pd.isna(url) else url, payload, digest, refers, date))
            yield pd.DataFrame({"member": out})

    rows = records.select(
        F.col("page_id").cast("string"), "url", F.encode("payload", "utf-8").alias("payload"), "digest",
        F.col("refers_to").cast("string"),
    )
    last_is_zero = F.expr("substring(member, length(member), 1) = x'00'")
    value = F.when(last_is_zero, F.expr("substring(member, 1, length(member) - 1)")).otherwise(F.col("member"))
    packed = rows.mapInPandas(members, "member binary")
    packed.select(value.cast("string").alias("value")).write.option("lineSep", "\0").text(path)


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    http: dict[str, str]
    payload_bytes: int
    payload_digest: str
    payload: bytes | None
    error: str | None


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines if b":" in line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class _Member:
    """Inflates one gzip member chunk by chunk and hands out its bytes."""

    def __init__(self, data: memoryview, at: int):
        self.data, self.at, self.inflate, self.ready = data, at, zlib.decompressobj(31), b""

    def more(self) -> bool:
        while not self.inflate.eof and self.at < len(self.data):
            chunk = self.data[self.at : self.at + _CHUNK]
            self.at += len(chunk)
            got = self.inflate.decompress(chunk)
            if self.inflate.eof:
                self.at -= len(self.inflate.unused_data)
            if got:
                self.ready += got
                return True
        return False

    def until(self, end: bytes) -> bytes:
        seen = 0
        while (found := self.ready.find(end, max(0, seen - len(end)))) < 0:
            seen = len(self.ready)
            if not self.more():
                raise ValueError("the record ends inside its header")
        got, self.ready = self.ready[:found], self.ready[found + len(end) :]
        return got

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.ready and not self.more():
                raise ValueError(f"the block lacks {n} bytes of its Content-Length")
            got, self.ready = self.ready[:n], self.ready[n:]
            n -= len(got)
            yield got

    def rest(self) -> bytes:
        while self.more():
            pass
        return self.ready


def _read_record(source: _Member, offset: int, keep_payload: bool) -> Record:
    lines = source.until(b"\r\n\r\n").split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("no WARC version line")
    headers = _fields(lines[1:])
    length = int(headers["content-length"])
    block, payload, http_head, kept, size = hashlib.sha256(), hashlib.sha256(), b"", [], 0
    is_http = headers.get("content-type", "").startswith("application/http")
    in_head = is_http
    for chunk in source.take(length):
        block.update(chunk)
        if in_head:
            http_head += chunk
            head, found, chunk = http_head.partition(b"\r\n\r\n")
            if not found:
                continue
            http_head, in_head = head, False
        payload.update(chunk)
        size += len(chunk)
        if keep_payload:
            kept.append(chunk)
    trailer = source.rest()
    http = _fields(http_head.split(b"\r\n")[1:]) if is_http else {}
    digest, error = payload.hexdigest(), None
    if trailer != b"\r\n\r\n":
        error = "the record does not end after its Content-Length"
    elif headers.get("warc-block-digest", f"sha256:{block.hexdigest()}") != f"sha256:{block.hexdigest()}":
        error = "block digest differs"
    stated = headers.get("warc-payload-digest")
    if headers.get("warc-type") == "revisit":
        digest, size = (stated or "").removeprefix("sha256:"), int(http.get("content-length", 0))
    elif not error and stated and stated != f"sha256:{digest}":
        error = "payload digest differs"
    return Record(offset, headers, http, size, digest, b"".join(kept) if keep_payload else None, error)


def records_of(data: bytes | memoryview, keep_payload: bool = False) -> Iterator[Record]:
    """The records of one archive, front to back."""
    view, at = memoryview(data), 0
    while at < len(view):
        if view[at] == 0:  # padding between members
            at += 1
            continue
        source = _Member(view, at)
        try:
            yield _read_record(source, at, keep_payload)
            at = source.at
        except (zlib.error, ValueError, KeyError) as problem:
            yield Record(at, {}, {}, 0, "", None, f"{type(problem).__name__}: {problem}")
            following = bytes(view[at + 1 :]).find(_MAGIC)
            at = len(view) if following < 0 else at + 1 + following


def read_archives(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """One row per record of the archives at ``path``. A file is one row of Spark's binaryFile source,
    so it may not exceed 2 GB; ``write_archives`` stays near the advisory partition size."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for name, content in zip(files["path"], files["content"], strict=True):
                out = []
                for r in records_of(content, keep_payload):
                    h = r.headers
                    out.append((name, r.offset, h.get("warc-record-id"), h.get("warc-type"), h.get("warc-target-uri"),
                                h.get("warc-refers-to"), r.payload_bytes, r.payload_digest, r.payload, r.error))
                    if len(out) == 2000:
                        yield pd.DataFrame(out, columns=names)
                        out = []
                yield pd.DataFrame(out, columns=names)

    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(rows, RECORD_SCHEMA)
