"""WARC archives: one gzip member per record, written and read back by tasks.

Writing: pages with equal payloads (by SHA-256) are one group; its page with the
largest page_id is written as response, the others as revisits that refer to it.
Tasks write archives of about ``archive_bytes`` into the shared folder under
names that no other attempt uses, and only a task that ends reports its names.

Reading: each archive is read sequentially in chunks; a zlib decompressor per
gzip member gives a record's header, its content-length frames the block, and
block and payload digests are verified as the bytes come.

Defined cases: a null html is an empty payload; payloads of fewer than
``min_bytes`` bytes are all responses; a null page_id never becomes the response
of a group that has other ids, and rows that repeat the largest page_id of their
group are all responses; a null url gives a record without target; extra columns
are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import materialise
from corvid.session import scratch_path

ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"  # records are reproducible
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
NAME = "urn:x-page:"


def digest(*parts: bytes) -> str:
    h = hashlib.sha1()
    for p in parts:
        h.update(p)
    return base64.b32encode(h.digest()).decode()


def filesystem(uri: str):
    """(file system, path) of a Hadoop-style URI."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    block = HTTP if refers_to is not None else HTTP + payload
    name = f"{NAME}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest(payload))}"
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<{NAME}{refers_to}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("X-Payload-Length", str(len(payload)))]
    head += [("WARC-Payload-Digest", "sha1:" + digest(payload)), ("WARC-Block-Digest", "sha1:" + digest(block)),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    raw = ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(raw) + gz.flush()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    offset: int

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]


class BadRecord(ValueError):
    """A record whose framing or digest is wrong."""


class _Member:
    """Bytes of one gzip member, decompressed as they are asked for."""

    def __init__(self, reader: "WarcReader"):
        self.reader, self.z, self.ready = reader, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        if self.z.eof:
            return False
        data = self.z.unconsumed_tail or self.reader.raw()
        if not data:
            raise BadRecord(f"archive ends inside the record at {self.reader.start}")
        self.ready += self.z.decompress(data, CHUNK)
        if self.z.eof:
            self.reader.push_back(self.z.unused_data)
        return True

    def line(self) -> bytes:
        while (at := self.ready.find(b"\r\n")) < 0:
            if not self.more():
                raise BadRecord(f"no line end in the record at {self.reader.start}")
        out = bytes(self.ready[:at])
        del self.ready[:at + 2]
        return out

    def exactly(self, n: int, see) -> bytes:
        parts, left = [], n
        while left:
            if not self.ready and not self.more():
                raise BadRecord(f"record at {self.reader.start} is shorter than its content-length")
            part = bytes(self.ready[:left])
            del self.ready[:left]
            see(part)
            parts.append(part)
            left -= len(part)
        return b"".join(parts)


class WarcReader:
    """Records of an archive, one after the other."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.held, self.at, self.start = stream, b"", 0, 0

    def raw(self) -> bytes:
        data, self.held = self.held or self.stream.read(CHUNK), b""
        self.at += len(data)
        return data

    def push_back(self, data: bytes) -> None:
        self.held = data
        self.at -= len(data)

    def __iter__(self) -> Iterator[Record]:
        while True:
            if not self.held:
                self.push_back(self.raw())
            if not self.held:
                return
            self.start = self.at
            yield self.record(_Member(self))

    def record(self, m: _Member) -> Record:
        if not m.line().startswith(b"WARC/1."):
            raise BadRecord(f"no WARC version at {self.start}")
        headers = {}
        while line := m.line():
            k, _, v = line.decode("utf-8").partition(":")
            headers[k.strip().lower()] = v.strip()
        h = hashlib.sha1()
        block = m.exactly(int(headers["content-length"]), h.update)
        if m.exactly(4, lambda _: None) != b"\r\n\r\n" or m.ready or m.more() and m.ready:
            raise BadRecord(f"record at {self.start} does not end with its block")
        while m.more():
            if m.ready:
                raise BadRecord(f"bytes after the block at {self.start}")
        rec = Record(headers, block, self.start)
        want = headers.get("warc-block-digest")
        if want and want != "sha1:" + base64.b32encode(h.digest()).decode():
            raise BadRecord(f"block digest of the record at {self.start} is wrong")
        if headers["warc-type"] == "response" and headers.get("warc-payload-digest") != "sha1:" + digest(rec.payload):
            raise BadRecord(f"payload digest of the record at {self.start} is wrong")
        return rec


def mark_revisits(pages: DataFrame, page_id: str, html: str, min_bytes: int) -> DataFrame:
    """Adds ``__to``: the page whose payload this one repeats, or null."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    d = pages.withColumn("__d", F.sha2(payload, 256))
    groups = (d.where(F.octet_length(payload) >= min_bytes).groupBy("__d")
              .agg(F.max(page_id).alias("__max"), F.count("*").alias("__n"))
              .where("__n > 1").select(F.col("__d").alias("__g"), "__max"))
    j = d.join(groups, d["__d"] == groups["__g"], "left")
    return j.withColumn("__to", F.when(~F.col(page_id).eqNullSafe(F.col("__max")), F.col("__max"))).drop("__d", "__g", "__max")


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``(path, n_records)``: the archives written."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        out, path, size, n = None, None, 0, 0
        for b in batches:
            for i, u, t, to in zip(b["i"], b["u"], b["t"], b["to"]):
                if out is None:
                    path, size, n = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                rec = record_bytes(None if pd.isna(i) else int(i), u, (t or "").encode(), None if pd.isna(to) else int(to))
                out.write(rec)
                size, n = size + len(rec), n + 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [path], "n_records": [n]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [path], "n_records": [n]})

    d = mark_revisits(pages.select(F.col(page_id).alias("i"), F.col(url).alias("u"), F.col(html).alias("t")), "i", "t", min_bytes)
    # ids go as text: a pandas column of longs with nulls would become doubles
    d = d.select(F.col("i").cast("string"), "u", "t", F.col("__to").cast("string").alias("to"))
    return materialise(d.mapInPandas(write, "path string, n_records long"), "warc-paths")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Records of the archives: ``(page_id, url, record_type, refers_to,
    payload_bytes, payload_digest, payload)``; payload is null for a revisit."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = filesystem(folder)
        for b in batches:
            for path in b["path"]:
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for r in WarcReader(stream):
                        h, full = r.headers, r.headers["warc-type"] == "response"
                        rows.append((_page(h["warc-record-id"]), h.get("warc-target-uri"), h["warc-type"],
                                     _page(h.get("warc-refers-to")), len(r.payload) if full else int(h["x-payload-length"]),
                                     h["warc-payload-digest"].removeprefix("sha1:"), r.payload if full else None))
                        size += len(r.block)
                        if size > 4 * CHUNK:
                            yield _frame(rows)
                            rows, size = [], 0
                yield _frame(rows)

    n = max(1, archives.count())
    spread = archives.repartition(min(n, 10_000), "path")
    got = spread.mapInPandas(read, "page_id string, url string, record_type string, refers_to string, "
                                   "payload_bytes long, payload_digest string, payload binary")
    return got.withColumn("page_id", F.col("page_id").cast("long")).withColumn("refers_to", F.col("refers_to").cast("long"))


def _page(name: str | None) -> str | None:
    return name[len(NAME) + 1:-1] if name and name.startswith("<" + NAME) else None


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write all pages, read the archives back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, page_id, url, html, min_bytes), folder)
