"""Web archives in ZIP packages: WARC records and their index as stored members, read by range.

A package holds `archive/data.warc.gz` (one gzip member per record) and `indexes/index.cdx` (one
line per record: place, length), both stored. The reader finds the end of the central directory
(ZIP64 too), parses its entries, turns a stored member into a byte range of the package, and reads
single records through the index; nothing is extracted.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, open_read, open_write, sliced, staged

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
LEAST = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fixed values of the ZIP format: signatures, the largest tail that may hold the end record, and the ZIP64 field's tag.
EOCD, EOCD64, LOCATOR64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
TAIL, TAG64 = 65_557, 1


def record(page_id, url, payload: bytes, digest: str, first, revisit: bool, date: str) -> bytes:
    """One WARC record as a gzip member. A revisit keeps the HTTP header, with the payload's length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Profile: {PROFILE}"]
    block = http if revisit else http + payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(5, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + z.flush()


def package(records: list[bytes], zip64: bool = False) -> bytes:
    lines, at = [], 0
    for r in records:
        lines.append(f"{at} {len(r)}\n")
        at += len(r)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        for name, data in ((DATA, b"".join(records)), (INDEX, "".join(lines).encode())):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as f:
                f.write(data)
    return out.getvalue()


class ZipArchive:
    """The members of a ZIP file by name: (place of the local header, stored size, size, method)."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, 2) if not hasattr(file, "size") else file.size()
        file.seek(max(0, size - TAIL))
        tail = file.read(TAIL)
        at = tail.rfind(EOCD)
        if at < 0:
            raise ValueError("no end of a central directory")
        n, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
        if n == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
            place = tail.rfind(LOCATOR64, 0, at)
            if place < 0:
                raise ValueError("no ZIP64 locator")
            (end64,) = struct.unpack("<Q", tail[place + 8 : place + 16])
            file.seek(end64)
            end = file.read(56)
            if end[:4] != EOCD64:
                raise ValueError("no ZIP64 end of a central directory")
            n, length, start = struct.unpack("<QQQ", end[32:56])
        file.seek(start)
        directory = file.read(length)
        self.members: dict[str, tuple[int, int, int, int]] = {}
        i = 0
        for _ in range(n):
            if directory[i : i + 4] != CENTRAL:
                raise ValueError("a broken central directory")
            (method,) = struct.unpack("<H", directory[i + 10 : i + 12])
            stored, full, names, extras, notes = struct.unpack("<IIHHH", directory[i + 20 : i + 34])
            (local,) = struct.unpack("<I", directory[i + 42 : i + 46])
            name = directory[i + 46 : i + 46 + names].decode()
            extra = directory[i + 46 + names : i + 46 + names + extras]
            while len(extra) >= 4:
                tag, size_of = struct.unpack("<HH", extra[:4])
                if tag == TAG64:
                    wide = iter(struct.unpack(f"<{size_of // 8}Q", extra[4 : 4 + size_of // 8 * 8]))
                    full = next(wide) if full == 0xFFFFFFFF else full
                    stored = next(wide) if stored == 0xFFFFFFFF else stored
                    local = next(wide) if local == 0xFFFFFFFF else local
                extra = extra[4 + size_of :]
            self.members[name] = (local, stored, full, method)
            i += 46 + names + extras + notes

    def stored(self, name: str) -> tuple[int, int]:
        """Place and length in the package of a stored member's bytes."""
        local, size, _, method = self.members[name]
        if method:
            raise ValueError(f"{name} is not stored")
        self.file.seek(local)
        head = self.file.read(30)
        if head[:4] != LOCAL:
            raise ValueError(f"{name} has no local header")
        names, extras = struct.unpack("<HH", head[26:30])
        return local + 30 + names + extras, size

    def read(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        return self.file.read(length)


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, rest[: int(fields["content-length"])]


def read_records(uri: str) -> Iterator[dict]:
    """What a package holds, record by record."""
    file = open_read(uri)
    z = ZipArchive(file)
    base, _ = z.stored(DATA)
    lines = z.read(*z.stored(INDEX)).decode().splitlines()
    number = lambda s: int(s[10:-1]) if len(s) > 11 else None  # noqa: E731  <urn:page:7>
    for line in lines:
        start, length = map(int, line.split())
        fields, block = parsed(z.read(base + start, length))
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        revisit = fields["warc-type"] == "revisit"
        size = int(re.search(rb"(?i)content-length: (\d+)", http)[1])
        if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"a damaged record in {uri} at {start}")
        yield {
            "page_id": number(fields["warc-record-id"]), "payload_bytes": size, "payload_digest": digest, "record_type": fields["warc-type"],
            "refers_to": number(fields["warc-refers-to"]) if revisit else None, "url": fields.get("warc-target-uri"), "payload": None if revisit else payload,
        }
    file.close()


def write_archives(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None, archive_mb: int = 24, least: int = LEAST,
    date: str = "1970-01-01T00:00:00Z", zip64: bool = False,
) -> DataFrame:
    """Write a record per row into packages of about `archive_mb` MB; their manifest (uri, records).

    Of rows with equal payloads of at least `least` bytes those with the smallest page_id are
    responses (each, if several rows have that id) and the others revisits of it; all smaller payloads are
    responses. Null html: an empty payload. Payloads of any length are written and read whole. Null url: a record without target. Rows without page_id are responses only where their
    payload has no row with one. No rows: no packages.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "archives")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    shared = rows.filter(F.octet_length("html") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    shared = staged(shared.filter("n > 1").select("digest", "first"), "payloads")  # a table of known size: Spark broadcasts it only if that is small
    rows = rows.join(shared, "digest", "left").select("page_id", "url", "html", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size, number = 0, 0

        def flush() -> pa.RecordBatch:
            uri = f"{folder}/{TaskContext.get().partitionId():06d}-{number:04d}-{uuid.uuid4().hex[:8]}.zip"
            with open_write(uri) as f:
                f.write(package(held, zip64))
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(held)], pa.int64())], ["uri", "records"])

        for b in sliced(batches):
            for i, u, h, d, first in zip(*(c.to_pylist() for c in b.columns)):
                revisit = first is not None and first != i
                held.append(record(i, u, h.encode(), d, first, revisit, date))
                size += len(held[-1])
                if size >= archive_mb << 20:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return staged(rows.mapInArrow(run, "uri string, records long"), "archive-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the packages in the manifest, one package per task."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"] + ["payload"] * with_payload
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * with_payload

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for uri in b["uri"]:
                rows: list[dict] = []
                for r in read_records(uri):
                    rows.append(r)
                    if len(rows) == 2000:
                        yield frame(rows, names)
                        rows = []
                if rows:
                    yield frame(rows, names)

    return manifest.select("uri").repartition(max(1, manifest.count())).mapInPandas(run, schema)


def frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    out = {k: [r[k] for r in rows] for k in names}
    for k in ("page_id", "refers_to"):
        out[k] = pd.array(out[k], "Int64")
    return pd.DataFrame(out)
