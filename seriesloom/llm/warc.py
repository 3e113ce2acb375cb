"""WARC records in ZIP packages, written and read back by byte ranges.

A package holds two stored members: `archive/data.warc.gz`, one gzip member per record, and
`indexes/index.cdxj`, a line per record with its offset and length in the archive. The
reader takes the end of the file, follows the (ZIP64) end records to the central directory,
finds where the members' bytes lie, range-reads the index and then the records. Nothing is
extracted. Files are reached through pyarrow's file systems, so that the shared folder can
be in any store they know.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.base import cut_lineage, ensure_checkpoint_dir, pieces, register, table

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Payload bytes after which a package is closed.
PACKAGE_BYTES = 32 << 20
#: Adjacent records fetched by one range read.
READ_BYTES = 4 << 20


class Member(NamedTuple):
    name: str
    method: int
    crc: int
    size: int
    stored_size: int
    header: int


# ------------------------------------------------------------------ ZIP directories


def _zip64_fields(extra: bytes, values: list[int]) -> list[int]:
    """Replace the values that are all ones by those of the ZIP64 extra field, in order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            body, k = extra[at + 4 : at + 4 + size], 0
            for i, v in enumerate(values):
                if v == 0xFFFFFFFF and k + 8 <= len(body):
                    values[i] = struct.unpack_from("<Q", body, k)[0]
                    k += 8
        at += 4 + size
    return values


def central_directory(f: BinaryIO, size: int) -> list[Member]:
    """Members of a ZIP file from its central directory, ZIP64 or not."""
    tail_size = min(size, 22 + 65535 + 20)
    f.seek(size - tail_size)
    tail = f.read(tail_size)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":
        (at,) = struct.unpack_from("<Q", tail, end - 12)
        f.seek(at)
        record = f.read(56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("ZIP64 end record is missing")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    f.seek(start)
    raw, at, out = f.read(length), 0, []
    for _ in range(count):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("central directory is damaged")
        method, _, _, crc, stored, full, n, m, k = struct.unpack_from("<HHHIIIHHH", raw, at + 10)
        (header,) = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46 : at + 46 + n].decode()
        extra = raw[at + 46 + n : at + 46 + n + m]
        full, stored, header = _zip64_fields(extra, [full, stored, header])
        out.append(Member(name, method, crc, full, stored, header))
        at += 46 + n + m + k
    return out


def data_offset(f: BinaryIO, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method:
        raise ValueError(f"{member.name} is compressed; records can't be read by range")
    f.seek(member.header)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("local header is missing")
    n, m = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n + m


# ------------------------------------------------------------------ records


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    """A gzip member with one WARC/1.1 record; a revisit carries no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Date": "2024-01-01T00:00:00Z",
        "WARC-Payload-Digest": "sha1:" + digest_of(payload),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        head["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return gzip.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def parse_record(member: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP head and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


# ------------------------------------------------------------------ packages


def _open(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root) if ":" in root.split("/", 1)[0] else (fs.LocalFileSystem(), root)


class PackageWriter:
    """Streams records into one package after the other; names are unique per attempt."""

    def __init__(self, root: str, package_bytes: int = PACKAGE_BYTES):
        self.files, self.folder = _open(root)
        self.limit, self.out, self.done = package_bytes, None, []

    def add(self, page_id, url, payload: bytes, refers_to, revisit: bool) -> None:
        if self.out is None:
            self.path = f"{self.folder}/{uuid.uuid4().hex}.wacz"
            self.out = self.files.open_output_stream(self.path)
            self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
            self.member = self.zip.open(ARCHIVE, "w", force_zip64=True)
            self.lines, self.at, self.taken = [], 0, 0
        record = make_record(page_id, url, payload, refers_to, revisit)
        self.member.write(record)
        self.lines.append(json.dumps({"offset": self.at, "length": len(record)}))
        self.at += len(record)
        self.taken += len(payload) + 200
        if self.taken >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.member.close()
        self.zip.writestr(INDEX, "\n".join(self.lines) + "\n")
        self.zip.close()
        self.out.close()
        self.done.append((self.path, len(self.lines)))
        self.out = None


def read_package(f: BinaryIO, size: int) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """All records of a package through its index; adjacent ones share a range read."""
    members = {m.name: m for m in central_directory(f, size)}
    index = members[INDEX]
    f.seek(data_offset(f, index))
    raw = f.read(index.stored_size)
    if zlib.crc32(raw) != index.crc:
        raise ValueError("the index is damaged")
    base = data_offset(f, members[ARCHIVE])
    spans = [(x["offset"], x["length"]) for x in map(json.loads, raw.splitlines())]
    i = 0
    while i < len(spans):
        j, start = i + 1, spans[i][0]
        while j < len(spans) and spans[j][0] + spans[j][1] - start <= READ_BYTES:
            j += 1
        f.seek(base + start)
        data = f.read(spans[j - 1][0] + spans[j - 1][1] - start)
        for offset, length in spans[i:j]:
            yield parse_record(data[offset - start : offset - start + length])
        i = j


# ------------------------------------------------------------------ Spark


def write_packages(pages: DataFrame, root: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write every row as a record; returns path, n_records of the packages that count.

    `pages`: page_id long, url string, html string (null: empty payload). Of equal payloads
    the largest page_id is the response and the others revisit it; rows that repeat it (or
    whose page_id is null where all are) are responses too. Other columns are ignored. Tasks
    name their files anew on each attempt; only the packages listed in the result are read,
    so a lost or repeated task leaves no record twice. An empty table writes no package.
    """
    body = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    keyed = pages.select("page_id", body.alias("__sha"))
    last = (
        keyed.groupBy("__sha")
        .agg(F.max("page_id").alias("__response"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .drop("__n")
    )
    # Narrow rows meet on the digest (Spark splits a hot one); pages only on their own id.
    revisits = (
        keyed.join(last, "__sha")
        .where(~F.col("page_id").eqNullSafe(F.col("__response")))
        .distinct()
        .select(F.col("page_id").alias("__id"), F.col("__sha").alias("__s"), "__response")
    )
    rows = pages.select("page_id", "url", "html", body.alias("__sha")).join(
        revisits,
        F.col("page_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__s")),
        "left",
    ).select("page_id", "url", "html", F.col("__s").isNotNull().alias("revisit"), F.col("__response").alias("refers_to"))
    files, folder = _open(root)
    files.create_dir(folder, recursive=True)

    def write(batches):
        writer = PackageWriter(root, package_bytes)
        for batch in pieces(batches, "html"):
            for page_id, url, html, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                writer.add(page_id, url, (html or "").encode(), refers_to, revisit)
        writer.close()
        if writer.done:
            yield pa.RecordBatch.from_pydict(
                {"path": [p for p, _ in writer.done], "n_records": [n for _, n in writer.done]},
                pa.schema([("path", pa.string()), ("n_records", pa.int64())]),
            )

    return cut_lineage(rows.mapInArrow(write, "path string, n_records long"))


def read_records(packages: DataFrame, root: str) -> DataFrame:
    """One row per record of the listed packages; responses are checked against their digest."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    arrow = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def number(urn: str | None) -> int | None:
        text = (urn or "").rpartition(":")[2].rstrip(">")
        return None if text in ("", "None") else int(text)

    def row(headers, http, payload) -> tuple:
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = headers["WARC-Type"]
        if kind == "response" and digest_of(payload) != digest:
            raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its digest")
        length = int(http.rpartition(b"Content-Length: ")[2])
        return (number(headers["WARC-Record-ID"]), length, digest, kind, number(headers.get("WARC-Refers-To")))

    def read(batches):
        files, _ = _open(root)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with files.open_input_file(path) as f:
                    rows = [row(*x) for x in read_package(f, f.size())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow
                )

    return packages.mapInArrow(read, schema)


@register(
    "op8_warc",
    """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
         h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS x FROM p),
         m AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS top FROM h),
         d AS (SELECT *, list_transform(range(0, 40), lambda i: strpos('0123456789abcdef', substr(x, i + 1, 1)) - 1) AS v FROM m)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + CAST(((v[(5 * i) // 4 + 1] * 16 + coalesce(v[(5 * i) // 4 + 2], 0)) >> (3 - (5 * i) % 4)) & 31 AS INT), 1)), '') AS payload_digest,
           CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
    FROM d
    """,
)
def op8_warc(spark, sf_dir):
    """A record for every page, written to packages in the shared folder and read back."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    packages = write_packages(table(spark, sf_dir, "pages"), root)
    return read_records(packages, root)
