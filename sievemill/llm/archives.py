"""WARC records in ZIP packages, written and read by ranges.

A package is a ZIP file with two stored members: ``archive/data.warc.gz``, records compressed each for itself, and
``indexes/index.cdxj``, a line with offset and length of each record. The reader parses the end record, the ZIP64 locator and
directory and the central directory itself, finds the stored members, reads the index by range and then each record by range:
nothing is extracted.

Writing goes partition by partition to a shared folder. The driver completes its path by the cluster's own file system before
executors see it, so a path without a scheme is no executor's local disk; executors reach the folder by pyarrow's file systems
(local or mounted, HDFS, S3, Google, Azure), and any other scheme is an error before the first record. Every attempt writes a file
of its own name and the rows returned name the files, so files of lost or repeated attempts are never read. Packages roll over at
``ROLL`` bytes.

Of records with equal payloads the one with the largest page id is the response, the others are revisits of it. Digests are
computed first and aggregated to the groups of more than one page; only those meet the pages, by a join whose large side adaptive
execution can split where one payload is frequent.

Defined results: a null html is the empty payload; a null url is empty; a page with a null id is a response of its own, with a
null ``page_id``; rows that repeat the largest id of a payload are all responses; very long payloads are held one at a time;
an empty table gives no packages and no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_path, only, written

LEAST_REVISIT = 0
ROLL = 1 << 30
LEVEL = 1
#: Records that one reading task takes from an index at a time.
SPLIT = 512

# Signatures and sizes of the ZIP format, and the profile of revisits.
LOCAL, CENTRAL, END, END64, LOCATOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF


# Other names that Hadoop has for file systems.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI with scheme, by the cluster's default file system where it has none; one that executors can't open is an
    error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    scheme, rest = uri.split(":", 1)
    uri = f"{SCHEMES.get(scheme, scheme)}:{rest}"
    uri = uri if scheme != "file" else f"file:///{rest.lstrip('/')}"
    filesystem(uri)
    return uri


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a URI."""
    return fs.FileSystem.from_uri(uri)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response, or a revisit with the same HTTP head and no payload, as one gzip member."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    name = f"urn:x-page:{page_id}" if page_id is not None else uuid.uuid4().urn
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{name}>",
        "WARC-Date: 2020-01-01T00:00:00Z",
        f"WARC-Target-URI: {url.replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    squeeze = zlib.compressobj(LEVEL, wbits=31)
    return squeeze.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def parse_record(packed: bytes) -> dict:
    """Headers of a record, its HTTP headers and its payload."""
    raw = zlib.decompress(packed, wbits=31)
    end = raw.index(b"\r\n\r\n")
    version, *lines = raw[:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    block = raw[end + 4 : end + 4 + int(headers["Content-Length"])]
    cut = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:cut].decode().split("\r\n")[1:])
    return {"headers": headers, "http": http, "payload": block[cut + 4 :]}


# ---- ZIP packages


class PackageWriter:
    """A ZIP file of stored members, written front to back; sizes and offsets beyond 32 bits go to ZIP64 fields."""

    def __init__(self, out):
        self.out, self.at, self.entries = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def member(self, name: str, chunks: Iterator[bytes]) -> None:
        # sizes follow the data (flag bit 3); the ZIP64 field makes them 64 bits wide
        start, raw = self.at, name.encode()
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(LOCAL + struct.pack("<HHHHHIIIHH", 45, 8, 0, 0, 0x21, 0, FULL32, FULL32, len(raw), len(extra)) + raw + extra)
        crc, begun = 0, self.at
        for chunk in chunks:
            crc = zlib.crc32(chunk, crc)
            self._put(chunk)
        size = self.at - begun
        self._put(b"PK\x07\x08" + struct.pack("<IQQ", crc, size, size))
        self.entries.append((raw, crc, size, start))

    def close(self) -> None:
        start = self.at
        for raw, crc, size, at in self.entries:
            wide = [v for v in (size, size, at) if v >= FULL32]
            extra = struct.pack(f"<HH{len(wide)}Q", 1, 8 * len(wide), *wide) if wide else b""
            self._put(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 8, 0, 0, 0x21, crc, min(size, FULL32), min(size, FULL32), len(raw), len(extra), 0, 0, 0, 0, min(at, FULL32)) + raw + extra)
        size, n, end = self.at - start, len(self.entries), self.at
        self._put(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
        self._put(LOCATOR + struct.pack("<IQI", 0, end, 1))
        self._put(END + struct.pack("<HHHHIIH", 0, 0, min(n, FULL16), min(n, FULL16), min(size, FULL32), min(start, FULL32), 0))


@dataclass
class Member:
    name: str
    start: int
    size: int


class PackageReader:
    """The stored members of a ZIP file that allows reads by range."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self.members = self._directory()

    def read(self, at: int, n: int) -> bytes:
        if n < 0 or at < 0 or at + n > self.size:
            raise ValueError("range outside the package")
        self.source.seek(at)
        data = self.source.read(n)
        if len(data) != n:
            raise ValueError("the package is cut short")
        return data

    def _directory(self) -> list[Member]:
        tail_at = max(0, self.size - 22 - FULL16)
        tail = self.read(tail_at, self.size - tail_at)
        found = tail.rfind(END)
        while found >= 0 and (found + 22 > len(tail) or found + 22 + struct.unpack_from("<H", tail, found + 20)[0] != len(tail)):
            found = tail.rfind(END, 0, found)
        if found < 0:
            raise ValueError("no end record: not a ZIP file")
        n, size, start = struct.unpack_from("<HII", tail, found + 10)
        end_at = tail_at + found
        if end_at >= 20 and (locator := self.read(end_at - 20, 20)).startswith(LOCATOR):
            wide_at = struct.unpack_from("<Q", locator, 8)[0]
            wide = self.read(wide_at, 56)
            if not wide.startswith(END64):
                raise ValueError("the ZIP64 end record is missing")
            n, size, start = struct.unpack_from("<QQQ", wide, 32)
        directory = self.read(start, size)
        members, at = [], 0
        for _ in range(n):
            if directory[at : at + 4] != CENTRAL:
                raise ValueError("the central directory is damaged")
            method, = struct.unpack_from("<H", directory, at + 10)
            packed, plain, n_name, n_extra, n_note = struct.unpack_from("<IIHHH", directory, at + 20)
            offset, = struct.unpack_from("<I", directory, at + 42)
            name = directory[at + 46 : at + 46 + n_name].decode()
            extra = directory[at + 46 + n_name : at + 46 + n_name + n_extra]
            e = 0
            while e + 4 <= len(extra):
                kind, length = struct.unpack_from("<HH", extra, e)
                if kind == 1:  # wide values, in this order, of the fields that are full
                    values = iter(struct.unpack_from(f"<{length // 8}Q", extra, e + 4))
                    plain = next(values) if plain == FULL32 else plain
                    packed = next(values) if packed == FULL32 else packed
                    offset = next(values) if offset == FULL32 else offset
                e += 4 + length
            if method == 0:
                members.append(Member(name, offset, packed))
            at += 46 + n_name + n_extra + n_note
        return members

    def data_start(self, member: Member) -> int:
        head = self.read(member.start, 30)
        if not head.startswith(LOCAL):
            raise ValueError(f"no member at {member.start}")
        return member.start + 30 + sum(struct.unpack_from("<HH", head, 26))

    def index(self) -> Iterator[tuple[int, int]]:
        """Place in the package and length of each record, from the index members."""
        starts = {m.name: (self.data_start(m), m.size) for m in self.members if m.name.startswith("archive/")}
        for m in self.members:
            if m.name.startswith("indexes/"):
                for line in self.read(self.data_start(m), m.size).decode().splitlines():
                    _, offset, length, name = line.rsplit(" ", 3)
                    begun, size = starts[f"archive/{name}"]
                    if int(offset) + int(length) > size:
                        raise ValueError("the index points outside its archive")
                    yield begun + int(offset), int(length)


# ---- the DataFrame operators


def _write(folder: str):
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = filesystem(folder)
        system.create_dir(base, recursive=True)
        rows = ((b, i) for b in found for i in range(len(b)))
        following = next(rows, None)
        while following is not None:
            path = f"{base}/{uuid.uuid4().hex}.wacz"
            index: list[str] = []

            def chunks() -> Iterator[bytes]:
                nonlocal following
                at = 0
                while following is not None and at < ROLL:
                    batch, i = following
                    page_id, url, html, refers_to = (batch.column(k)[i].as_py() for k in range(4))
                    payload = (html or "").encode()
                    packed = record(page_id, url or "", payload, base32_sha1(payload), refers_to)
                    index.append(f"{page_id} {at} {len(packed)} data.warc.gz\n")
                    at += len(packed)
                    yield packed
                    following = next(rows, None)

            with system.open_output_stream(path) as out:
                package = PackageWriter(out)
                package.member("archive/data.warc.gz", chunks())
                package.member("indexes/index.cdxj", ("".join(index[i : i + 4096]).encode() for i in range(0, len(index), 4096)))
                package.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(index)], pa.int64())], names=["path", "n_records"])

    return run


def write_packages(pages: DataFrame, least_revisit: int = LEAST_REVISIT) -> tuple[DataFrame, str]:
    """Write a record per page; ``path, n_records`` of the packages, and the URI of their folder. ``path`` is as the file system of
    that URI has it."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("payload_key", F.when(F.octet_length("html") >= least_revisit, F.sha1("html")))
    groups = keyed.filter("payload_key is not null and page_id is not null").groupBy("payload_key").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
    shared, _ = written(groups.filter("n > 1").select("payload_key", "response"), "payloads")
    refers_to = F.when(F.col("page_id") != F.col("response"), F.col("response"))
    ready = keyed.join(shared, "payload_key", "left").select("page_id", "url", "html", refers_to.alias("refers_to"))
    folder = qualified(pages.sparkSession, new_path(pages.sparkSession, "packages"))
    manifest, _ = written(ready.mapInArrow(_write(folder), "path string, n_records long"), "manifest")
    return manifest, folder


def _open(system: fs.FileSystem, path: str) -> PackageReader:
    return PackageReader(system.open_input_file(path), system.get_file_info(path).size)


def _index(folder: str):
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = filesystem(folder)
        for batch in found:
            for path in batch.column(0).to_pylist():
                places = list(_open(system, path).index())
                for i in range(0, len(places), SPLIT):
                    part = places[i : i + SPLIT]
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([[p for p, _ in part]], pa.list_(pa.int64())), pa.array([[n for _, n in part]], pa.list_(pa.int64()))], names=["path", "at", "size"])

    return run


def _read(folder: str):
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = filesystem(folder)
        for batch in found:
            for path, at, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                package = _open(system, path)
                rows = []
                for p, n in zip(at, size, strict=True):
                    got = parse_record(package.read(p, n))
                    h = got["headers"]
                    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = h["WARC-Type"] == "revisit"
                    if not revisit and (base32_sha1(got["payload"]) != digest or len(got["payload"]) != int(got["http"]["Content-Length"])):
                        raise ValueError(f"{path}: the record at {p} is damaged")
                    rows.append((_page(h["WARC-Record-ID"]), h["WARC-Target-URI"], int(got["http"]["Content-Length"]), digest, h["WARC-Type"], _page(h["WARC-Refers-To"]) if revisit else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return run


def _page(urn: str) -> int | None:
    return int(urn.strip("<>").removeprefix("urn:x-page:")) if "urn:x-page:" in urn else None


def read_packages(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the packages: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``."""
    places = manifest.select("path").mapInArrow(_index(folder), "path string, at array<long>, size array<long>")
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return places.mapInArrow(_read(folder), schema)


def op9_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to packages and read back."""
    with only(spark) as keep:
        manifest, folder = write_packages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
        return keep(*written(read_packages(manifest, folder).drop("url"), "records"))


# base32 of 160 bits: four characters for each five hexadecimal digits
OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""
