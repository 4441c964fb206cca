"""WARC records in ZIP packages, read back by ranges.

A package is a ZIP file with two stored (uncompressed) members: ``archive/data.warc.gz``, WARC
records each compressed on its own, and ``indexes/index.cdx``, one line per record with its
offset and length inside the archive member. The reader looks only at the end of a package
for its central directory (ZIP64 records included), finds the stored members by it, reads the
index by range and then each record by range; nothing is extracted. Ranges of several records
are one row of a DataFrame, so large packages are read by many tasks.

Packages are written by the tasks into the shared folder under names of their own; only the
packages named by the written manifest count, so a task that ran twice leaves no record twice.

Equal payloads are stored once: the row with the smallest ``page_id`` is the response (all
rows with that id and payload, should the id repeat), others are revisits. Null ids come last;
a null payload is empty; a null URL leaves its header out, control characters in it are
percent-encoded. Payloads below ``min_bytes`` are always responses.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, look_up, shared_folder, store, utf8

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def build_record(page_id, url, payload: bytes, digest: str, response: bool, refers_to) -> bytes:
    """One WARC/1.1 record. A revisit has HTTP headers only; its extension header keeps the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if response else http
    headers = [("WARC-Type", "response" if response else "revisit"), ("WARC-Record-ID", record_id(page_id))]
    headers += [("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        headers.append(("WARC-Target-URI", safe))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if not response:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names), ``payload`` and its parts of one WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[: int(headers["content-length"])]
    if len(block) < int(headers["content-length"]):
        raise ValueError("truncated WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    return {**headers, "http": http, "payload": payload}


class Ranges:
    """A file read by ranges."""

    def __init__(self, path: str):
        store_, inner = fs.FileSystem.from_uri(path)
        self.file = store_.open_input_file(inner)
        self.size = self.file.size()

    def read(self, at: int, length: int) -> bytes:
        data = self.file.read_at(length, at)
        if len(data) < length:
            raise ValueError(f"file ends before byte {at + length}")
        return data

    def close(self) -> None:
        self.file.close()


def central_directory(source) -> tuple[int, int, int]:
    """(offset, length, entries) of the central directory, by the end records (ZIP64 where present)."""
    tail_at = max(0, source.size - 65_557)
    tail = source.read(tail_at, source.size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    # The true end record's comment reaches to the end of the file.
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    entries, length, at = struct.unpack_from("<HII", tail, end + 10)
    locator = tail_at + end - 20
    if locator >= 0 and (found := source.read(locator, 20))[:4] == b"PK\x06\x07":
        record = source.read(struct.unpack_from("<Q", found, 8)[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record where the locator points")
        entries, length, at = struct.unpack_from("<QQQ", record, 32)
    return at, length, entries


def members(source) -> dict[str, tuple[int, int]]:
    """Name -> (offset of the data, length) of every stored member."""
    at, length, entries = central_directory(source)
    directory, found, p = source.read(at, length), {}, 0
    for _ in range(entries):
        if directory[p : p + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", directory, p + 8)
        packed_size, size, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, p + 20)
        header = struct.unpack_from("<I", directory, p + 42)[0]
        name = directory[p + 46 : p + 46 + n_name]
        extra = directory[p + 46 + n_name : p + 46 + n_name + n_extra]
        q = 0
        while q + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, q)
            if kind == 1:  # ZIP64: only the fields that did not fit, in this order
                r = q + 4
                if size == 0xFFFFFFFF:
                    (size,), r = struct.unpack_from("<Q", extra, r), r + 8
                if packed_size == 0xFFFFFFFF:
                    (packed_size,), r = struct.unpack_from("<Q", extra, r), r + 8
                if header == 0xFFFFFFFF:
                    (header,) = struct.unpack_from("<Q", extra, r)
            q += 4 + n
        if method == 0 and not flags & 1:
            local = source.read(header, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError("no local header where the directory points")
            n_local_name, n_local_extra = struct.unpack_from("<HH", local, 26)
            found[name.decode("utf-8" if flags & 0x800 else "cp437")] = (header + 30 + n_local_name + n_local_extra, size)
        p += 46 + n_name + n_extra + n_comment
    return found


def index_ranges(source, range_bytes: int) -> list[tuple[int, list[int]]]:
    """Neighbouring records of a package as (absolute offset, lengths) of about ``range_bytes``."""
    stored = members(source)
    base = stored[ARCHIVE][0]
    lines = source.read(*stored[INDEX]).decode("ascii").splitlines()
    places = sorted((base + int(offset), int(length)) for _, offset, length in (line.split(" ") for line in lines))
    ranges: list[tuple[int, list[int]]] = []
    for offset, length in places:
        if ranges and ranges[-1][0] + sum(ranges[-1][1]) == offset and sum(ranges[-1][1]) + length <= range_bytes:
            ranges[-1][1].append(length)
        else:
            ranges.append((offset, [length]))
    return ranges


def with_first(pages: DataFrame, min_bytes: int = 0, per_slice: int = 20_000) -> DataFrame:
    """page_id, url, payload and, for payloads seen before, ``refers_to``; ``response`` tells both apart."""
    rows = pages.select("page_id", "url", utf8("html").alias("payload")).withColumn("sha", F.sha1("payload"))
    own = F.octet_length("payload") < min_bytes
    keys = rows.filter(~own).groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
    repeated = store(keys.filter("n > 1"), "repeated")
    joined = look_up(rows, repeated, ["sha"], ["page_id", "url"], per_slice=per_slice)
    response = own | F.col("n").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "payload", response.alias("response"), F.when(~response, F.col("first")).alias("refers_to")
    )


def write_packages(records: DataFrame, package_bytes: int = 256 << 20) -> DataFrame:
    """Write ``with_first`` rows to ZIP packages; (path, records) of each, written and reread."""
    folder = f"{shared_folder(records.sparkSession)}/packages-{uuid.uuid4().hex}"

    def run(batches: Batches) -> Batches:
        target, inner = fs.FileSystem.from_uri(folder)
        target.create_dir(inner, recursive=True)
        package = None
        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    package = Package(target, f"{inner}/{uuid.uuid4().hex}.zip", folder)
                payload = row["payload"]
                record = build_record(
                    row["page_id"], row["url"], payload, payload_digest(payload), row["response"], row["refers_to"]
                )
                package.add(row["page_id"], record)
                if package.offset >= package_bytes:
                    yield package.close()
                    package = None
        if package is not None:
            yield package.close()

    return store(records.mapInArrow(run, "path string, records long"), "manifest")


class Package:
    """One ZIP package being written as a stream."""

    def __init__(self, target, inner: str, folder: str):
        self.path = f"{folder}/{inner.rpartition('/')[2]}"
        self.stream = target.open_output_stream(inner)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.offset, self.lines = 0, []

    def add(self, page_id, record: bytes) -> None:
        data = gzip.compress(record, 1, mtime=0)
        self.member.write(data)
        self.lines.append(f"{'-' if page_id is None else page_id} {self.offset} {len(data)}\n")
        self.offset += len(data)

    def close(self) -> pa.RecordBatch:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(self.lines))
        self.zip.close()
        self.stream.close()
        return pa.RecordBatch.from_pylist([{"path": self.path, "records": len(self.lines)}])


def read_packages(manifest: DataFrame, range_bytes: int = 4 << 20) -> DataFrame:
    """All records of the packages named in ``manifest``, with url and payload."""

    def find(batches: Batches) -> Batches:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                source = Ranges(path)
                ranges = index_ranges(source, range_bytes)
                source.close()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(ranges), pa.string()),
                        pa.array([r[0] for r in ranges], pa.int64()),
                        pa.array([r[1] for r in ranges], pa.list_(pa.int64())),
                    ],
                    ["path", "at", "lengths"],
                )

    def read(batches: Batches) -> Batches:
        for batch in batches:
            for one in batch.to_pylist():
                source = Ranges(one["path"])
                data, p, rows = source.read(one["at"], sum(one["lengths"])), 0, []
                source.close()
                for length in one["lengths"]:
                    rows.append(_row(parse_record(zlib.decompress(data[p : p + length], 31))))
                    p += length
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("url", pa.string()),
            ("payload", pa.binary()),
        ]
    )
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = manifest.mapInArrow(find, "path string, at long, lengths array<long>").repartition(tasks)
    return ranges.mapInArrow(read, f"{RECORD}, url string, payload binary")


def _row(record: dict) -> dict:
    response = record["warc-type"] == "response"
    digest = record["warc-payload-digest"].removeprefix("sha1:")
    if response and payload_digest(record["payload"]) != digest:
        raise ValueError(f"payload of {record['warc-record-id']} does not match its digest")
    return {
        "page_id": page_of(record["warc-record-id"]),
        "payload_bytes": len(record["payload"]) if response else int(record["x-payload-length"]),
        "payload_digest": digest,
        "record_type": record["warc-type"],
        "refers_to": None if response else page_of(record["warc-refers-to"]),
        "url": record.get("warc-target-uri"),
        "payload": record["payload"] if response else None,
    }


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to packages and read every record back."""
    return read_packages(write_packages(with_first(pages, min_bytes)))
