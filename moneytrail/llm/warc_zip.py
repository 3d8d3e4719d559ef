"""WARC archives packed into ZIP files, read back by byte ranges.

An archive is a ZIP file with two *stored* members: ``archive/data.warc.gz`` (one gzip member per
record) and ``indexes/index.cdxj`` (one line per record: URI, date, offset and length of the record in
the data member, page id). The reader never extracts: it reads the ZIP's tail, parses the central
directory (ZIP64 fields included), finds the stored members, reads the index and hands out byte
ranges; tasks then read and parse only their ranges.

Payloads of at least ``MIN_REVISIT`` bytes that are equal (SHA-256) are stored once: the record with the
smallest page_id is a response, the others are revisits that name it.

Archives go to the shared folder through ``pyarrow.fs`` (file, hdfs, s3, gs). A task writes its archives
under names of its own and reports them in a Parquet manifest, so archives of lost or repeated
tasks are never read.

Defined cases: a null payload is an empty one; a null page_id is written as ``null`` and is never
referred to; rows that tie on page_id and payload are all written like the first; a null url leaves out
the target URI; an empty table makes no archive; other columns are not written.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moneytrail.llm.common import fresh_path, written

MIN_REVISIT = 100
#: A data member is closed and a new archive begun after so many bytes.
ARCHIVE_BYTES = 256 << 20
#: Bytes that a reading task fetches at once (one record at least).
RANGE_BYTES = 1 << 20
#: Bytes of archives that one task reads, on average.
READ_BYTES = 16 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"

RECORD = "page_id bigint, uri string, record_type string, refers_to bigint, payload binary, payload_bytes bigint, payload_digest string"

# --------------------------------------------------------------------------- writing


def record_bytes(page_id: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'null' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if uri is not None:
        head["WARC-Target-URI"] = quote(uri, safe="!#$%&'()*+,/:;=?@[]~")
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


class _Archive:
    """One ZIP file being written as a stream."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        files, at = pafs.FileSystem.from_uri(self.path)
        files.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.stream = files.open_output_stream(at)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, page_id, uri, payload, digest, refers_to) -> None:
        pack = zlib.compressobj(3, zlib.DEFLATED, 31)
        part = pack.compress(record_bytes(page_id, uri, payload, digest, refers_to)) + pack.flush()
        self.data.write(part)
        entry = {"offset": self.size, "length": len(part), "page": page_id}
        self.lines.append(f"{quote(uri or '-', safe=':/?=&')} {re.sub(r'[^0-9]', '', DATE)} {json.dumps(entry)}\n")
        self.size += len(part)

    def close(self) -> dict:
        self.data.close()
        self.zip.writestr(INDEX, "".join(self.lines))
        self.zip.close()
        self.stream.close()
        return {"path": self.path, "records": len(self.lines), "bytes": self.size}


def write_archives(pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every row as a record; returns the manifest (path, records, bytes) of the archives."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    first = rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    refers = F.when(F.coalesce(F.col("page_id") != F.col("first_id"), F.col("first_id").isNotNull()), F.col("first_id"))
    long = F.octet_length("payload") >= MIN_REVISIT
    joined = rows.where(long).join(first, "digest", "left")  # shorter ones are never revisits
    short = rows.where(~long).withColumn("first_id", F.lit(None).cast("bigint"))
    ready = joined.unionByName(short).select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for row in zip(*columns, strict=True):
                archive = archive or _Archive(folder)
                archive.add(*(x.as_py() for x in row))
                if archive.size >= archive_bytes:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_pylist(done, pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return written(ready.mapInArrow(run, "path string, records bigint, bytes bigint"), "warc-manifest")


# --------------------------------------------------------------------------- reading


def zip_members(read, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (method, offset of the local header, compressed size), from ``read(offset, length)``."""
    tail_at = max(0, size - 65_557 - 20)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":  # the locator of the ZIP64 record
        (where,) = struct.unpack_from("<Q", tail, at - 12)
        end = read(where, 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("damaged ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", end, 32)
    directory, found, p = read(start, length), {}, 0
    for _ in range(count):
        if directory[p : p + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", directory, p + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", directory, p + 20)
        (offset,) = struct.unpack_from("<I", directory, p + 42)
        name = directory[p + 46 : p + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, q = directory[p + 46 + n_name : p + 46 + n_name + n_extra], 0
        while q + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, q)
            if kind == 1:  # 64-bit values, in this order, of the fields that are all ones
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, q + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            q += 4 + n
        found[name] = method, offset, packed
        p += 46 + n_name + n_extra + n_comment
    return found


def stored_range(read, member: tuple[int, int, int]) -> tuple[int, int]:
    """(offset, length) of a stored member's bytes in the file."""
    method, offset, length = member
    if method != 0:
        raise ValueError("the member is compressed: it can't be read by ranges")
    head = read(offset, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("damaged local header")
    n_name, n_extra = struct.unpack_from("<HH", head, 26)
    return offset + 30 + n_name + n_extra, length


def _opened(path: str):
    files, at = pafs.FileSystem.from_uri(path)
    file = files.open_input_file(at)
    return file, lambda offset, length: file.read_at(length, offset)


def _directories(range_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                file, read = _opened(path)
                with file:
                    members = zip_members(read, file.size())
                    base, _ = stored_range(read, members[DATA])
                    lines = read(*stored_range(read, members[INDEX])).decode().splitlines()
                out, lengths, start = [], [], 0
                for line in lines:
                    entry = json.loads(line.split(" ", 2)[2])
                    if lengths and sum(lengths) + entry["length"] > range_bytes:
                        out.append({"path": path, "offset": base + start, "lengths": lengths})
                        lengths = []
                    start = entry["offset"] if not lengths else start
                    lengths.append(entry["length"])
                if lengths:
                    out.append({"path": path, "offset": base + start, "lengths": lengths})
                yield pa.RecordBatch.from_pylist(out, pa.schema([("path", pa.string()), ("offset", pa.int64()), ("lengths", pa.list_(pa.int64()))]))

    return run


def parse_record(part: bytes) -> dict:
    """One gzipped record as a row; a response's payload is checked against its digest."""
    raw = zlib.decompress(part, 31)
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    page = re.fullmatch(r"<urn:page:(-?\d+|null)>", fields["WARC-Record-ID"])[1]
    refers = fields.get("WARC-Refers-To")
    kind, digest, payload = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:"), None
    n = int(fields["WARC-Payload-Length"])
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        n = len(payload)
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"page {page}: the payload doesn't match its digest")
    return {"page_id": None if page == "null" else int(page), "uri": fields.get("WARC-Target-URI"), "record_type": kind, "refers_to": refers and int(refers[10:-1]), "payload": payload, "payload_bytes": n, "payload_digest": digest}


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (x.split() for x in RECORD.split(", "))])
    for batch in batches:
        for row in batch.to_pylist():
            file, read = _opened(row["path"])
            with file:
                data, at, out = read(row["offset"], sum(row["lengths"])), 0, []
            for n in row["lengths"]:
                out.append(parse_record(data[at : at + n]))
                at += n
            yield pa.RecordBatch.from_pylist(out, schema)


def reading_tasks(manifest: DataFrame, read_bytes: int = READ_BYTES) -> tuple[int, int]:
    """(tasks that read directories, tasks that read records), from the archives' number and bytes."""
    n, size = manifest.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return max(1, n), max(1, -(-size // read_bytes))


def read_archives(manifest: DataFrame, *, range_bytes: int = RANGE_BYTES, read_bytes: int = READ_BYTES) -> DataFrame:
    """The records of the archives that a manifest names, one row each.

    Only small descriptors of ranges are shuffled, so their size says nothing of the work: the numbers of tasks are given.
    """
    archives, tasks = reading_tasks(manifest, read_bytes)
    ranges = manifest.select("path").repartition(archives, "path").mapInArrow(_directories(range_bytes), "path string, offset bigint, lengths array<bigint>")
    return ranges.repartition(tasks, "path", "offset").mapInArrow(_records, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages to new archives in the shared folder and read them back."""
    return read_archives(write_archives(pages, fresh_path(spark, "warc")))
