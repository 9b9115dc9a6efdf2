"""WARC archives: a writer with revisit records, and a reader whose tasks scan byte ranges.

Every record is a gzip member of its own. A task reads the bytes of its range, looks for the magic of gzip, and takes a
candidate for a member if its first bytes decode to the version line and headers of a WARC record. From there members
follow one another; each task owns those that start inside its range and reads the last one to its end, past the
range. After damaged bytes the scan goes on at the next candidate.

Files are written by tasks under a name that belongs to the attempt and are listed by what the tasks return, so lost or
repeated attempts leave only unlisted files. Paths may be of any store that pyarrow's file systems open.

Edge cases: a null payload is an empty one. A null URL leaves out its header; line ends in a URL are percent-encoded. A
null page_id is a record without a number and returns as null. Repeated rows make a record each: of equal payloads of
REVISIT_BYTES or more the row with the largest page_id is the response, and rows that repeat that very page_id are
responses too. An empty table makes no file, and reads as no record. Other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeframe.llm.staging import new_folder, staged

REVISIT_BYTES = 1000
#: Bytes of a reading task's range, of a file after which a writing task begins another, and that a reader keeps behind it.
RANGE_BYTES, FILE_BYTES, KEPT_BYTES = 4 << 20, 256 << 20, 1 << 20
#: The first bytes that every gzip member written here or by common tools has, and how much of one is decoded as a probe.
MAGIC, PROBE = b"\x1f\x8b\x08", 4096
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
PAGE = re.compile(r"<urn:page:(-?\d+)>$")
#: Shared digests (of 28 bytes and a page) that are sent to all tasks, and parts of one beyond that number.
BROADCAST_DIGESTS, SALTS = 500_000, 32
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
FILES = "path string, bytes long, records long"
RECORDS = "path string, offset long, headers map<string,string>, block binary"


class Record(NamedTuple):
    offset: int
    headers: dict[str, str]
    block: bytes


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _page(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit of page `refers_to`; both keep the HTTP headers, with the payload's full length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _page(page_id)), ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        headers.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _page(refers_to))]
    return member(headers, http if refers_to is not None else http + payload)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        sink, name, size, records, done = None, "", 0, 0, []
        for batch in batches:
            for page, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if sink is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    sink, size, records = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                data = page_record(page, url, (html or "").encode(), refers)
                sink.write(data)
                size, records = size + len(data), records + 1
                if size >= FILE_BYTES:
                    sink.close()
                    done.append((f"{folder}/{name}", size, records))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((f"{folder}/{name}", size, records))
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "bytes", "records"), d, strict=True)) for d in done], pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return run


def with_revisits(pages: DataFrame) -> DataFrame:
    """`pages` (page_id, url, html) with refers_to: the page of the response for revisits, else null.

    Only digests that large payloads share are looked for, from a narrow table of digests. Up to BROADCAST_DIGESTS of them
    go to all tasks, and pages stay where they are; more are joined by digest and one of SALTS numbers, so that a payload
    of very many pages isn't one task's."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    body = F.coalesce("html", F.lit(""))
    size = F.octet_length(body)
    digest = F.when(size >= REVISIT_BYTES, F.unhex(F.sha1(body)))  # small payloads have none, and meet nothing
    narrow = p.select("page_id", digest.alias("digest"), size.alias("size")).filter("digest IS NOT NULL")
    shared = narrow.groupBy("digest", "size").agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).filter("n > 1 AND largest IS NOT NULL").drop("n")
    shared = staged(shared, "warc-digests")
    rows = p.withColumns({"digest": digest, "size": size})
    if shared.count() <= BROADCAST_DIGESTS:
        found = rows.join(F.broadcast(shared), ["digest", "size"], "left")
    else:
        salted = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        large = rows.filter("digest IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = large.join(salted, ["digest", "size", "salt"], "left").drop("salt")
        found = joined.unionByName(rows.filter("digest IS NULL").withColumn("largest", F.lit(None).cast("long")))
    return found.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")).alias("refers_to"))


def write_pages(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of `pages` into files in `folder`; the files, once written."""
    return staged(with_revisits(pages).mapInArrow(_write(folder), FILES), "warc-files")


class _Bytes:
    """A file from an offset on, read as needed; what is done with is let go of now and then."""

    def __init__(self, path: str, start: int) -> None:
        store, name = _store(path)
        self.file = store.open_input_file(name)
        self.size, self.start, self.data = self.file.size(), start, b""

    def upto(self, end: int) -> None:
        have = self.start + len(self.data)
        if end > have and have < self.size:
            self.data += self.file.read_at(min(end, self.size) - have, have)

    def drop(self, offset: int) -> None:
        if offset - self.start >= max(KEPT_BYTES, len(self.data) // 2):
            self.data, self.start = self.data[offset - self.start :], offset

    def find(self, what: bytes, offset: int) -> int:
        at = self.data.find(what, offset - self.start)
        return at if at < 0 else at + self.start

    def piece(self, offset: int, size: int) -> bytes:
        return self.data[offset - self.start : offset - self.start + size]


def _is_member(data: bytes) -> bool:
    """Whether bytes begin with a gzip member whose content begins like a WARC record."""
    try:
        text = zlib.decompressobj(31).decompress(data, PROBE)
    except zlib.error:
        return False
    return bool(VERSION.match(text)) and (b"\r\nWARC-Type:" in text or len(text) >= PROBE)


def _parsed(text: bytes) -> tuple[dict[str, str], bytes] | None:
    head, gap, rest = text.partition(b"\r\n\r\n")
    if not gap or not VERSION.match(head + b"\r\n"):
        return None
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        headers[k.decode("utf-8", "replace").strip()] = v.decode("utf-8", "replace").strip()
    size = headers.get("Content-Length", "")
    return (headers, rest[: int(size)]) if size.isdigit() and len(rest) >= int(size) else None


def read_range(path: str, start: int, end: int) -> Iterator[Record]:
    """The records of a file whose members start in [start, end)."""
    data = _Bytes(path, start)
    try:
        yield from _records(data, start, end)
    finally:
        data.file.close()


def _records(data: _Bytes, start: int, end: int) -> Iterator[Record]:
    at, follows = start, start == 0
    while at < min(end, data.size):
        data.drop(at)
        data.upto(end + PROBE)
        if not (follows and data.piece(at, len(MAGIC)) == MAGIC):
            found = data.find(MAGIC, at)
            if found < 0 or found >= end:
                return
            if found > at:
                at, follows = found, False
                continue
        if not follows and not _is_member(data.piece(at, 4 * PROBE)):
            at += 1
            continue
        unpack, text, used = zlib.decompressobj(31), [], at
        try:
            while not unpack.eof:
                piece = data.piece(used, 1 << 16)
                if not piece:
                    data.upto(used + max(used - at, 1 << 16))
                    piece = data.piece(used, 1 << 16)
                if not piece:
                    raise zlib.error("the file ends within a member")
                text.append(unpack.decompress(piece))
                used += len(piece)
        except zlib.error:
            at, follows = at + 1, False
            continue
        if (record := _parsed(b"".join(text))) is not None:
            yield Record(at, *record)
        at, follows = used - len(unpack.unused_data), True


def read_warc(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, offset, headers and block of every record in `files` (path, bytes)."""
    ranges = files.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = ranges.withColumn("key", F.xxhash64("path", "start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary())])
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                rows, size = [], 0
                for r in read_range(path, start, start + range_bytes):
                    rows.append((path, r.offset, list(r.headers.items()), r.block))
                    size += len(r.block)
                    if size > 1 << 20:
                        yield _batch(rows, kind)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, kind)

    n = max(1, spark.sparkContext.defaultParallelism * 4)
    return ranges.repartition(n, "key").select("path", "start").mapInArrow(run, RECORDS)


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)


def _hex(digest: str) -> str | None:
    """The digest of a header in hex; null if it is of another kind or form."""
    try:
        return base64.b32decode(digest.removeprefix("sha1:")).hex() if digest.startswith("sha1:") else None
    except binascii.Error:
        return None


def page_table(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each record, from its headers and block.

    A response's length and digest are those of its payload as read; a revisit's are those that it tells of the full one, null
    where it doesn't. Records of other writers and kinds keep their type; what they don't say in our way is null, and the
    payload of one without an HTTP head is its block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = lambda s: int(m[1]) if (m := PAGE.match(s or "")) else None
        for batch in batches:
            out = []
            for pairs, block in zip(batch.column("headers").to_pylist(), batch.column("block").to_pylist(), strict=True):
                h, block = dict(pairs or []), block or b""
                head, gap, payload = block.partition(b"\r\n\r\n")
                told = re.search(rb"\r\nContent-Length: *(\d+)", head) if gap else None
                if h.get("WARC-Type") == "revisit":
                    size, digest = int(told[1]) if told else None, _hex(h.get("WARC-Payload-Digest", ""))
                else:
                    payload = payload if gap and head.startswith(b"HTTP/") else block
                    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                out.append((number(h.get("WARC-Record-ID")), size, digest, h.get("WARC-Type"), number(h.get("WARC-Refers-To"))))
            a, b, c, d, e = zip(*out, strict=True) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string()), pa.array(d, pa.string()), pa.array(e, pa.int64())], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return records.select("headers", "block").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def pages_through_warc(pages: DataFrame) -> DataFrame:
    """`pages` written as WARC into the shared folder and read back."""
    spark = pages.sparkSession
    return page_table(read_warc(spark, write_pages(pages, new_folder(spark, "warc"))))
