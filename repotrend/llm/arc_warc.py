"""Legacy ARC archives, and their conversion to WARC.

An ARC file starts with a version block, whose first line is the record header
of the file itself and whose body says which fields the header lines of the
other records have: five in version 1, ten in version 2.  A record is its header
line, as many bytes as the line declares, and a newline.  ARC has no record
types, identifiers or digests; the converter makes them up from what is there:

* WARC-Record-ID: a name-based UUID of the archive, the offset and the URL, so
  a repeated conversion gives the same one;
* WARC-Date: the 14 digits of the archive date (12 and 8 digits also occur);
* WARC-Type: warcinfo for the version block, response where the body starts with
  an HTTP status line, resource else;
* WARC-Block-Digest and WARC-Payload-Digest: SHA-256 of the block, and of what
  follows the HTTP header.

Of responses with equal payloads of at least ``MIN_REVISIT`` bytes the one with
the least page id keeps its payload; the others become revisit records that name
it.  Archives are written and read by Spark below the shared folder, a
partition a file, gzip-compressed; a reader decompresses a file as a stream, so
it holds the compressed file and one record at a time.

Defined results: a null html is an empty payload; a null or blank URL is written
as ``unknown:``; a null page id has no page header and comes back as null.
Repeated page ids keep their rows; equal payloads of one id refer to that id.
An empty table gives empty archives and no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repotrend.llm.scratch import Scratch

# Fixed values of the formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC_VERSION = "WARC/1.1"
WARC_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT = 100
ARCHIVE_DATE = "20240130000000"
PAGE_HEADER = "X-Page-Id"
_READ = 1 << 16


@dataclass
class ArcRecord:
    offset: int
    url: str
    date: str
    content_type: str
    body: bytes


class _Stream:
    """Bytes of a gzip-compressed (or plain) file, read in order."""

    def __init__(self, data: bytes):
        self.data, self.at, self.buffer, self.offset = memoryview(data), 0, bytearray(), 0
        self.unpack = zlib.decompressobj(31) if bytes(data[:2]) == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        part = self.data[self.at : self.at + _READ]
        self.at += len(part)
        if self.unpack is None:
            self.buffer += part
            return True
        self.buffer += self.unpack.decompress(part)
        while self.unpack.eof:  # the next member, if files of several members were joined
            rest = self.unpack.unused_data
            if not rest:
                if self.at >= len(self.data):
                    break
                rest = bytes(self.data[self.at : self.at + _READ])
                self.at += len(rest)
            self.unpack = zlib.decompressobj(31)
            self.buffer += self.unpack.decompress(rest)
        return True

    def take(self, size: int) -> bytes:
        while len(self.buffer) < size:
            if not self._more():
                raise ValueError(f"archive ends within a record, {size - len(self.buffer)} bytes early")
        out = bytes(self.buffer[:size])
        del self.buffer[:size]
        self.offset += size
        return out

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the file."""
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self._more():
                return None
        return self.take(at + len(mark))


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of one ARC file, the version block first."""
    stream, fields = _Stream(data), 0
    while True:
        offset, line = stream.offset, stream.until(b"\n")
        if line is None:
            return
        if not line.strip():
            continue
        # The URL is whatever stands before the fixed number of last fields.
        parts = line.decode("utf-8", "replace").rstrip("\r\n")
        if not fields:  # the version block: its own header has the fields of version 1 in either version
            own = parts.split(" ")
            short = own[-1].isdigit() and len(own) in (5, 10)
            if not parts.startswith("filedesc:") or not short:
                raise ValueError("not an ARC file")
            body = stream.take(int(own[-1]))
            names = body.decode("utf-8", "replace").splitlines()[1].split(" ")
            fields = len(names)
            yield ArcRecord(offset, own[0], own[2], own[3], body)
            continue
        values = parts.rsplit(" ", fields - 1)
        if len(values) != fields or not values[-1].isdigit():
            raise ValueError(f"bad record header at {offset}")
        yield ArcRecord(offset, values[0], values[2], values[3], stream.take(int(values[-1])))


def arc_header(version: int, url: str, date: str, content_type: str, body: bytes) -> str:
    if version == 1:
        return f"{url} 0.0.0.0 {date} {content_type} {len(body)}"
    return f"{url} 0.0.0.0 {date} {content_type} 200 {hashlib.md5(body).hexdigest()} - 0 - {len(body)}"


def version_block(version: int, date: str = ARCHIVE_DATE) -> str:
    body = f"{version} {0 if version == 1 else 1} own\n{ARC_FIELDS[version]}\n"
    return f"filedesc://pages.arc 0.0.0.0 {date} text/plain {len(body)}\n{body}"


def http_block(page_id: int | None, payload: bytes) -> bytes:
    own = f"{PAGE_HEADER}: {page_id}\r\n" if page_id is not None else ""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write (page_id, url, html) as ARC files, partitions in turn by version 1 and 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = 0
        for batch in batches:
            out = []
            for page_id, part, url, html in zip(*(batch.column(k) for k in range(4)), strict=True):
                if not version:
                    version = 1 + part.as_py() % 2
                    out.append(version_block(version))
                body = http_block(page_id.as_py(), (html.as_py() or "").encode())
                address = "%20".join((url.as_py() or "").split()) or "unknown:"
                out.append(f"{arc_header(version, address, ARCHIVE_DATE, 'text/html', body)}\n{body.decode()}")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.spark_partition_id().alias("part"),
                        F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows.mapInArrow(run, "value string").write.option("lineSep", "\n").option("compression", "gzip").text(path)


_PARSED = "record_id string, url string, date string, type string, content_type string, page_id long, head string, payload string, payload_bytes long, digest string"


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``most`` bytes of text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, str | bytes))
        if size >= most:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


def _split_http(body: bytes) -> tuple[bytes, bytes]:
    head, mark, payload = body.partition(b"\r\n\r\n")
    return (head + mark, payload) if mark and body.startswith(b"HTTP/") else (b"", body)


def _field(head: bytes, name: str) -> str | None:
    for line in head.split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def warc_date(date: str) -> str:
    d = date.ljust(14, "0") if len(date) > 8 else date[:8] + "000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def convert(name: str, record: ArcRecord) -> tuple:
    """The WARC fields of an ARC record, in the order of ``_PARSED``."""
    head, payload = _split_http(record.body)
    kind = "warcinfo" if record.url.startswith("filedesc:") else "response" if head else "resource"
    made = uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{record.offset} {record.url}")
    page = _field(head, PAGE_HEADER)
    return (f"<urn:uuid:{made}>", record.url, warc_date(record.date), kind, record.content_type, int(page) if page else None,
            head.decode("utf-8", "replace"), payload, len(payload), hashlib.sha256(payload).hexdigest())


_PARSED_ARROW = pa.schema([
    ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()), ("type", pa.string()), ("content_type", pa.string()),
    ("page_id", pa.int64()), ("head", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("digest", pa.string()),
])


def parse_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the ARC files below ``path``, but for version blocks, with their WARC fields."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                records = read_arc(content.as_py())
                short = name.as_py().rpartition("/")[2]
                yield from _batches((c for r in records if (c := convert(short, r))[3] != "warcinfo"), _PARSED_ARROW)

    return _archives(spark, path).mapInArrow(run, _PARSED.replace("payload string", "payload binary"))


def with_revisits(records: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """``records`` with ``first``, the record that a repeated payload refers to (null for a response)."""
    keyed = records.where(f"payload_bytes >= {least} AND type = 'response'")
    first = keyed.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "record_id", "url", "date")).alias("first"), F.count("*").alias("copies"))
    first = first.where("copies > 1").drop("copies")
    key = F.when((F.col("payload_bytes") >= least) & (F.col("type") == "response"), F.col("digest"))
    out = records.withColumn("key", key).join(first.withColumnRenamed("digest", "key"), "key", "left").drop("key")
    return out.withColumn("first", F.when(F.col("first.record_id") != F.col("record_id"), F.col("first")))


def write_warc(records: DataFrame, path: str) -> None:
    """Write the rows of ``with_revisits`` as WARC files: a record a row, two line ends after each."""

    def named(fields: list[tuple[str, object]], block: bytes) -> bytes:
        lines = [WARC_VERSION, *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
        return "\r\n".join(lines).encode() + b"\r\n\r\n" + block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = False
        for batch in batches:
            out = []
            if not begun:
                begun = True
                info = b"software: arc converter\r\nformat: WARC File Format 1.1\r\n"
                made = uuid.uuid5(uuid.NAMESPACE_URL, f"warcinfo {batch.column('record_id')[0] if len(batch) else ''}")
                out.append(named([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{made}>"),
                                  ("WARC-Date", warc_date(ARCHIVE_DATE)), ("Content-Type", "application/warc-fields")], info))
            columns = [batch.column(c) for c in ("record_id", "url", "date", "type", "content_type", "head", "payload", "digest", "first")]
            for row in zip(*columns, strict=True):
                record_id, url, date, kind, content_type, head, payload, digest, first = (x.as_py() for x in row)
                head = head.encode()
                block = head if first else head + payload
                fields = [("WARC-Type", "revisit" if first else kind), ("WARC-Record-ID", record_id), ("WARC-Target-URI", url), ("WARC-Date", date),
                          ("Content-Type", "application/http;msgtype=response" if head else content_type),
                          ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("WARC-Payload-Digest", f"sha256:{digest}")]
                if first:
                    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", first["record_id"]),
                               ("WARC-Refers-To-Target-URI", first["url"]), ("WARC-Refers-To-Date", first["date"])]
                out.append(named(fields, block))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = records.select("record_id", "url", "date", "type", "content_type", "head", "payload", "digest", "first")
    text = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    text.write.option("lineSep", WARC_END).option("compression", "gzip").text(path)


_WARC = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("date", pa.string()), ("page_id", pa.int64()),
    ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_record", pa.string()),
])


def _warc_records(data: bytes, with_payload: bool) -> Iterator[tuple]:
    stream = _Stream(data)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record at {stream.offset - len(head)}")
        block = stream.take(int(_field(head, "Content-Length") or 0))
        if stream.take(len(WARC_END)) != WARC_END.encode():
            raise ValueError("a WARC record doesn't end where it says")
        kind = _field(head, "WARC-Type")
        if kind == "warcinfo":
            continue
        http, payload = _split_http(block)
        page = _field(http, PAGE_HEADER)
        revisit = kind == "revisit"
        digest = (_field(head, "WARC-Payload-Digest") or "").removeprefix("sha256:") if revisit else hashlib.sha256(payload).hexdigest()
        size = int(_field(http, "Content-Length") or 0) if revisit else len(payload)
        yield (_field(head, "WARC-Record-ID"), kind, _field(head, "WARC-Target-URI"), _field(head, "WARC-Date"), int(page) if page else None,
               None if revisit or not with_payload else payload, size, digest, _field(head, "WARC-Refers-To"))


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of the WARC files below ``path`` but for warcinfo, digests of responses worked out from their payloads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                yield from _batches(_warc_records(content.as_py(), with_payload), _WARC)

    return _archives(spark, path).mapInArrow(run, (
        "record_id string, record_type string, url string, date string, page_id long, payload binary, payload_bytes long, "
        "payload_digest string, refers_to_record string"))


def convert_pages(pages: DataFrame) -> str:
    """Write pages as ARC, convert those to WARC; returns the folder of the WARC files."""
    spark = pages.sparkSession
    scratch = Scratch(spark)
    write_arc(pages, scratch.path("arc"))
    write_warc(with_revisits(parse_arc(spark, scratch.path("arc"))), scratch.path("warc"))
    return scratch.path("warc")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the WARC files below ``path``."""
    records = read_warc(spark, path, with_payload=False).drop("payload")
    target = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"))
    return records.join(target, "refers_to_record", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
