"""Convert legacy ARC web archives to WARC, and write and read both.

An ARC file opens with a version block that names the fields of its header lines: five in version
1, ten in version 2. Each record is one header line, whose last field is the length of what
follows, and that many bytes. The converter reads records by their declared lengths and
synthesises what WARC wants besides: record ids, ISO dates, record types and digests. Payloads
that occur more than once are written once; the other records revisit that one.

Archives are files of bounded size, one task reads or writes one at a time. They are written by
Spark's text sink, one archive a row, and read by its binary-file source, so any store that Spark
reaches will do. Only decisions about repeated payloads are shuffled by digest, and an archive
meets its own list of them as one row; pages themselves are not sorted or grouped.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shipping import ship
from tidemark.scratch import materialize, scratch_path

ARCHIVE_BYTES = 8 << 20
CAPTURED = "20240101000000"

# Fixed by the formats.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length",
    ],
}
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

META = (
    "archive string, offset long, record_id string, url string, date string, page_id long, "
    "payload_bytes long, payload_digest string"
)
READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, "
    "refers_to_id string, url string, date string"
)


def digest(data: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Head, with the blank line after it, and payload of an HTTP message."""
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[: end + 4], block[end + 4 :])


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


@dataclass
class ArcRecord:
    offset: int
    fields: dict[str, str]
    block: bytes


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file after its version block, by declared lengths."""
    line_end = data.index(b"\n")
    opening = data[:line_end].decode("utf-8", "replace").split(" ")
    if not opening[0].startswith("filedesc://"):
        raise ValueError("an ARC file opens with a filedesc record")
    at = line_end + 1 + int(opening[-1])
    described = data[line_end + 1 : at].decode("utf-8", "replace").split("\n")
    version = int(described[0].split(" ")[0])
    names = ARC_FIELDS[version]
    if described[1].split(" ") != names:
        raise ValueError(f"header fields of version {version} are {names}")
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        line_end = data.index(b"\n", at)
        # An address may hold spaces, the other fields hold none.
        values = data[at:line_end].decode("utf-8", "replace").rsplit(" ", len(names) - 1)
        if len(values) != len(names):
            raise ValueError(f"header line with {len(values)} fields at byte {at}")
        begin, length = line_end + 1, int(values[-1])
        if begin + length > len(data):
            raise ValueError(f"record at byte {at} ends before its declared length")
        yield ArcRecord(at, dict(zip(names, values)), data[begin : begin + length])
        at = begin + length


def arc_opening(name: str, version: int, date: str) -> bytes:
    body = f"{version} 0 tidemark\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    fields = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"]
    fields += ["200", "-", "-", "0", name] if version == 2 else []
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body


def arc_record(name: str, version: int, offset: int, url: str, date: str, block: bytes) -> bytes:
    fields = [url, "0.0.0.0", date, "text/html"]
    fields += ["200", "-", "-", str(offset), name] if version == 2 else []
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block + b"\n"


def _as_rows(archives: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    for archive in archives:
        yield pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], names=["archive"])


def _page_archives(batches: Iterator[pa.RecordBatch], date: str, most: int) -> Iterator[bytes]:
    from pyspark import TaskContext

    task, count, held, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        for page_id, url, html in zip(*(batch.column(i) for i in range(3))):
            if not held:
                version = 1 + (task + count) % 2
                name = f"pages-{task:06d}-{count:06d}.arc"
                held, size = [arc_opening(name, version, date)], 0
                size = len(held[0])
            payload = html.as_buffer().to_pybytes() if html.is_valid else b""
            number = page_id.as_py()
            head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            head += f"X-Page-Id: {number}\r\n" if number is not None else ""
            head += f"Content-Length: {len(payload)}\r\n\r\n"
            address = re.sub(r"[\x00-\x20\x7f]", lambda x: f"%{ord(x[0]):02X}", url.as_py() or "urn:none")
            held.append(arc_record(name, version, size, address, date, head.encode() + payload))
            size += len(held[-1])
            if size >= most:
                yield b"".join(held)
                held, count = [], count + 1
    if held:
        yield b"".join(held)


def _store(rows: DataFrame, label: str) -> str:
    """Write one gzip file per row; the sink ends each with a newline."""
    path = scratch_path(rows.sparkSession, label)
    writer = rows.select(F.col("archive").cast("string").alias("value")).write
    writer.option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)
    return path


def write_arcs(pages: DataFrame, date: str = CAPTURED, most: int = ARCHIVE_BYTES) -> str:
    """Write ``pages`` (``page_id``, ``url``, ``html``) as ARC files of both versions; their folder.

    Each page is one record, the payload of an HTTP response. Null html: empty. Null url: a
    placeholder. White space and control characters of urls are percent-encoded.
    """
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _as_rows(_page_archives(batches, date, most))

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("binary"))
    return _store(rows.mapInArrow(run, "archive binary"), "arc")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _unpacked(content: pa.Scalar) -> bytes:
    data = content.as_buffer().to_pybytes()
    return zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data


def _record_id(archive: str, offset: int) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}"


def _iso(date: str) -> str:
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split(" ")[0] for x in META.split(", ")]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            rows, data = [], _unpacked(content)
            for record in read_arc(data) if data else ():
                head, payload = split_http(record.block)
                page_id = http_field(head, "X-Page-Id")
                rows.append(
                    (
                        path,
                        record.offset,
                        _record_id(path, record.offset),
                        record.fields["URL"],
                        _iso(record.fields["Archive-date"]),
                        None if page_id is None else int(page_id),
                        len(payload),
                        digest(payload),
                    )
                )
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def to_warc(archive: str, data: bytes, revisits: dict[int, tuple[str, str, str]]) -> Iterator[bytes]:
    """WARC records of an ARC file; ``revisits`` gives id, address and date of what a record repeats."""
    about = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
    first = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", f"<{_record_id(archive, -1)}>"),
        ("WARC-Date", _iso(CAPTURED)),
        ("Content-Type", "application/warc-fields"),
    ]
    yield warc_record(first, about)
    for record in read_arc(data):
        head, payload = split_http(record.block)
        is_http = record.block[:5] == b"HTTP/"
        target = revisits.get(record.offset)
        kind = "revisit" if target else "response" if is_http else "resource"
        block = head if target else record.block
        fields = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", f"<{_record_id(archive, record.offset)}>"),
            ("WARC-Date", _iso(record.fields["Archive-date"])),
            ("WARC-Target-URI", record.fields["URL"]),
            ("WARC-IP-Address", record.fields["IP-address"]),
            ("Content-Type", "application/http; msgtype=response" if is_http else record.fields["Content-type"]),
            ("WARC-Payload-Digest", f"sha1:{digest(payload if is_http else record.block)}"),
            ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ]
        if target:
            fields += [
                ("WARC-Profile", IDENTICAL_PAYLOAD),
                ("WARC-Refers-To", f"<{target[0]}>"),
                ("WARC-Refers-To-Target-URI", target[1]),
                ("WARC-Refers-To-Date", target[2]),
            ]
        yield warc_record(fields, block)


def repeated_payloads(records: DataFrame, least: int = 0) -> DataFrame:
    """Records whose payload, of at least ``least`` bytes, a record with a larger page id has too, each with its ``leader``."""
    large = records.where(F.col("payload_bytes") >= least)
    same = ["payload_digest", "payload_bytes"]
    # The bits of a page id turned round: the largest id comes first, without overflow.
    place = [F.col("page_id").isNull().alias("unnamed"), F.bitwise_not("page_id").alias("place")]
    groups = large.groupBy(*same).agg(
        F.min(F.struct(*place, "page_id", "record_id", "url", "date")).alias("leader"), F.count(F.lit(1)).alias("n")
    )
    # Written, so that the join of a payload that very many records share can be split.
    groups = materialize(groups.where("n > 1 AND leader.page_id IS NOT NULL").drop("n"), "payload-leaders")
    later = F.col("page_id").isNull() | (F.col("page_id") < F.col("leader.page_id"))
    return large.join(groups, same).where(later)


def arc_to_warc(spark: SparkSession, folder: str, least: int = 0) -> str:
    """Convert all ARC files of a folder; the folder of the WARC files, one for each.

    Of records with equal payloads of at least ``least`` bytes, the one with the largest page id
    is a response (records that share that id all are), the others revisit it. A null page id is
    smaller than any other; if a payload has no other, its records are all responses.
    """
    ship(spark)
    records = materialize(_files(spark, folder).mapInArrow(_describe, META), "arc-records")
    revisits = repeated_payloads(records, least)
    lists = revisits.groupBy("archive").agg(F.collect_list(F.struct("offset", "leader.record_id", "leader.url", "leader.date")).alias("revisits"))
    archives = _files(spark, folder)
    paired = archives.join(lists, archives["path"] == lists["archive"], "left").select("path", "content", "revisits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, path in enumerate(batch.column("path").to_pylist()):
                data = _unpacked(batch.column("content")[i])
                if not data:
                    continue
                listed = batch.column("revisits")[i].as_py() or []
                targets = {x["offset"]: (x["record_id"], x["url"], x["date"]) for x in listed}
                whole = b"".join(to_warc(path, data, targets))
                yield from _as_rows(iter([whole[:-1]]))  # the sink adds the last newline

    return _store(paired.mapInArrow(run, "archive binary"), "warc")


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record, by declared lengths."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines)}
        begin, length = end + 4, int(fields["content-length"])
        if begin + length + 4 > len(data):
            raise ValueError(f"record at byte {at} ends before its declared length")
        yield fields, data[begin : begin + length]
        at = begin + length + 4


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split(" ")[0] for x in READ.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 6]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            for fields, block in read_warc(_unpacked(content)):
                if fields["warc-type"] not in ("response", "revisit"):
                    continue
                head, payload = split_http(block)
                stated = fields["warc-payload-digest"].partition(":")[2]
                if fields["warc-type"] == "response" and digest(payload) != stated:
                    raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
                size = http_field(head, "Content-Length")
                page_id = http_field(head, "X-Page-Id")
                is_revisit = fields["warc-type"] == "revisit"
                rows.append(
                    (
                        None if page_id is None else int(page_id),
                        int(size) if is_revisit else len(payload),
                        stated,
                        fields["warc-type"],
                        fields["warc-record-id"].strip("<>"),
                        fields["warc-refers-to"].strip("<>") if is_revisit else None,
                        fields["warc-target-uri"],
                        fields["warc-date"],
                    )
                )
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def read_warcs(spark: SparkSession, folder: str) -> DataFrame:
    """Responses and revisits of all WARC files of a folder; checks each payload against its digest."""
    ship(spark)
    return _files(spark, folder).mapInArrow(_read_back, READ)


def archive_pages(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` as ARC files, convert them to WARC, read these back: one row per page.

    ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` (page id of
    the response that a revisit repeats), ``record_id``, ``url``, ``date``. Null or empty html: an
    empty payload. Null url: a placeholder. Null page id: kept as null, see ``arc_to_warc``.
    Repeated rows: records of their own. A page larger than an archive: an archive of its own
    size. No rows: no rows. Other columns: ignored.
    """
    spark = pages.sparkSession
    rows = materialize(read_warcs(spark, arc_to_warc(spark, write_arcs(pages), least)), "warc-records")
    targets = rows.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    return rows.join(targets, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url", "date"
    )
