"""ARC and WARC round trips."""

from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.archives import (
    CAPTURED,
    archive_pages,
    arc_opening,
    arc_record,
    arc_to_warc,
    read_arc,
    read_warc,
    repeated_payloads,
    to_warc,
    write_arcs,
)


def b32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_come_by_declared_length(version):
    blocks = [b"HTTP/1.1 200 OK\r\n\r\nhttp://x 1 2 3 4\n\n", b"", b"\nplain\n"]
    data = arc_opening("a.arc", version, CAPTURED)
    for i, block in enumerate(blocks):
        data += arc_record("a.arc", version, len(data), f"http://h/{i} with space", CAPTURED, block)
    records = list(read_arc(data))
    assert [r.block for r in records] == blocks
    assert records[0].fields["URL"] == "http://h/0 with space"
    assert records[2].fields["Archive-date"] == CAPTURED


def test_cut_archive_is_an_error():
    data = arc_opening("a", 1, CAPTURED) + arc_record("a", 1, 0, "u", CAPTURED, b"12345")
    with pytest.raises(ValueError):
        list(read_arc(data[:-3]))


def test_warc_of_an_arc():
    data = arc_opening("a", 2, CAPTURED)
    first = len(data)
    data += arc_record("a", 2, first, "http://h/1", CAPTURED, b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody")
    second = len(data)
    data += arc_record("a", 2, second, "http://h/2", CAPTURED, b"HTTP/1.1 200 OK\r\nA: c\r\n\r\nbody")
    data += arc_record("a", 2, 0, "dns:h", CAPTURED, b"h 1.2.3.4")
    records = list(read_warc(b"".join(to_warc("a", data, {first: ("urn:uuid:x", "http://h/2", "d")}))))
    assert [f["warc-type"] for f, _ in records] == ["warcinfo", "revisit", "response", "resource"]
    assert len({f["warc-record-id"] for f, _ in records}) == 4
    assert records[1][0]["warc-refers-to"] == "<urn:uuid:x>" and records[1][1].endswith(b"A: b\r\n\r\n")
    assert records[2][0]["warc-date"] == "2024-01-01T00:00:00Z"
    assert records[2][0]["warc-payload-digest"] == f"sha1:{b32(b'body')}"
    assert records[3][0]["warc-payload-digest"] == f"sha1:{b32(b'h 1.2.3.4')}"


def test_pages_come_back(spark, frame):
    trap = "WARC/1.1\r\n\r\n\r\n\r\nfiledesc://x 1 2 3 4\n" * 3
    pages = [
        (1, "http://a b\n", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", "é\r\n\r\nx"),
        (6, "u", trap), (None, "u", "same"), (None, "u", "lonely"), (None, "u", "lonely"), (7, "u", "big" * 100000),
        (8, "u", "twice"), (8, "u", "twice"), (9, "u", "\n"),
    ]
    df = frame([(*p, 0) for p in pages], "page_id long, url string, html string, archive int")
    rows = [r.asDict() for r in archive_pages(df).collect()]
    assert len(rows) == len(pages)
    found = sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] or -1) for r in rows)
    tops = {"same": 2, "": 4}
    expected = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        top = tops.get(html or "", page_id)
        revisit = top != page_id
        expected.append((page_id or -1, len(data), b32(data), "revisit" if revisit else "response", top if revisit else -1))
    assert found == sorted(expected)


def test_least_payload(spark, frame):
    pages = frame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    rows = archive_pages(pages, least=3).collect()
    assert {r["page_id"] for r in rows if r["record_type"] == "revisit"} == {3}


def test_small_archives_and_files(spark, frame):
    pages = frame([(i, "u", f"page {i % 3}") for i in range(20)], "page_id long, url string, html string").coalesce(1)
    folder = write_arcs(pages, most=500)
    arcs = spark.read.format("binaryFile").load(folder)
    assert arcs.count() > 3
    warcs = spark.read.format("binaryFile").load(arc_to_warc(spark, folder))
    assert warcs.count() == arcs.count()


def test_no_pages(spark, frame):
    assert archive_pages(frame([], "page_id long, url string, html string")).count() == 0


def test_a_payload_of_a_third_of_all_records_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    records = spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("EMPTY")).otherwise((F.col("id") % 5000).cast("string")).alias("payload_digest"),
        F.lit(7).cast("long").alias("payload_bytes"),
        F.when(F.col("id") != 5, F.col("id")).alias("page_id"),
        *[F.sha2(F.col("id").cast("string"), 256).alias(c) for c in ("record_id", "url", "date")],
    )
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = repeated_payloads(records).select("payload_digest", "page_id", "leader.page_id")
        rows = found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    tops, members = {}, {}
    for i in range(30_000):
        key = "EMPTY" if i % 3 == 0 else str(i % 5000)
        members.setdefault(key, []).append(None if i == 5 else i)
        tops[key] = max([j for j in members[key] if j is not None], default=None)
    expected = {(k, i, tops[k]) for k, v in members.items() for i in v if i != tops[k]}
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)
