import base64
import hashlib
import io
import struct

import pytest

from quayside.llm.warc import (DICTIONARY_MAGIC, ArchiveError, ArchiveWriter, archive_round_trip, parse_record, read_archives,
                               read_records, record_bytes, write_archives)
from quayside.session import scratch_path

PAGES = "page_id long, url string, html string, archive string"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    out = []
    for i, _, html in rows:
        size = len((html or "").encode())
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        top = max(ids, default=None)
        revisit = size >= least and len([1 for _, _, h in rows if (h or "") == (html or "")]) > 1 and top is not None and i != top
        out.append((i, size, sha(html), "revisit" if revisit else "response", top if revisit else None))
    return out


def key(row):
    return tuple((x is None, str(x)) for x in row)


ROWS = [(1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"), (3, "u\r\nX: y", None), (4, "u", ""),
        (5, "u", "long " * 100_000), (6, "ü", "é€😀"), (7, "u", "once"), (7, "u", "once"), (None, "u", "once"), (None, "u", "alone")] \
    + [(100 + i, f"http://b/{i}", f"<html><body><p>page number {i} with common words</p></body></html>") for i in range(300)]


@pytest.mark.parametrize("least", [0, 8])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], PAGES).repartition(3)
    got = archive_round_trip(pages, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(ROWS, least), key=key)


def test_hot_payload_and_payload_bytes(spark):
    rows = [(i, "u", "hot" if i % 3 else f"page {i}") for i in range(2000)]
    pages = spark.createDataFrame([(*r, "") for r in rows], PAGES)
    files = write_archives(pages, scratch_path(spark, "warc-test"))
    files.cache()
    got = read_archives(spark, files).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response"} == \
        {i: h for i, _, h in rows if h != "hot" or i == 1999}
    assert sum(r.records for r in files.collect()) == 2000
    assert archive_round_trip(pages.limit(0)).count() == 0


def archive(n):
    out = io.BytesIO()
    writer = ArchiveWriter(out)
    records = [record_bytes(i, f"http://x/{i}", f"some text of record {i} with a tail".encode() * 5, None, False) for i in range(n)]
    for r in records:
        writer.add(r)
    writer.close()
    return out.getvalue(), records


def test_dictionary_is_in_the_leading_skippable_frame():
    data, records = archive(2000)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == DICTIONARY_MAGIC and size > 0
    assert list(read_records(io.BytesIO(data))) == records
    few, records = archive(2)  # too few records for a dictionary
    assert struct.unpack("<I", few[:4])[0] != DICTIONARY_MAGIC and list(read_records(io.BytesIO(few))) == records
    assert list(read_records(io.BytesIO(b""))) == []


def test_damage_is_found():
    data, _ = archive(500)
    for broken in (data[:-3], data[:100], data[:-40] + b"x" * 8 + data[-32:]):
        with pytest.raises(ArchiveError):
            list(read_records(io.BytesIO(broken)))
    good = record_bytes(5, "http://x", b"payload", None, False)
    assert parse_record(good)["page_id"] == 5
    for old, new in ((b"WARC/1.1", b"WARC/9.9"), (b"payload", b"paYload"), (b"WARC-Date", b"Date"), (b"response\r\nWARC-Rec", b"other\r\nWARC-Rec"),
                     (b"WARC-Record-ID: <urn:page:5>", b"WARC-Record-ID: 5"), (b"payload\r\n\r\n", b"payload")):
        assert old in good
        with pytest.raises(ArchiveError):
            parse_record(good.replace(old, new))


def test_archives_are_read_by_many_tasks(spark):
    pages = spark.range(64).selectExpr("id AS page_id", "concat('http://x/', id) AS url", "repeat(cast(id AS string), 50) AS html").repartition(16)
    out = archive_round_trip(pages)
    assert out.rdd.getNumPartitions() >= 8 and out.count() == 64
