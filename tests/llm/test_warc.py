"""WARC archives: records, dictionaries, and the round trip through files."""

from __future__ import annotations

import hashlib
import io
import struct

import pytest
import zstandard
from pyarrow import fs

from sparge.llm import warc
from sparge.llm.queries import op9_warc


def archive_of(records, tmp_path, name="a.warc.zst"):
    out = warc.Archive(fs.LocalFileSystem(), str(tmp_path / name))
    for r in records:
        out.add(r)
    out.close()
    return (tmp_path / name).read_bytes()


@pytest.mark.parametrize("count", [1, 3, 400])
def test_records_are_frames_of_their_own(tmp_path, count):
    payloads = [(f"<html><body>{i} " + "some words " * (i % 50) + "</body></html>").encode() for i in range(count)]
    records = [warc.record(i, "http://x/é\r\ny", p, hashlib.sha1(p).hexdigest(), None, False) for i, p in enumerate(payloads)]
    data = archive_of(records, tmp_path)
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    found = list(warc.read_archive(io.BytesIO(data)))
    assert [b for _, b in found] == payloads and found[0][0]["WARC-Target-URI"] == "http://x/é%0D%0Ay"
    assert data[8 + size :].count(zstandard.FRAME_HEADER) >= count


def test_broken_archives_are_errors(tmp_path):
    p = b"x" * 5000
    data = archive_of([warc.record(1, None, p, hashlib.sha1(p).hexdigest(), None, False)], tmp_path)
    for cut in (4, 20, len(data) - 3):
        with pytest.raises(ValueError):
            list(warc.read_archive(io.BytesIO(data[:cut])))


def expected(pages):
    groups = {}
    for page, _, html in pages:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for page, _, html in pages:
        payload = (html or "").encode()
        best = max((p for p in groups[payload] if p is not None), default=None)
        revisit = len(payload) >= 1000 and best is not None and page != best and len(groups[payload]) > 1
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", best if revisit else None))
    return out


KEY = lambda r: (r[0] is None, r[0] or 0, r[2], r[3])


def test_query(spark, folder):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op9_warc(spark, folder).collect()]
    assert sorted(got, key=KEY) == sorted(expected(pages), key=KEY)


def test_edges_and_many_archives(spark):
    long, umlaut = "<p>" + "word " * 400, "ü" * 500
    pages = [(1, "http://a", long), (2, None, long), (3, "http://c", long), (None, "d", long), (4, "e", None), (5, "f", ""),
             (6, "g", umlaut), (7, "h", umlaut), (8, "i", "short"), (9, "j", "short"), (10, "k\r\nl: m", "x" * 3_000_000),
             (11, "n", "same id " * 200), (11, "n", "same id " * 200), (None, None, "no id " * 300), (None, None, "no id " * 300)]
    frame = spark.createDataFrame([(*p, "z", 1) for p in pages], "page_id long, url string, html string, digest string, revisit int")
    folder = warc.shared_uri(spark, "warc-test")
    archives = warc.write_archives(frame.repartition(3), folder, archive_bytes=1)
    assert archives.agg({"n_records": "sum"}).first()[0] == len(pages)
    found = warc.read_archives(archives, folder).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=KEY) == sorted(expected(pages), key=KEY)
    none = warc.write_archives(frame.limit(0), folder)
    assert warc.read_archives(none, folder).count() == 0


def test_archives_are_read_back_side_by_side(spark):
    """As many partitions as archives, though their names are short."""
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x" * 50 + str(i)) for i in range(40)], "page_id long, url string, html string")
    folder = warc.shared_uri(spark, "warc-many")
    archives = warc.write_archives(pages.repartition(10), folder, archive_bytes=1)
    number = archives.count()
    assert number > 4
    names = archives.select("archive").repartition(number, "archive")
    assert names.rdd.getNumPartitions() == number and warc.read_archives(archives, folder).count() == 40
