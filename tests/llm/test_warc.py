import gzip
import hashlib

import pytest

from tidelane.llm import warc as module
from tidelane.llm.common import shared_path
from tidelane.llm.warc import dechunked, parsed, read_pages, read_records, reassembled, resolved, with_payloads, write_pages

SCHEMA = "page_id long, url string, html string, digest string"


def test_round_trip_with_segments_and_revisits(spark):
    big = "é<p>" * 20_000
    trap = "WARC/1.1\r\n\r\nWARC-Type: response\r\n0\r\n\r\n" * 40
    html = {1: "a" * 999, 2: "a" * 999, 3: big, 4: big, 9: big, 5: trap, 6: trap, 7: None, 8: "", 10: "é" * 500, 11: "é" * 500, 12: "x" * 8192, 13: "x" * 8193}
    rows = [(k, f"http://h/{k}\r\nX: y" if k % 2 else None, v, "mine") for k, v in html.items()] + [(None, None, big, ""), (3, None, big, "")]
    path = shared_path(spark, "warc-test")
    write_pages(spark.createDataFrame(rows, SCHEMA), path, segment_bytes=1000, records_per_file=7)
    assert read_records(spark, path).filter("type = 'continuation'").count() > 50
    read = read_pages(spark, path)
    assert all(bytes(r.payload) == (html[r.page_id] or "").encode() for r in read.filter("type = 'response'").collect())
    got = sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.intact) for r in resolved(read).collect())
    last = {3: 9, 4: 9, 5: 6, 10: 11, None: 9}
    wanted = []
    for k, _, v, _ in rows:
        data = (v or "").encode()
        wanted.append((k or -1, len(data), hashlib.sha1(data).hexdigest(), "revisit" if k in last else "response", last.get(k), True))
    assert got == sorted(wanted, key=str) or got == sorted(wanted)


def test_segments_out_of_order_missing_or_repeated(spark):
    schema = module._RECORD
    part = lambda origin, n, block, total=None, kind="continuation": (kind, f"{origin}" if n == 1 else f"{origin}-{n}", None, None, None, None, None if n == 1 else origin, n, total, bytearray(block))
    rows = [
        part("a", 3, b"c", 3), part("a", 1, b"a", None, "response"), part("a", 2, b"b"), part("b", 1, b"a", None, "response"), part("b", 3, b"c", 2),
        part("c", 1, b"a", None, "response"), part("c", 2, b"b", 5), part("d", 1, b"a", None, "response"), part("d", 2, b"b", 2),
        part("d", 1, b"a", None, "response"), part("d", 2, b"b", 2), part("e", 2, b"z", 1),
    ]
    got = sorted((r.record_id or "", r.complete, r.block and bytes(r.block)) for r in reassembled(spark.createDataFrame(rows, schema)).collect())
    assert got == [("", False, None), ("a", True, b"abc"), ("b", False, None), ("c", False, None), ("d", True, b"ab"), ("d", True, b"ab")]


def test_framing_and_parsing():
    assert dechunked(b"3;x=1\r\nabc\r\nA\r\n0123456789\r\n0\r\nT: 1\r\n\r\n") == b"abc0123456789"
    with pytest.raises(ValueError):
        dechunked(b"5\r\nabc\r\n0\r\n\r\n")
    record = b"WARC/1.0\r\nContent-Length: 3\r\nWARC-Type: x\r\n\r\nabc\r\n\r\n"
    for data in (record * 2, gzip.compress(record) + gzip.compress(record)):
        assert [b for _, b in parsed(data)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(parsed(record[:-3]))


def test_plain_framing_and_empty(spark):
    rows = [("response", "r", None, 1, None, None, True, bytearray(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody")), ("response", "s", None, 2, None, None, False, None)]
    frame = spark.createDataFrame(rows, "type string, record_id string, uri string, page_id long, digest string, refers_to string, complete boolean, block binary")
    assert [r.payload and bytes(r.payload) for r in with_payloads(frame).sort("page_id").collect()] == [b"body", None]
    path = shared_path(spark, "warc-empty")
    write_pages(spark.createDataFrame([], SCHEMA), path)
    assert resolved(read_pages(spark, path)).collect() == []
