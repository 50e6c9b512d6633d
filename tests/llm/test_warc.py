"""Archives: exact round trips, segments, broken records."""

from __future__ import annotations

import hashlib
import random

from adsettle.llm import warc as W

SF = "/root/testdata/sf0.001"


def test_chunks_and_segments():
    draw = random.Random(1)
    mark = (W.ENDS + W.VERSION).encode()
    for _ in range(300):
        payload = b"".join(draw.choice([b"a", b"\r\n", mark, W.VERSION.encode(), b"0\r\n\r\n"]) for _ in range(draw.randrange(60)))
        framed = W.chunk(payload, draw.choice([1, 7, 50, 1000]))
        assert W.unchunk(framed) == payload and mark not in framed
        pieces = W.cut(framed, draw.choice([1, 10, 64]))
        assert b"".join(pieces) == framed
        assert not any(p.startswith(W.VERSION.encode()) for p in pieces[1:])
    assert W.unchunk(b"5\r\nab\r\n0\r\n\r\n") is None and W.unchunk(b"zz\r\n") is None
    assert W.unchunk(b"2;x=y\r\nab\r\n0\r\n\r\n") == b"ab"


def rows_of(pages, least=W.LEAST_BYTES):
    best: dict = {}
    for p in pages:
        body = (p["html"] or "").encode()
        if len(body) >= least and p["page_id"] is not None:
            best[body] = max(best.get(body, p["page_id"]), p["page_id"])
    out = []
    for p in pages:
        body = (p["html"] or "").encode()
        first = best.get(body)
        refers = first if first is not None and first != p["page_id"] else None
        out.append((p["page_id"], len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def found(df):
    return sorted(
        ((r.page_id, r.payload_bytes, r.digest, r.record_type, r.refers_to) for r in df.collect()), key=str
    )


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = W.archive(pages)
    assert found(out) == rows_of([r.asDict() for r in pages.collect()])
    assert out.filter("NOT sound").isEmpty()
    bodies = {r.page_id: bytes(r.payload).decode() for r in out.filter("record_type = 'response'").collect()}
    assert bodies == {r.page_id: r.html for r in pages.collect() if r.page_id in bodies}


def test_odd_rows_and_small_segments(spark):
    """Nulls, copies, repeated rows, separators and versions inside, long pages, clashing columns."""
    long = "x" * 3000
    trap = "<p>" + W.ENDS + W.VERSION + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc" + W.ENDS + W.VERSION
    rows = [
        (1, "http://a/", long, "t"), (2, "http://a/\r\nX: y", long, "t"), (2, "http://a/\r\nX: y", long, "t"),
        (None, None, long, "t"), (3, "http://b/", None, "t"), (4, "http://b/", "", "t"), (5, None, trap * 40, "t"),
        (6, "u", "é ü 日本 " * 2000, "t"), (7, "http://c/WARC/1.1", W.VERSION * 400, "t"), (8, "u", "short", "t"), (9, "u", "short", "t"),
        (None, "u", "z" * 2000, "t"), (None, "u", "z" * 2000, "t"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, type string").repartition(3)
    for most in (64, 1000, W.SEGMENT):
        out = W.archive(pages, most=most)
        assert found(out) == rows_of([dict(zip(("page_id", "url", "html"), r)) for r in rows]), most
        assert out.filter("NOT sound").isEmpty()
        got = {r.page_id: bytes(r.payload).decode() for r in out.filter("payload IS NOT NULL AND page_id >= 5").collect()}
        assert got == {r[0]: r[2] for r in rows if (r[0] or 0) >= 5}


def test_split_files(spark):
    """A file read in many splits gives the same records."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").coalesce(1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert found(W.archive(pages, most=700)) == rows_of([r.asDict() for r in pages.collect()])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_ends_at_buffer_ends(spark):
    """Records end in line ends before the separator; wherever the reader's buffer ends, none is missed."""
    rows = [(i, "http://a/", "y" * (61_000 + i)) for i in range(4500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    out = W.archive(pages, most=10**6)
    assert out.count() == len(rows) and out.filter("NOT sound").isEmpty()


def test_missing_segment(spark, tmp_path):
    """A record that lacks a segment, or holds less than it says, isn't sound."""
    row = {"payload": b"y" * 500, "refers_to": None, "uuid": "1", "url": "u", "date": "d", "digest": hashlib.sha1(b"y" * 500).hexdigest(), "payload_bytes": 500, "page_id": 1}
    parts = list(W.records(row, 100))
    end = W.ENDS.encode()
    (tmp_path / "a.warc").write_bytes(end.join([parts[0], *parts[2:], b""]))
    assert [r.sound for r in W.read_warc(spark, str(tmp_path)).collect()] == [False]
    (tmp_path / "a.warc").write_bytes(end.join([*reversed(parts), b""]))
    assert [r.sound for r in W.read_warc(spark, str(tmp_path)).collect()] == [True]
    (tmp_path / "a.warc").write_bytes(next(iter(W.records(row)))[:-50] + end)
    assert [r.sound for r in W.read_warc(spark, str(tmp_path)).collect()] == [False]


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.archive(pages).collect() == []
