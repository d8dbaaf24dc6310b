"""WARC archives: exact round trip, deduplication, pushdown and foreign files."""

import base64
import gzip
import hashlib
import os

from larch.llm import queries, warc
from larch.llm.common import scratch_dir

SF = "/root/testdata/sf0.01"


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, least=0):
    keep = {}
    for r in rows:
        p = (r.html or "").encode()
        if r.page_id is not None:
            keep[p] = max(keep.get(p, r.page_id), r.page_id)
    out = []
    for r in rows:
        p = (r.html or "").encode()
        old = len(p) >= least and r.page_id is not None and r.page_id < keep[p]
        out.append((r.page_id, len(p), b32(p), "revisit" if old else "response", keep[p] if old else None))
    return sorted(out, key=str)


def test_query_round_trip(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = sorted((tuple(r) for r in queries.QUERIES["op9_warc"](spark, SF).collect()), key=str)
    assert got == expected(pages)


def test_odd_rows(spark):
    rows = [(1, "http://a/x", "same", 0), (2, "http://a/ü \r\nWARC-Type: x", "same", 0), (3, None, None, 0),
            (4, "", "", 0), (None, "http://b/", "same", 0), (5, "http://c/", "é" * 300000, 0),
            (5, "http://c/", "é" * 300000, 0), (6, "http://d/", "\r\n\r\nWARC/1.1\r\n", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest long")
    for least in (0, 3):
        path = scratch_dir(spark, "warc")
        warc.write_archive(df, path, least_bytes=least)
        got = sorted((tuple(r) for r in warc.page_records(spark, path).collect()), key=str)
        assert got == expected(df.collect(), least)
        back = warc.read_archive(spark, path).where("record_type = 'response'").collect()
        assert all(b32(bytes(r.payload)) == r.payload_digest for r in back)
    path = scratch_dir(spark, "warc")
    warc.write_archive(df.limit(0), path)
    assert warc.page_records(spark, path).count() == 0


def test_any_gzip_reader_sees_the_records(spark):
    path = scratch_dir(spark, "warc")
    warc.write_archive(spark.createDataFrame([(1, "http://a/", "hello")], "page_id long, url string, html string"), path)
    root = warc.file_system(path)[1]
    [name] = [f for f in os.listdir(root) if f.endswith(".gz")]
    text = gzip.open(f"{root}/{name}").read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response") and text.endswith(b"hello\r\n\r\n")


def test_foreign_archives_and_pushdown(spark, tmp_dir):
    record = lambda kind, body: (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{kind}>\r\nContent-Type: text/plain\r\n"
        f"X-Folded: a\r\n b\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
    data = [record("warcinfo", b"software: x"), record("resource", b"\x00" * 100000), record("metadata", b"k: v")]
    with open(f"{tmp_dir}/a.warc", "wb") as f:
        f.write(b"".join(data))
    with open(f"{tmp_dir}/b.warc.gz", "wb") as f:
        f.write(b"".join(map(gzip.compress, data)))
    df = warc.read_archive(spark, tmp_dir)
    assert df.count() == 6
    some = df.where("record_type in ('metadata', 'resource') and record_id like 'urn:x:m%'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter " not in plan  # every test went to the reader
    assert [(bytes(r.payload), r.headers["X-Folded"], r.payload_bytes) for r in some.collect()] == [
        (b"k: v", "a b", 4)] * 2


def test_skipped_payloads_are_not_inflated(spark, monkeypatch):
    import io
    big = b"".join(warc.record_bytes(f"urn:x-page:{i}", "http://a/", b32(b"x" * 1000), b"x" * 1000, None)
                   for i in range(20))
    inflated = []
    plain = warc.zlib.decompress
    monkeypatch.setattr(warc.zlib, "decompress", lambda d, w: inflated.append(1) or plain(d, w))
    rows = list(warc.records(warc.open_stream(io.BytesIO(big), len(big)),
                             lambda r: r["record_id"].endswith(":7"), True))
    assert len(rows) == 1 and rows[0]["payload"] == b"x" * 1000
    assert len(inflated) == 21  # twenty headers, one payload
