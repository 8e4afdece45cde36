"""Archives written and read back, against a plain reading of the same rule."""

import base64
import gzip
import hashlib
from collections import Counter

import pytest

from lakeload.llm import warc

SCHEMA = "page_id long, url string, html string"
NAMES = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def brute(rows):
    by_payload = {}
    for page_id, url, html in rows:
        by_payload.setdefault(html or "", []).append((page_id is not None, page_id, url is not None, url))
    out = Counter()
    for html, members in by_payload.items():
        raw = html.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        members.sort(key=lambda m: (m[0], m[1] or 0, m[2], m[3] or ""))
        top = members.pop()[1]
        out[(top, len(raw), digest, "response", None)] += 1
        for m in members:
            out[(m[1], len(raw), digest, "revisit", top)] += 1
    return out


def got(frame):
    return Counter(tuple(r[n] for n in NAMES) for r in frame.collect())


@pytest.fixture
def round_trip(spark, given, tmp_path):
    def run(pages, **settings):
        path = str(tmp_path / f"archive-{len(list(tmp_path.iterdir()))}")
        warc.write_archives(pages, path, **settings)
        return warc.captures(warc.read_records(spark, path)), path

    return run


def test_given_pages(given, round_trip):
    pages = given("pages")
    found, _ = round_trip(pages)
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert got(warc.page_captures(found)) == brute(rows)
    nested = found.where("type = 'response'").collect()
    html = {r[0]: r[2] for r in rows}
    for r in nested:
        assert r.main.whole and r.main.declared_digest == r.main.payload_digest
        assert len(r.requests) == len(r.metadata) == 1
        assert bytes(r.main.payload).decode() == html[int(r.metadata[0].fields[0].value)]
        assert r.requests[0].http_head.startswith("GET /")


LONG = "<p>tall tree</p>" * 100_000
AWKWARD = [
    (1, "http://a.example/x", "<p>one</p>"),
    (2, "http://a.example/y z\r\nWARC-Type: x", "<p>one</p>"),
    (2, "http://a.example/y z\r\nWARC-Type: x", "<p>one</p>"),
    (3, None, None),
    (4, "", ""),
    (None, "é", "<p>one</p>"),
    (None, None, LONG),
    (5, "x", LONG),
    (6, "no scheme", "é ß 漢字 🙂 \u0000 \r\n\r\n tail \r\n\r\n"),
    (7, "x", "before\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nafter"),
    (8, "x", "WARC/1.0\r\n\r\nWARC/1.1\r\n\r\nWARC/1."),
    (9, "x", "WARC/1. WARC/1.0WARC/1.\r\n\r\nWARC/"),
    (12, "x", "a\nWARC/1.0\nWARC/1.\nWARC/1.x WARC/1."),
    (10, "x", "\r\n\r\n"),
    (11, "x", "\r\n"),
]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_awkward_rows(spark, round_trip, compression):
    pages = spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)
    for name in ("content", "copy", "rows", "value", "top", "sha1", "size", "type", "record_id"):
        pages = pages.selectExpr("*", f"'x' AS {name}")
    found, path = round_trip(pages, compression=compression)
    assert got(warc.page_captures(found)) == brute(AWKWARD)
    payloads = Counter(bytes(r.main.payload).decode() for r in found.where("type = 'response'").collect())
    assert payloads == Counter({h or "" for _, _, h in AWKWARD})
    # Reading the archives twice gives each capture once.
    twice = warc.read_records(spark, path)
    assert warc.captures(twice.unionAll(twice)).count() == len(AWKWARD)


def test_no_rows(spark, round_trip):
    found, _ = round_trip(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and warc.page_captures(found).count() == 0


def test_many_equal_rows(spark, round_trip, monkeypatch):
    monkeypatch.setattr(warc, "COPIES_AT_ONCE", 10)
    rows = [(None, None, "<p>same</p>")] * 333 + [(7, "u", "<p>same</p>")] * 25
    found, _ = round_trip(spark.createDataFrame(rows, SCHEMA))
    assert got(warc.page_captures(found)) == brute(rows)


def test_a_small_split_size_gives_the_same(spark, round_trip):
    rows = [(i, f"http://h/{i}", f"<p>{i % 40}</p>" * (i + 1)) for i in range(200)]
    found, path = round_trip(spark.createDataFrame(rows, SCHEMA).repartition(2), compression="none")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    whole = Counter(r.record_id for r in warc.read_records(spark, path).where("whole").collect())
    try:
        for size in (700, 1009, 4096, 5003):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            assert Counter(r.record_id for r in warc.read_records(spark, path).where("whole").collect()) == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(whole) == 600 and got(warc.page_captures(found)) == brute(rows)


def record(kind, name, block, *more):
    head = [f"WARC-Type: {kind}", f"warc-record-id: <{name}>", f"Content-Length: {len(block)}", *more]
    return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, given, tmp_path):
    http = "Content-Type: application/http; msgtype=response"
    parts = [
        record("warcinfo", "info", b"software: x\r\n"),
        # The response names the request, and the metadata names the request.
        record("response", "r1", b"HTTP/1.1 200 OK\r\n\r\nbody \xff", http, "WARC-Concurrent-To: <q1>"),
        record("request", "q1", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http"),
        record("metadata", "m1", b"a: b\r\nc: d:e\r\n", "WARC-Concurrent-To: <q1>"),
        record("resource", "r2", b"plain"),
        record("metadata", "m2", b"", "WARC-Concurrent-To: <nowhere>"),
        record("response", "r3", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=1\r\nabc\r\n2\r\nde\r\n0\r\n\r\n", http),
    ]
    # A gzip stream for each record, as most writers have it.
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    found = {r.capture_id: r for r in warc.captures(warc.read_records(spark, str(tmp_path / "a.warc.gz"))).collect()}
    assert set(found) == {"<r1>", "<r2>", "<r3>", "<m2>"}
    first = found["<r1>"]
    assert bytes(first.main.payload) == b"body \xff" and [q.record_id for q in first.requests] == ["<q1>"]
    assert [(f.name, f.value) for f in first.metadata[0].fields] == [("a", "b"), ("c", "d:e")]
    assert bytes(found["<r2>"].main.payload) == b"plain" and found["<r2>"].requests == []
    assert bytes(found["<r3>"].main.payload) == b"abcde"
    assert found["<m2>"].main is None and found["<m2>"].metadata[0].record_id == "<m2>"


def test_archives_are_compressed_fast(spark, tmp_path):
    pages = spark.range(400).selectExpr(
        "id AS page_id", "concat('http://h/', id) AS url", "repeat(concat(sha1(string(id)), ' of a page '), 20) AS html"
    )
    path = str(tmp_path / "fast")
    warc.write_archives(pages.coalesce(1), path)
    for file in (tmp_path / "fast").glob("*.gz"):
        packed = file.read_bytes()
        text = gzip.decompress(packed)
        fast, usual = (len(gzip.compress(text, level)) for level in (1, 6))
        assert not text or abs(len(packed) - fast) < abs(len(packed) - usual)
