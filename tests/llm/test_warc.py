import gzip
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from loomgraph.llm import warc_revisits as W

SCHEMA = "record_id string, url string, ts long, kind string, status int, headers map<string,string>, digest string, slice int"


def brute(rows):
    full = [r for r in rows if r[3] == "response" and r[4] == 200 and None not in r[:3] and "content-range" not in (r[5] or {})]
    out = []
    for r in (r for r in rows if r[3] == "revisit"):
        base = max((b for b in full if b[1] == r[1] and r[2] is not None and b[2] < r[2]), key=lambda b: (b[2], b[0]), default=None) if r[0] and r[1] else None
        h = r[5] or {}
        if base is None:
            out.append((r[0], None, "no_base", tuple(sorted(h.items()))))
            continue
        weak = lambda t: t and t.removeprefix("W/")
        had = base[5] or {}
        pairs = [(weak(had.get("etag")), weak(h.get("etag"))), (had.get("last-modified"), h.get("last-modified")), (base[6], r[6])]
        same = [a == b for a, b in pairs if a is not None and b is not None]
        state = "mismatch" if False in same else "resolved" if same else "unverified"
        merged = had | {k: v for k, v in h.items() if k not in W.FIXED_HEADERS} if state != "mismatch" else h
        out.append((r[0], base[0], state, tuple(sorted(merged.items()))))
    return sorted(map(str, out))


@pytest.mark.parametrize("rows_in_slice", [20_000, 3])
def test_equals_brute_force(spark, monkeypatch, rows_in_slice):
    monkeypatch.setattr(W, "SLICE_ROWS", rows_in_slice)
    rng, rows = random.Random(4), []
    for i in range(300):
        headers = {k: rng.choice("ab") for k in ("etag", "last-modified", "content-length", "x") if rng.random() < 0.5}
        if rng.random() < 0.1:
            headers["content-range"] = "1"
        if headers.get("etag") and rng.random() < 0.3:
            headers["etag"] = "W/" + headers["etag"]
        kind = rng.choice(["response", "revisit", "revisit"])
        rows.append((f"id{i:03d}" if rng.random() < 0.95 else None, rng.choice(["http://a/", "http://b/", None, "http://a/"]), rng.choice([None, *range(40)]), kind, rng.choice([200, 200, 206, None]), headers if rng.random() < 0.9 else None, rng.choice([None, None, "d", "e"]), 1))
    got = W.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str((r.record_id, r.base_id, r.state, tuple(sorted(r.headers.items())))) for r in got) == brute(rows)


def test_identical_payloads_keep_their_headers(spark):
    same = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    not_modified = "http://netpreserve.org/warc/1.1/revisit/server-not-modified"
    rows = [("b", "http://a/", 1, "response", 200, {"etag": "x", "a": "1"}, "d", None), ("r1", "http://a/", 5, "revisit", 200, {"etag": "y"}, "d", same), ("r2", "http://a/", 6, "revisit", 304, {"date": "t"}, "d", not_modified), ("r3", "http://n/", 6, "revisit", 200, {"q": "z"}, "d", same)]
    got = {r.record_id: (r.base_id, r.state, r.headers) for r in W.resolve_revisits(spark.createDataFrame(rows, SCHEMA.replace("slice int", "profile string"))).collect()}
    assert got == {"r1": ("b", "identical_payload", {"etag": "y"}), "r2": ("b", "resolved", {"etag": "x", "a": "1", "date": "t"}), "r3": (None, "no_base", {"q": "z"})}


def test_a_wrong_clock_does_not_widen_the_slices(spark, monkeypatch):
    monkeypatch.setattr(W, "SLICE_ROWS", 50)
    rows = [(f"b{i}", "http://a/", i, "response", 200, {}, None, 1) for i in range(400)] + [(f"r{i}", "http://a/", i, "revisit", 304, {}, None, 1) for i in range(0, 400, 7)] + [("far", "http://a/", 10**15, "response", 200, {}, None, 1), ("late", "http://a/", 10**15 + 1, "revisit", 304, {}, None, 1)]
    got = W.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str((r.record_id, r.base_id, r.state, tuple(sorted(r.headers.items())))) for r in got) == brute(rows)


def test_records_of_many_pieces():
    blocks = [b"x" * n for n in (0, 1, (1 << 20) - 1, 3 << 20, 5)]
    data = [warc("response", f"<{i}>", "http://a", "2020-01-01T00:00:00Z", b) for i, b in enumerate(blocks)]
    for whole in (b"".join(data), b"".join(map(gzip.compress, data)), gzip.compress(b"".join(data))):
        assert [r["block"] for r in W.parse_warc(whole)] == blocks
    with pytest.raises(ValueError):
        list(W.parse_warc(gzip.compress(b"".join(data))[:-30]))


def test_empty(spark):
    assert W.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_canonical_urls(spark):
    cases = {
        "HTTP://Ex.ORG:80/a?b=2&a=1#f": "http://ex.org/a?a=1&b=2", "https://x.org": "https://x.org/", "https://x.org:443?": "https://x.org/", " ftp://Y/ ": "ftp://Y/", "http://x.org:8080/A%2f": "http://x.org:8080/A%2f", None: None, "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    assert {r.u: r.k for r in df.withColumn("k", W.canonical_url(F.col("u"))).collect()} == cases


def test_query_equals_sql(spark, small):
    got = W.shown(W.resolve_revisits(W.captures(spark.read.parquet(f"{small}/pages.parquet")))).toPandas()
    con = duckdb.connect()
    con.sql(f"create view pages as from '{small}/pages.parquet'")
    want = con.sql(W.oracle()).df()
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda d: sorted(map(str, d[sorted(d.columns)].astype(object).where(d[sorted(d.columns)].notna(), None).itertuples(index=False)))
    norm = lambda rows: [x.replace(".0", "") for x in rows]
    assert norm(key(got)) == norm(key(want))
    assert set(got.state) >= {"resolved", "no_base"}


def warc(kind, ident, url, date, block):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {ident}\r\nWARC-Target-URI: {url}\r\nWARC-Date: {date}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def test_files(spark, tmp_path):
    one = warc("warcinfo", "<0>", "", "2020-01-01T00:00:00Z", b"software: x")
    two = warc("response", "<1>", "http://X.org", "2020-01-01T00:00:00Z", b"HTTP/1.1 200 OK\r\nETag: \"a\"\r\nContent-Type: text/html\r\n\r\n<p>\r\n\r\nhi")
    three = warc("revisit", "<2>", "http://x.org/", "2020-01-02T00:00:00Z", b"HTTP/1.1 304 Not Modified\r\nETag: W/\"a\"\r\nDate: d\r\n\r\n")
    (tmp_path / "a.warc").write_bytes(one + two)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(three))
    records = W.read_warc(spark, str(tmp_path))
    assert {r.record_id: r.payload for r in records.collect()} == {"<1>": b"<p>\r\n\r\nhi", "<2>": b""}
    got = W.resolve_revisits(records).collect()
    assert [(r.record_id, r.base_id, r.state, r.headers) for r in got] == [("<2>", "<1>", "resolved", {"etag": 'W/"a"', "content-type": "text/html", "date": "d"})]
    with pytest.raises(ValueError):
        list(W.parse_warc(two[:-20]))
