import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from meridian.llm import archives, queries

SF = "/root/testdata/sf0.001"
V1 = b"filedesc://a.arc 0.0.0.0 19960923142103 text/plain 76\n1 0 Old Crawl\nURL IP-address Archive-date Content-type Archive-length\n"
V2_BODY = b"2 0 Crawl\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
V2 = b"filedesc://b.arc 0.0.0.0 20040102 text/plain 200 - - 0 b.arc %d\n%s" % (len(V2_BODY), V2_BODY)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def by_hand(pages: list[tuple], least: int) -> list[tuple]:
    """What the query has to say of (page_id, html) rows, ids all different."""
    out = []
    for page_id, html in pages:
        payload = (html or "").encode()
        same = [p for p, h in pages if (h or "").encode() == payload] if len(payload) >= least else [page_id]
        first = min(same)
        out.append((page_id, len(payload), digest(payload), "response" if first == page_id else "revisit", None if first == page_id else first))
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


def test_the_query_against_a_version_by_hand(spark):
    pages = [(r.page_id, r.html) for r in queries.read_table(spark, SF, "pages").collect()]
    assert rows(queries.op13_archives(spark, SF)) == by_hand(pages, 0)


ODD = [
    (5, "http://a/1", "same"), (3, "http://a/2", "same"), (9, None, "same"), (1, "http://a/ b\n", None), (2, "", ""), (4, "http://b", "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\n"),
    (6, "http://c", "\r\n\r\n"), (7, "http://d", "é漢\u0000"), (8, "http://e", "HTTP/1.1 200 OK\r\n\r\nx"), (10, "http://f", "y" * 500_000), (11, "http://f", "y" * 500_000), (-12, "u", "X-Page-Id: 3"),
]


@pytest.mark.parametrize("least", [0, 1, 5])
def test_odd_rows(spark, tmp_path, least):
    pages = spark.createDataFrame(ODD, "page_id long, url string, html string").repartition(3).withColumns({k: F.lit(1) for k in ("doc", "ip", "fault", "value")})
    assert rows(archives.pages_archived(pages, f"file://{tmp_path}", least)) == by_hand([(p, h) for p, _, h in ODD], least)
    heads = {gzip.open(f).read(2000).split(b"\n")[1][:1] for f in Path(tmp_path, "arc").glob("*.gz")}
    assert heads == {b"1", b"2"}


def test_nulls_and_repeated_ids(spark, tmp_path):
    pages = spark.createDataFrame([(None, "a", "x"), (3, "a", "x"), (3, "a", "x"), (None, "b", "z"), (None, None, None)], "page_id long, url string, html string")
    got = [tuple(r)[:2] + tuple(r)[3:] for r in archives.pages_archived(pages, f"file://{tmp_path}").collect()]
    assert sorted(got, key=str) == sorted([(3, 1, "response", None), (3, 1, "revisit", 3), (None, 1, "revisit", 3), (None, 1, "response", None), (None, 0, "response", None)], key=str)
    assert archives.pages_archived(pages.limit(0), f"file://{tmp_path}/none").count() == 0


def v2(url: bytes, doc: bytes, mime: bytes = b"text/html") -> bytes:
    return b"\n%s 10.0.0.1 20040102030405 %s 200 - - 99 b.arc %d\n%s" % (url, mime, len(doc), doc)


def test_old_archives(spark, tmp_path):
    """Both versions, blanks in URLs and types, heads of either line end, records that aren't HTTP, gzip by record or none, raw bytes."""
    doc = b"HTTP/1.0 200 OK\nX-Page-Id: 7\n\n\xff\x00raw"
    first = V1.replace(b" 76\n", b" %d\n" % (len(V1) - V1.index(b"\n") - 1))
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc/a.arc").write_bytes(first + b"\nhttp://x/a b 10.0.0.1 1996092314 text/html; charset=x 35\n" + doc + b"\n\ndns:x 10.0.0.2 19960923142103 text/dns 4\nabcd\n")
    assert len(doc) == 35
    (tmp_path / "arc/b.arc.gz").write_bytes(gzip.compress(V2) + gzip.compress(v2(b"http://y", b"HTTP/1.1 200 OK\r\nX-Page-Id: 2\r\nContent-Length: 5\r\n\r\n\xff\x00raw")) + gzip.compress(v2(b"http://z", b"")))
    spark_folder = f"file://{tmp_path}"
    got = {r.url: r for r in archives.read_arc(spark, f"{spark_folder}/arc", False).collect()}
    assert set(got) == {"http://x/a b", "dns:x", "http://y", "http://z"} and not any(r.fault for r in got.values())
    a = got["http://x/a b"]
    assert (a.date, a.mime, a.ip, a.page_id, a.n_bytes, a.payload_digest) == ("1996-09-23T14:00:00Z", "text/html; charset=x", "10.0.0.1", 7, 5, digest(b"\xff\x00raw"))
    archives.convert(spark, f"{spark_folder}/arc", f"{spark_folder}/warc")
    out = {r.url: r for r in archives.read_warc(spark, f"{spark_folder}/warc").collect()}
    assert {u: r.record_type for u, r in out.items()} == {"http://x/a b": "revisit", "dns:x": "resource", "http://y": "response", "http://z": "resource"}
    assert all(r.intact and not r.fault for r in out.values()) and {u: r.record_id for u, r in out.items()} == {u: r.record_id for u, r in got.items()}
    assert out["http://x/a b"].refers_to == got["http://y"].record_id and out["http://x/a b"].payload_digest == digest(b"\xff\x00raw")
    assert out["dns:x"].payload_bytes == 4


@pytest.mark.parametrize(
    "content, before, fault",
    [
        (b"", 0, None),
        (b"hello", 0, "no version block"),
        (V2, 0, None),
        (V2.replace(b"\n2 0", b"\n3 0"), 0, "version"),
        (V2 + v2(b"u", b"abc")[:-1], 0, "declared"),
        (V2 + v2(b"u", b"abc") + b"\nnot a header\n", 1, "header line"),
        (gzip.compress(V2 + v2(b"u", b"abc") * 2)[:-9], None, "stream|end|CRC"),
        (gzip.compress(V2 + v2(b"u", b"abc")) + b"garbage", None, "gzip"),
    ],
)
def test_broken_archives(spark, tmp_path, content, before, fault):
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc/x.arc").write_bytes(content)
    got = archives.read_arc(spark, f"file://{tmp_path}/arc", True).collect()
    faults = [r.fault for r in got if r.fault]
    assert len(faults) == (fault is not None) and (before is None or len(got) - len(faults) == before)
    if fault:
        import re

        assert re.search(fault, faults[0])
    archives.convert(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc")
    assert archives.read_warc(spark, f"file://{tmp_path}/warc").count() == len(got) - len(faults)


def test_a_warc_of_others(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\n\r\nhi"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nwarc-target-uri: http://q\r\nX-Long: a\r\n b\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(block), block)
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record.replace(b"Content-Length", b"Length")))
    good, bad = archives.read_warc(spark, f"file://{tmp_path}").orderBy("fault").collect()
    assert (good.url, good.payload_bytes, good.payload_digest, good.intact) == ("http://q", 2, digest(b"hi"), False) and "length" in bad.fault
