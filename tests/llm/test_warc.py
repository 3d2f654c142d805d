"""WARC archives: written, read back, filtered, and files of other makers."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import catalog, warc

SF = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string, first string, payload int, id string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows], PAGES)


def expected(rows, min_bytes=0):
    """{page_id: (bytes, digest, type, refers_to)} by a dictionary of payloads."""
    first = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= min_bytes:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        other = first.get(html or "", i)
        out.append((i, len(raw), digest, "response" if other == i else "revisit", None if other == i else other))
    return sorted(out, key=str)


def test_query_on_given_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = catalog.QUERIES["op12_warc"](spark, SF).collect()
    assert sorted(map(tuple, found), key=str) == expected([tuple(r) for r in rows])


ODD = [
    (1, "http://a.example/1", "same"), (2, "http://a.example/2 with space\r\nWARC-Type: x", "same"), (0, None, "same"), (3, "http://ü.example/€", None),
    (4, "", ""), (5, "u", "x" * 3_000_000), (6, "u", "x" * 3_000_000), (7, "u", "a\r\n\r\nWARC/1.1\r\n\r\n"), (8, "u", "ü€😀\0\x1f\x8b"),
    (None, "u", "only with a null id"), (None, "u", "same"), (9, "u", "twice"), (9, "u", "twice"), (-4, "u", "Same"),
]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_odd_rows(spark, tmp_path, min_bytes):
    warc.archive(pages(spark, ODD).repartition(3), str(tmp_path), min_bytes=min_bytes)
    found = warc.digest(warc.read(spark, str(tmp_path)))
    assert sorted(map(tuple, found.collect()), key=str) == expected(ODD, min_bytes)
    texts = {r.record_id: r.payload.decode() for r in warc.read(spark, str(tmp_path)).where("record_type = 'response'").collect()}
    assert texts["urn:x-page:8"] == "ü€😀\0\x1f\x8b" and texts["urn:x-page:7"] == "a\r\n\r\nWARC/1.1\r\n\r\n"
    assert len(texts["urn:x-page:5"]) == 3_000_000
    uris = {r.record_id: r.target_uri for r in warc.read(spark, str(tmp_path), payload=False).collect()}
    assert uris["urn:x-page:3"] == "http://ü.example/€" and uris["urn:x-page:2"] == "http://a.example/2%20with%20space%0D%0AWARC-Type:%20x"
    assert uris["urn:x-page:0"] is None


def test_empty_table(spark, tmp_path):
    warc.archive(pages(spark, []), str(tmp_path))
    assert warc.digest(warc.read(spark, str(tmp_path))).collect() == []


def test_filters_are_pushed_and_payloads_left_alone(spark, tmp_path):
    warc.archive(pages(spark, [(i, f"http://h{i % 3}.example/{i}", "v" * (i % 7)) for i in range(60)]), str(tmp_path))
    everything = warc.read(spark, str(tmp_path))
    chosen = everything.where((F.col("record_type") == "response") & F.col("target_uri").startswith("http://h1.") & ~F.col("record_id").isin("urn:x-page:1"))
    text = chosen._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in text and "Filter (" not in text
    want = [r for r in everything.collect() if r.record_type == "response" and r.target_uri.startswith("http://h1.") and r.record_id != "urn:x-page:1"]
    assert sorted(chosen.collect()) == sorted(want) and want
    kept = everything.where("payload_bytes > 3 and record_type <> 'warcinfo'").count()
    assert kept == sum(i % 7 > 3 for i in range(60))
    # A refused record is not inflated behind its headers.
    reader = warc.ArchiveReader(everything.schema, {"path": str(tmp_path)})
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "response"), warc.EqualTo(("file",), "x")])) == [warc.EqualTo(("file",), "x")]
    big = warc.member(warc.page_record("urn:x-page:1", "u", None, b"z" * 5_000_000, b"\0" * 20, "2020"))
    (tmp_path / "one.warc.gz").write_bytes(big[: len(big) // 2] + b"\xff" * (len(big) - len(big) // 2) + warc.member(warc.page_record("b", "u", None, b"k", b"\0" * 20, "2020")))
    reader.tests = [warc.EqualTo(("record_id",), "b")]
    rows = [r for b in reader.read(warc.Files([str(tmp_path / "one.warc.gz")])) for r in b.to_pylist()]
    assert [(r["record_id"], r["payload"]) for r in rows] == [("b", b"k")]


def foreign():
    """Records as others write them: other versions, folded lines, no HTTP, small letters in names."""
    body = b"HTTP/1.1 404 Not Found\r\nServer: s\r\n\r\n<p>none</p>"
    first = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://x.example/\r\n\tfolded\r\n"
    first += b"Content-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    second = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Length: 3\r\n\r\n\0\xff\n\r\n\r\n"
    return [first, second, first.replace(b"uuid:1", b"uuid:3")]


def test_files_of_other_makers(spark, tmp_path):
    parts = foreign()
    (tmp_path / "a.warc").write_bytes(b"".join(parts))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    for name in ("a.warc", "b.warc.gz"):
        for payload in (True, False):
            rows = {r.record_id: r for r in warc.read(spark, str(tmp_path / name), payload).collect()}
            assert set(rows) == {"urn:uuid:1", "urn:uuid:2", "urn:uuid:3"}
            assert rows["urn:uuid:1"].target_uri == "http://x.example/ folded" and rows["urn:uuid:1"].http_headers == {"server": "s"}
            assert rows["urn:uuid:2"].payload == (b"\0\xff\n" if payload else None) and rows["urn:uuid:3"].payload_bytes == 11
    assert warc.read(spark, str(tmp_path)).where("record_type = 'resource'").count() == 2
    (tmp_path / "c.warc").write_bytes(b"not an archive\r\n\r\n")
    with pytest.raises(Exception, match="no WARC record"):
        warc.read(spark, str(tmp_path / "c.warc")).count()


def test_files_roll_and_only_committed_ones_count(spark, tmp_path):
    warc.register(spark)
    frame = warc.with_revisits(pages(spark, [(i, "u", f"{i} " * 2000) for i in range(40)]).coalesce(1), str(tmp_path / "scratch"))
    frame.write.format("warc").mode("append").option("fileBytes", 500).save(str(tmp_path / "w"))
    files = list((tmp_path / "w").glob("*.warc.gz"))
    assert len(files) > 3
    (tmp_path / "w" / "part-of-a-lost-task.warc.gz").write_bytes(b"half")
    assert warc.digest(warc.read(spark, str(tmp_path / "w"))).count() == 40
    reader = warc.ArchiveReader(warc.read(spark, str(tmp_path / "w")).schema, {"path": str(tmp_path / "w"), "partitionBytes": "1"})
    assert len(reader.partitions()) == len(files)
    frame.write.format("warc").mode("append").save(str(tmp_path / "w"))
    assert warc.digest(warc.read(spark, str(tmp_path / "w"))).count() == 80
    frame.write.format("warc").mode("overwrite").save(str(tmp_path / "w"))
    assert warc.digest(warc.read(spark, str(tmp_path / "w"))).count() == 40
