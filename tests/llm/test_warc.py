from __future__ import annotations

import gzip

import brute
import pyarrow.fs as pafs
import pytest
from helpers import LONG, SMALL, ordered, table
from pyspark.sql import functions as F

from wardbook.llm import queries, warc
from wardbook.llm.warc import WarcReader, base32_sha1, read_archives, record, write_pages

PAGES = [
    (1, "http://a/", "same"),
    (2, None, "same"),
    (None, "http://b/ c", "same"),
    (3, "http://c/", None),
    (4, "http://c/", ""),
    (5, "http://d/", "Äö\r\n\r\nWARC/1.1\r\n"),
    (6, "http://e/", LONG),
    (7, "http://f/", "repeated row"),
    (7, "http://f/", "repeated row"),
    (None, None, "without an id"),
    (None, "http://g/", "without an id"),
    (-3, "http://h/", "negative"),
]


def pages(spark, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "'x' AS payload", "'x' AS payload_digest", "0 AS refers_to", "1 AS n")


def test_query_equals_brute_force(spark):
    rows = table("pages", "page_id, html")
    assert ordered(queries.op3_warc(spark, SMALL).collect()) == ordered(brute.warc(rows))


@pytest.mark.parametrize("packed", [True, False])
def test_odd_pages_come_back(spark, tmp_path, packed):
    path = f"file://{tmp_path}/out"
    write_pages(pages(spark), path, gzip=packed)
    back = read_archives(spark, path, partitionBytes="1").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.regexp_extract("refers_to", r"page:(-?\d+)", 1).cast("long").alias("refers_to"), "payload"
    )
    rows = back.collect()
    assert ordered(r[:5] for r in rows) == ordered(brute.warc([(p, h) for p, _, h in PAGES]))
    assert {bytes(r.payload).decode() for r in rows if r.record_type == "response"} == {h or "" for _, _, h in PAGES}
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    assert not [f for f in (tmp_path / "out").iterdir() if f.name.startswith("_")]


def test_small_payloads_are_not_revisited(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    write_pages(pages(spark), path, least_bytes=5)
    kinds = {(r.page_id, r.record_type) for r in read_archives(spark, path).collect()}
    assert {(1, "response"), (2, "response"), (3, "response"), (4, "response")} <= kinds


def test_no_pages(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    write_pages(pages(spark).limit(0), path)
    assert read_archives(spark, path).count() == 0


def test_header_predicates_reach_the_reader(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    write_pages(pages(spark), path)
    all_rows = read_archives(spark, path)
    for condition in ("record_type = 'revisit'", "target_uri IN ('http://d/', 'http://e/')", "refers_to IS NULL", "record_type <=> 'response'", "record_type = 'response' AND payload_bytes > 3"):
        found = all_rows.filter(condition)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("Filter" in plan.replace("RuntimeFilters", "")) == ("> 3" in condition), plan
        ids = [r.record_id for r in found.collect()]
        kept = spark.createDataFrame([tuple(r) for r in all_rows.collect()], all_rows.schema).filter(condition)
        assert sorted(ids) == sorted(r.record_id for r in kept.collect())


def test_a_frame_can_be_read_again_after_a_filtered_query(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    write_pages(pages(spark), path)
    df = read_archives(spark, path)
    assert [df.count(), df.filter("record_type = 'revisit'").count(), df.count()] == [len(PAGES), 3, len(PAGES)]


def test_unwanted_payloads_are_not_decoded(tmp_path):
    plain = record({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:1>"}, b"x" * 100_000)
    broken = plain[:200] + bytes(b ^ 255 for b in plain[200:-8]) + plain[-8:]
    wanted = record({"WARC-Type": "request", "WARC-Record-ID": "<urn:page:2>"}, b"hello")
    (tmp_path / "a.warc.gz").write_bytes(broken + wanted)
    reader = WarcReader({"path": f"file://{tmp_path}"})
    reader.wanted.append(("record_type", "=", "request"))
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [(r["record_id"], r["payload"]) for r in rows] == [("urn:page:2", b"hello")]


def test_archives_of_others(spark, tmp_path):
    """Members without stated lengths, headers in other cases, records without the library's own headers."""
    first = b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\ncontent-length: 4\r\n\r\ninfo\r\n\r\n"
    second = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Length: 70000\r\n\r\n" + b"y" * 70_000 + b"\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(first) + gzip.compress(second))
    (tmp_path / "b.warc").write_bytes(second + first)
    (tmp_path / "notes.txt").write_text("not an archive")
    rows = read_archives(spark, f"file://{tmp_path}").collect()
    assert sorted((r.record_id, r.record_type, len(r.payload), r.page_id) for r in rows) == [
        ("urn:uuid:1", "warcinfo", 4, None),
        ("urn:uuid:1", "warcinfo", 4, None),
        ("urn:uuid:2", "response", 70_000, None),
        ("urn:uuid:2", "response", 70_000, None),
    ]
    bare = read_archives(spark, f"file://{tmp_path}", payload="false").collect()
    assert all(r.payload is None for r in bare) and len(bare) == 4


def test_small_files_share_a_partition(tmp_path):
    for i in range(10):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * 100)
    reader = WarcReader({"path": f"file://{tmp_path}", "partitionbytes": "350"})
    assert [len(p.paths) for p in reader.partitions()] == [3, 3, 3, 1]
    assert pafs.FileSystem.from_uri(f"file://{tmp_path}")[1] == str(tmp_path)


def test_digest_column(spark):
    texts = ["", "a", "Äö" * 1000]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(base32_sha1(F.col("t").cast("binary"))).collect()
    assert [r[0] for r in found] == [w[2] for w in brute.warc([(i, t) for i, t in enumerate(texts)])]


def test_only_repeated_payloads_are_joined(spark, tmp_path):
    """Payloads that stand alone go to their file from the scan; no shuffle holds them."""
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i % 40 if i % 4 == 0 else i} " + "z" * (i % 7)) for i in range(200)], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    write_pages(spark.read.parquet(str(tmp_path / "pages")), str(tmp_path / "warc"))
    back = read_archives(spark, str(tmp_path / "warc")).collect()
    rows = {r["page_id"]: r["html"] for r in pages.collect()}
    assert sorted(r["page_id"] for r in back) == sorted(rows)
    last = {html: max(i for i, h in rows.items() if h == html) for html in rows.values()}
    for r in back:
        owner = last[rows[r["page_id"]]]
        assert r["record_type"] == ("response" if owner == r["page_id"] else "revisit")
        assert r["refers_to"] == (None if owner == r["page_id"] else f"urn:page:{owner}")


def test_names_of_stores():
    assert [warc._uri(u) for u in ("s3a://b/x", "s3n://b/x", "s3://b/x", "/x/s3a://", "file:///x")] == ["s3://b/x", "s3://b/x", "s3://b/x", "/x/s3a://", "file:///x"]
