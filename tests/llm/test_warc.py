"""WARC archives: round trips, revisit choice, pushed filters, skipped payloads."""

import base64
import gzip
import hashlib
import tempfile

import pytest
from pyspark.sql import functions as F

from featurelab.llm import warc as W
from featurelab.llm.queries import QUERIES
from featurelab.session import scratch_path

SF = "/root/testdata/sf0.001"
PAGES = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (9, "http://c/\r\nX: y", "é日本"), (4, None, None),
         (5, "u", ""), (6, "u", "only"), (None, "n", "<p>x</p>"), (2, "again", "<p>x</p>"), (None, "m", "solo null"),
         (7, "long", "ab\r\n\r\nWARC/1.1\r\n" * 40_000)]


def brute(pages):
    """(id, bytes, digest, type, refers to) by looking at every group."""
    groups = {}
    for i, _, html in pages:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for i, _, html in pages:
        p = (html or "").encode()
        ids = [x for x in groups[p] if x is not None]
        top = max(ids, default=None)
        revisit = top is not None and i != top
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response",
                    top if revisit else None))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type",
                                               "refers_to").collect()), key=str)


def as_tables(spark, pages):
    root = tempfile.mkdtemp(prefix="warc-test-")
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{root}/pages.parquet")
    return root


def test_query_on_odd_rows(spark):
    assert rows(QUERIES["op11_warc"](spark, as_tables(spark, PAGES))) == brute(PAGES)


def test_query_on_an_empty_table(spark):
    assert rows(QUERIES["op11_warc"](spark, as_tables(spark, []))) == []


def test_query_on_given_pages(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert rows(QUERIES["op11_warc"](spark, SF)) == brute(pages)


@pytest.mark.parametrize("broadcast_bytes", [16 << 20, 0])
def test_hot_payload_by_either_join(spark, broadcast_bytes):
    pages = [(i, "u", "hot" if i % 3 else f"page {i // 6}") for i in range(3000)]
    df = spark.createDataFrame(pages, "page_id long, key string, html string")
    got = W.mark_revisits(df, "page_id", "html", broadcast_bytes=broadcast_bytes)
    assert got.columns[:3] == ["page_id", "key", "html"]
    got = got.select("page_id", F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    assert rows(got) == brute(pages)


def test_small_payloads_are_not_revisits(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "abcd"), (4, "abcd")], "page_id long, html string")
    got = W.mark_revisits(df, "page_id", "html", min_bytes=3)
    assert {(r["page_id"], r["record_type"], r["refers_to"]) for r in got.collect()} == {
        (1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)}


def archive(spark, **options):
    path = scratch_path(spark, "warc-test")
    recs = spark.createDataFrame(
        [("urn:a", "response", "http://x/1", None, b"one"), ("urn:b", "revisit", "http://x/2", "urn:a", None),
         ("urn:c", "response", "http://y/1", None, b"z" * 300_000), ("urn:d", "metadata", None, None, b"k: v"),
         (None, None, "", None, None)],
        "record_id string, record_type string, target_uri string, refers_to string, payload binary")
    W.write_archive(recs, path, **options)
    return path


def test_round_trip_and_filters(spark):
    path = archive(spark, fileBytes=100)
    back = {r["record_id"]: r for r in W.read_archive(spark, path, partitionBytes=300).collect()}
    assert bytes(back["urn:a"]["payload"]) == b"one" and back["urn:c"]["payload_length"] == 300_000
    assert back["urn:b"]["payload"] is None and back["urn:b"]["refers_to"] == "urn:a"
    assert bytes(back["urn:d"]["payload"]) == b"k: v" and back[None]["record_type"] == "resource" and len(back) == 5
    some = W.read_archive(spark, path).where("record_type = 'response' AND target_uri LIKE 'http://x%'")
    assert [r["record_id"] for r in some.collect()] == ["urn:a"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PythonScan" in plan.replace(" ", "") or "Python" in plan
    assert all(r["payload"] is None for r in W.read_archive(spark, path, payload=False).collect())
    W.write_archive(spark.createDataFrame([("urn:e",)], "record_id string"), path, mode="overwrite")
    assert [r["record_id"] for r in W.read_archive(spark, path).collect()] == ["urn:e"]


def test_reader_takes_header_filters_and_seeks(spark, monkeypatch):
    """Filters on headers are taken, others left; an unwanted block is not decoded."""
    from pyspark.sql.datasource import EqualTo, GreaterThan, In
    path = archive(spark)
    r = W.WarcReader({"path": path})
    left = GreaterThan(("payload_length",), 3)
    assert list(r.pushFilters([EqualTo(("record_type",), "response"), In(("target_uri",), ("http://x/1",)), left])) == [left]
    decoded = []
    block = W._Gzip._block
    monkeypatch.setattr(W._Gzip, "_block", lambda self, z, have, n: decoded.append(n) or block(self, z, have, n))
    got = [x for p in r.partitions() for b in r.read(p) for x in b.column("record_id").to_pylist()]
    assert got == ["urn:a"] and max(decoded, default=0) < 1000


def test_files_of_other_tools(tmp_path):
    """Plain files, and gzip members that do not say their length."""
    recs = [W.record_bytes({"record_id": f"urn:{i}", "record_type": "response", "target_uri": "u", "warc_date": "d",
                            "refers_to": None, "payload_digest": None, "payload_length": n, "content_type": "t",
                            "payload": b"\r\n\r\nWARC/1.1\r\n" * (n // 14) + b"x" * (n % 14)})
            for i, n in enumerate((0, 5, 200_000, 70_000, 1))]
    (tmp_path / "a.warc").write_bytes(b"".join(recs))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in recs))
    for unwanted in (False, True):
        r = W.WarcReader({"path": str(tmp_path)})
        r.tests = [("record_id", "in", {"urn:1", "urn:4"})] if unwanted else []
        got = [x for p in r.partitions() for b in r.read(p) for x in zip(*(b.column(c).to_pylist() for c in (
            "record_id", "payload_length", "payload")))]
        assert [(a, b, len(c)) for a, b, c in got] == 2 * ([("urn:1", 5, 5), ("urn:4", 1, 1)] if unwanted else [
            ("urn:0", 0, 0), ("urn:1", 5, 5), ("urn:2", 200_000, 200_000), ("urn:3", 70_000, 70_000), ("urn:4", 1, 1)])


def test_members_are_plain_gzip():
    data = b"some record" * 1000
    assert gzip.decompress(W.gzip_member(data)) == data and W._Gzip._length(W.gzip_member(data)) == len(W.gzip_member(data))
