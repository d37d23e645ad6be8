import base64
import gzip
import hashlib
from collections import Counter

import pytest
from edge_cases import SF
from pyarrow import fs
from pyspark.sql.functions import spark_partition_id

from predial.llm import warc
from predial.llm.support import keep, prepare

ROWS = [
    (5, "http://a.example/x", "dup"), (3, "http://c.example/", "dup"), (9, None, "dup"),
    (7, "http://a.example/y", None), (8, "bad url\n\there", ""), (4, "http://a.example/x", "z"),
    (1, "http://é.fr:8080/ü?q=1 2#f", "ünïcode\r\n\r\nWARC/1.1"),
    (-4, "", "long" * 500_000), (None, "http://no.id/", "dup"), (3, "http://c.example/", "dup"),
    (6, "http://[bad", "other"),
]


def brute(rows, at_least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        original = first.get(html or "") if len(payload) >= at_least else i
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        same = i == original
        out.append((i, len(payload), digest, "response" if same else "revisit",
                    None if same else original))
    return sorted(set(out), key=str)


def read(archive, df):
    records = warc.resolved(keep(warc.read_pages(archive, warc.keys_of(df)), "read"))
    return records


def frame(spark, rows=ROWS):
    pages = prepare(spark).createDataFrame(rows, "page_id long, url string, html string, digest int")
    return pages.repartition(3)


@pytest.mark.parametrize("at_least", [0, 3, 4])
def test_round_trip(spark, at_least):
    df = frame(spark, [(*r, 1) for r in ROWS])
    records = read(warc.write(df, at_least=at_least), df).collect()
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
           for r in records}
    assert sorted(got, key=str) == brute(ROWS, at_least)
    assert len(records) == len(ROWS)
    texts = {(i, u): (h or "").encode() for i, u, h in ROWS}
    for r in records:
        assert texts[r.page_id, r.url] == (r.payload if r.record_type == "response" else
                                           texts[r.page_id, r.url])


def test_archives_are_plain_warc(spark):
    df = frame(spark, [(*r, 1) for r in ROWS[:3]])
    archive = warc.write(df)
    files, path = fs.FileSystem.from_uri(archive.records)
    data = b""
    for info in files.get_file_info(fs.FileSelector(path)):
        with files.open_input_file(info.path) as file:
            data += gzip.decompress(file.read())
    assert data.count(b"WARC/1.1\r\nWARC-Type: revisit") == 2
    assert b"WARC-Target-URI: http://a.example/x\r\n" in data and data.endswith(b"\r\n\r\n")


def test_lookup_searches_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    monkeypatch.setattr(warc, "SORTED_LINES", 40)
    rows = [(i, f"http://h{i % 7}.example/{'same' if i % 3 else i}", str(i)) for i in range(200)]
    df = frame(spark, [(*r, 1) for r in rows])
    archive = warc.write(df)
    assert archive.directory.count() >= 60
    url = "http://h1.example/same"
    keys = spark.createDataFrame([(warc.surt(url),), ("zzz",), ("",)], "key string")
    found = warc.read_records(archive, warc.lookup(archive, keys)).collect()
    assert sorted(r.page_id for r in found) == [i for i, u, _ in rows if u == url]
    assert read(archive, df).count() == 200


def test_keys():
    assert warc.surt("HTTPS://M.a.Example.COM:81/P?q=1#x") == "com,example,a,m:81)/P?q=1"
    assert warc.surt("http://a.example") == "example,a)/"
    assert warc.capture_key(None, -1) < warc.capture_key(None, 1)


def test_nothing(spark):
    df = frame(spark, [])
    assert read(warc.write(df), df).count() == 0


def test_given_pages(spark):
    df = prepare(spark).read.parquet(f"{SF}/pages.parquet")
    rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    got = read(warc.write(df), df).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_revisits_of_one_page_are_spread(spark):
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in off}
    rows = [(0, "response", "D", None, 9), (1, "response", "E", None, 5)]
    rows += [(i, "revisit", "D", 0, None) for i in range(2, 2002)] + [(None, "revisit", "E", 1, None)] * 2
    df = spark.createDataFrame(
        rows, "page_id long, record_type string, payload_digest string, refers_to long, payload_bytes long")
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        found = warc.resolved(df)
        assert found.columns == df.columns
        parts = found.withColumn("part", spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.payload_digest, r.payload_bytes) for r in parts) == [("D", 9)] * 2001 + [("E", 5)] * 3
    assert max(Counter(r.part for r in parts).values()) < len(rows) / 2


def test_addresses_are_those_of_the_default_file_system(spark):
    """Without a scheme the workers would write to their own disks."""
    conf = prepare(spark)._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert warc.qualified(spark, "/shared/x") == "file:/shared/x"
    try:
        conf.set("fs.defaultFS", "hdfs://localhost:1")
        assert warc.qualified(spark, "/user/x") == "hdfs://localhost:1/user/x"
        assert warc.qualified(spark, "file:/mnt/x") == "file:/mnt/x"
    finally:
        conf.set("fs.defaultFS", before)
    with pytest.raises(ValueError, match="har"):
        warc.qualified(_Foreign(), "x")


class _Foreign:
    """A session whose folders have an address that the workers don't know."""

    def __getattr__(self, name):
        return self

    def __call__(self, *args):
        return self

    def toString(self):  # noqa: N802
        return "har://x"
