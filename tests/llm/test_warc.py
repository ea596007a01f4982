import gzip
import hashlib
import io
import os
import zlib

import pytest
from pyspark.sql import functions as F

from docvec.llm import queries, warc

SCHEMA = "page_id long, url string, html string"


def files_of(archives):
    return [r["path"].removeprefix("file://") for r in archives.collect()]


def parsed(path):
    """The records of an archive by Python's gzip module and plain cuts: header lines and block."""
    data, found = gzip.open(path).read(), []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        assert rest[size : size + 4] == b"\r\n\r\n"
        found.append((fields, rest[:size]))
        data = rest[size + 4 :]
    return found


def test_archives_are_read_by_others_too(spark):
    long = "<p>same payload é</p>" * 20
    rows = [(5, "http://a/\r\nX: 1", long), (3, None, long), (9, "http://b/é", long), (1, "u", "short"), (2, "u", "short"), (4, "u", None)]
    archives = warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3))
    records = [x for p in files_of(archives) for x in parsed(p)]
    pages = {f["WARC-Record-ID"]: (f, b) for f, b in records if f["WARC-Type"] != "warcinfo"}
    assert len(pages) == 6 and sum(f["WARC-Type"] == "warcinfo" for f, _ in records) == archives.count()
    for fields, block in pages.values():
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
    for page_id, url, html in rows:
        fields, block = pages[f"<urn:page:{page_id}>"]
        payload = (html or "").encode()
        assert fields["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
        if page_id in (5, 9):
            assert fields["WARC-Type"] == "revisit" and fields["WARC-Refers-To"] == "<urn:page:3>" and block.endswith(b"\r\n\r\n")
        else:
            assert fields["WARC-Type"] == "response" and block.partition(b"\r\n\r\n")[2] == payload
    assert pages["<urn:page:5>"][0]["WARC-Target-URI"] == "http://a/%0D%0AX:%201"
    assert "WARC-Target-URI" not in pages["<urn:page:3>"][0]


def test_every_record_is_a_member_of_its_own(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" * 50) for i in range(20)]
    archives = warc.write(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    found = warc.read(archives).collect()
    for r in found:
        with open(r["path"].removeprefix("file://"), "rb") as file:
            file.seek(r["offset"])
            inflater = zlib.decompressobj(31)
            text = inflater.decompress(file.read())
        assert inflater.eof and f"<urn:page:{r['key']}>".encode() in text and text.count(b"WARC/1.1") == 1


def test_payloads_come_back(spark):
    same = "copies of one page " * 30
    rows = [(i, "u", same if i % 3 else f"own {i} " * i) for i in range(200)] + [(500, "u", "é" * 3_000_000), (501, None, "")]
    archives = warc.write(spark.createDataFrame(rows, SCHEMA).repartition(4), archive_bytes=2000)
    assert archives.count() > 8
    found = warc.resolved(warc.read(archives)).collect()
    assert {r["key"]: bytes(r["payload"]).decode() for r in found} == {i: h for i, _, h in rows} and len(found) == len(rows)
    assert {r["record_type"] for r in found if r["key"] % 3 and r["key"] not in (1, 500)} == {"revisit"}
    assert {r["refers_to"] for r in found if r["record_type"] == "revisit"} == {1}
    assert not any(r["problem"] for r in found)
    assert all(r["payload"] is None for r in warc.read(archives, with_payload=False).collect())


def test_rows_with_every_kind_of_trouble(spark):
    same = "x" * 100
    rows = [(None, None, same, 1), (7, "u", same, 1), (7, "u", same, 1), (8, "u", same, 2), (6, "u", "y" * 99, 3), (5, "u", "y" * 99, 3)]
    df = spark.createDataFrame(rows, SCHEMA + ", first int")
    got = sorted((str(r["key"]), r["record_type"], r["refers_to"]) for r in warc.read(warc.write(df)).collect())
    assert got == [("5", "response", None), ("6", "response", None), ("7", "response", None), ("7", "response", None), ("8", "revisit", 7), ("None", "response", None)]
    empty = warc.write(df.limit(0))
    assert empty.collect() == [] and warc.read(empty).collect() == []


def test_a_payload_that_most_rows_share_is_dealt_over_tasks(spark):
    df = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 10 == 0, F.repeat(F.col("id").cast("string"), 60)).otherwise("z" * 200).alias("html"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = warc.marked(df.select(F.col("page_id").alias("key"), F.col("url").alias("uri"), F.col("html").alias("payload")))
        sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 600
    assert marked.where("first IS NOT NULL").agg(F.count("*"), F.min("first"), F.max("first")).first() == (2699, 1, 1)


def test_broken_archives_say_what_is_wrong(spark, tmp_path):
    one = warc.page_record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, "1970-01-01T00:00:00Z")
    two = warc.page_record(2, "u", b"other", hashlib.sha256(b"payload").hexdigest(), None, "1970-01-01T00:00:00Z")
    short = warc.member([b"WARC/1.1\r\nContent-Length: 50\r\n\r\nabc"])
    cases = {"good": one, "digest": one + two, "cut": one + one[:-10], "noise": one + b"no gzip at all", "short": one + short,
             "framing": warc.member([b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabcdef"]), "other": warc.member([b"HTTP/1.1 200 OK\r\n\r\n"])}
    for name, data in cases.items():
        (tmp_path / name).write_bytes(data)
    paths = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in cases], "path string")
    found = {}
    for r in warc.read(paths).collect():
        found.setdefault(os.path.basename(r["path"]), []).append((r["key"], r["problem"]))
    assert found["good"] == [(1, None)]
    assert found["digest"] == [(1, None), (2, "wrong digest of payload")]
    for name, word in {"cut": "cut off", "noise": "incorrect header", "short": "cut off", "framing": "does not end", "other": "not a WARC"}.items():
        assert word in found[name][-1][1], name
    assert found["cut"][0] == (1, None)
    with pytest.raises(Exception, match="wrong digest of payload"):
        rows = warc.read(paths.where("path LIKE '%digest'"))
        rows.select(warc.sound(rows)).collect()


def test_inflating_in_pieces():
    """Members of any size, records over several members and several in one, read a byte at a time or more."""
    payload = os.urandom(300_000)
    record = gzip.decompress(warc.page_record(4, "u", payload, hashlib.sha256(payload).hexdigest(), None, "d"))
    split = warc.member([record[:50]]) + warc.member([record[50:200_000]]) + warc.member([record[200_000:]])
    for data in (warc.member([record, record]), split, warc.member([record])):
        found = list(warc.records(io.BytesIO(data)))
        assert {f["payload"] for f in found} == {payload} and not any(f["problem"] for f in found)

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(7)

    small = warc.page_record(4, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None, "d")
    assert [f["payload"] for f in warc.records(Slow(small + small))] == [b"abc", b"abc"]


def test_query_against_brute_force(spark, sf):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    first = {}
    for k in sorted(pages):
        first.setdefault(pages[k], k)
    got = {r["page_id"]: r for r in queries.op12_warc(spark, sf).collect()}
    assert got.keys() == pages.keys()
    for k, payload in pages.items():
        repeat = first[payload] if len(payload) >= 100 and first[payload] != k else None
        want = (k, len(payload), hashlib.sha256(payload).hexdigest(), "response" if repeat is None else "revisit", repeat)
        assert tuple(got[k]) == want
