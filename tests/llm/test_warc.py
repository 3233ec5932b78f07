from __future__ import annotations

import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from keelson.llm import files
from keelson.llm.warc import payload_digest, plan_reads, read_warc, write_warc

ROWS = [(1, "http://a/ b", "same"), (2, "u", "same"), (3, None, None), (4, "u", ""), (5, "u", "ü\r\n\r\nWARC/1.1\r\n"), (6, "u", "x" * 300_000),
        (7, "u", "rep"), (7, "u", "rep"), (None, "u", "no id")]
SCHEMA = "page_id long, url string, html string"


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumn("path", F.lit("clash")).repartition(2)
    index = write_warc(pages, str(tmp_path / "w"))
    got = {r.id: r for r in read_warc(index).collect()}
    assert index.count() == len(ROWS) == read_warc(index).count()
    for page, url, html in ROWS:
        raw = (html or "").encode()
        r = got[page]
        assert r.payload_bytes == len(raw) and r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert r.record_type == ("revisit" if page in (2, 4) else "response") and r.refers_to == {2: 1, 4: 3}.get(page)
        assert r.payload == (None if page in (2, 4) else raw)
    # Any gzip reader can go through a file from its start; the records of the index are all there is.
    path = index.first().path
    whole = gzip.decompress(open(path, "rb").read())
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and whole.endswith(b"\r\n\r\n")


def test_threshold_and_small_files(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    index = write_warc(pages, str(tmp_path / "w"), min_bytes=4, file_bytes=1)
    kinds = {r.id: r.record_type for r in index.collect()}
    assert kinds[2] == "revisit" and kinds[4] == "response"
    assert index.select("path").distinct().count() == len(ROWS)


def test_selected_records_share_ranges(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(100)], SCHEMA).coalesce(1)
    index = write_warc(pages, str(tmp_path / "w"))
    assert plan_reads(index).count() == 1
    some = index.where("id % 2 = 0")
    assert plan_reads(some, gap_bytes=0).count() == 50 and plan_reads(some).count() == 1
    assert {r.id for r in read_warc(some).collect()} == set(range(0, 100, 2))


def test_empty_table(spark, tmp_path):
    index = write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert index.count() == 0 and read_warc(index).count() == 0


def test_digest(spark):
    texts = ["", "a", "ü" * 100]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(payload_digest(F.col("t").cast("binary")).alias("d")).collect()
    assert [r.d for r in got] == [base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts]


def test_paths():
    assert files.opened("file:/tmp/x")[1] == files.opened("/tmp/x")[1] == files.opened("file:///tmp/x")[1] == "/tmp/x"
