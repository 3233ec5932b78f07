"""WARC archives with an index first, and reads of coalesced byte ranges."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from keelson.llm import files, textops
from keelson.session import scratch_path, shuffle_width, staged

_HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # the digits of base 32 as conv() writes them
_RFC4648 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FILE_BYTES = 1 << 30
READ_BYTES, GAP_BYTES = 8 << 20, 64 << 10
_INDEX = ("id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, "
          "path string, offset long, length long")


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: every five hex digits are four base-32 digits."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _HEX32, _RFC4648)


def mark_revisits(pages: DataFrame, id_col: str, html_col: str, url_col: str, min_bytes: int = 0) -> DataFrame:
    """(id, url, html, payload_digest, payload_bytes, refers_to): ``refers_to`` is the smallest id with
    an equal payload of at least ``min_bytes``, NULL for that record itself and for unique payloads.

    First ids combine before the shuffle, and only payloads with several records take part in
    the join, whose stored inputs let adaptive execution split a hot payload.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumns({"payload_digest": payload_digest(F.col("html")), "payload_bytes": F.length("html").cast("long")})
    several = staged(
        rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
        .agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("payload_digest", "payload_bytes", "first"), "payloads")
    joined = rows.join(several, ["payload_digest", "payload_bytes"], "left")
    refers = F.when(F.col("first") != F.col("id"), F.col("first"))
    return joined.select("id", "url", "html", "payload_digest", "payload_bytes", refers.alias("refers_to"))


def _record(head: list[tuple[str, str]], body: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return b"WARC/1.1\r\n" + lines + f"Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def _packed(record: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)  # one gzip member per record
    return pack.compress(record) + pack.flush()


def _clean(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def write_warc(
    pages: DataFrame, folder: str, date: str = "2026-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record per page and return the stored index of them.

    The index has a row per record: id, url, ``record_type`` (response or revisit), ``refers_to``,
    ``payload_digest``, ``payload_bytes``, and ``path, offset, length`` of its gzip member. Of
    equal payloads of at least ``min_bytes`` the one with the smallest id is the response; the
    others are revisits that name it and hold no payload. A task writes one file after another,
    each up to ``file_bytes`` (more only for one record), with a warcinfo record at its head.

    A NULL html is an empty payload, a NULL url an empty target. Rows that repeat an id with the
    same payload are all responses, or all revisits. An empty table has an empty index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = path = None
        at = 0
        for batch in textops.released(batches):
            rows = []
            for page, url, html, digest, size, first in zip(*(c.to_pylist() for c in batch.columns)):
                if stream is not None and at >= file_bytes:
                    stream.close()
                    stream = None
                if stream is None:
                    path = files.new_file(folder, ".warc.gz")
                    stream = files.write_stream(path)
                    info = _packed(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                            ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    stream.write(info)
                    at = len(info)
                kind = "response" if first is None else "revisit"
                head = [("WARC-Type", kind), ("WARC-Record-ID", _urn(page)), ("WARC-Date", date), ("WARC-Target-URI", _clean(url)),
                        ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Bytes", str(size)), ("Content-Type", "text/html; charset=utf-8")]
                if first is not None:
                    head += [("WARC-Refers-To", _urn(first)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                member = _packed(_record(head, html if first is None else b""))
                stream.write(member)
                rows.append((page, url, kind, first, digest, size, path, at, len(member)))
                at += len(member)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
        if stream is not None:
            stream.close()

    arrow = pa.schema([(n, {"long": pa.int64(), "string": pa.string()}[t]) for n, t in (x.split() for x in _INDEX.split(", "))])
    marked = mark_revisits(pages, id_col, html_col, url_col, min_bytes)
    ordered = marked.select("id", "url", "html", "payload_digest", "payload_bytes", "refers_to")
    return staged(ordered.mapInArrow(run, _INDEX), "warc-index")


def _urn(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def plan_reads(index: DataFrame, read_bytes: int = READ_BYTES, gap_bytes: int = GAP_BYTES) -> DataFrame:
    """Byte ranges that cover the records of an index: (path, start, length, at, sizes).

    Records of a file are sorted by offset; one that begins within ``gap_bytes`` after the end of the
    one before it shares its range, unless that crosses a multiple of ``read_bytes``, so a
    range holds a bounded part of a file.
    """
    per_file = W.partitionBy("path").orderBy("offset")
    gap = F.col("offset") - F.lag(F.col("offset") + F.col("length")).over(per_file)
    cell = F.floor(F.col("offset") / read_bytes)
    new = F.when((gap > gap_bytes) | gap.isNull() | (cell != F.lag(cell).over(per_file)), 1).otherwise(0)
    numbered = index.select("path", "offset", "length", new.alias("new")).withColumn("range", F.sum("new").over(per_file))
    members = F.array_sort(F.collect_list(F.struct("offset", "length")))  # those of one range only
    return numbered.groupBy("path", "range").agg(
        F.min("offset").alias("start"), (F.max(F.col("offset") + F.col("length")) - F.min("offset")).alias("length"),
        members.alias("m")).select("path", "start", "length", F.col("m.offset").alias("at"), F.col("m.length").alias("sizes"))


def read_warc(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of an index (or of any selection of its rows), read from the archives.

    Columns: id, ``url``, ``record_type``, ``refers_to``, ``payload_digest``, ``payload_bytes`` and, if wanted,
    ``payload`` (NULL for revisits). A response whose bytes do not match its digest raises ValueError.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.released(batches):
            for path, start, length, at, sizes in zip(*(c.to_pylist() for c in batch.columns)):
                data = files.read_range(path, start, length)
                rows = []
                for offset, size in zip(at, sizes):
                    head, body = _parse(zlib.decompress(data[offset - start:offset - start + size], 31))
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = head["WARC-Type"] == "revisit"
                    if not revisit and (len(body) != int(head["X-Payload-Bytes"]) or _base32_sha1(body) != digest):
                        raise ValueError(f"{path}: record at {offset} does not match its digest")
                    rows.append((_page(head["WARC-Record-ID"]), head["WARC-Target-URI"], head["WARC-Type"],
                                 _page(head["WARC-Refers-To"]) if revisit else None, digest, int(head["X-Payload-Bytes"]),
                                 None if revisit or not with_payload else body))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    arrow = pa.schema([("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                       ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
    schema = "id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
    ranges = plan_reads(index).repartition(shuffle_width(index.sparkSession), "path", "start")
    return ranges.mapInArrow(run, schema)


def _parse(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    return {"WARC-Target-URI": "", **fields}, rest[:int(fields["Content-Length"])]


def _base32_sha1(body: bytes) -> str:
    import base64

    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def warc_folder(spark) -> str:
    return scratch_path(spark, "warc")


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS x FROM pages),
q AS (
  SELECT page_id, payload_bytes, x,
         translate(array_to_string(list_transform(range(8), lambda i: to_base(('0x' || substr(x, (1 + 5 * i)::BIGINT, 5))::BIGINT, 32, 4)), ''),
                   '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
         min(page_id) OVER (PARTITION BY x, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM q
"""
