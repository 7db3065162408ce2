"""WARC archives of pages: written, read back, and assembled into captures.

A page becomes three records: a response (or a revisit, if its payload is
archived already), and a request and a metadata record that name it in
WARC-Concurrent-To.  Reading gives one row per record; ``assemble`` joins the
records of a transaction by those ids into one nested row per capture.

Of pages with equal payloads of at least MIN_REVISIT bytes, that with the
smallest page_id is the response.  Files are gzip-compressed, about FILE_BYTES
of records each (a longer record has a file of its own).

Cases: null html: empty payload.  Null url: an empty target.  Null page_id: a
capture of its own, a response only if no page with an id has its payload.
Rows that repeat the page_id and payload of the response are responses too.
Empty table: no rows.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qamill.llm.files import read_files, write_files
from qamill.llm.tables import staged
from qamill.session import scratch_dir, ship_package

MIN_REVISIT = 100
FILE_BYTES = 16 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"


def _record(kind: Column, record_id: Column, media: str, block: Column, *fields: tuple[str, Column]) -> Column:
    """Bytes of a record; fields that are null are left out."""
    lines = [F.lit("WARC/1.1" + _END), F.lit("WARC-Type: "), kind, F.lit(f"{_END}WARC-Record-ID: "), record_id,
             F.lit(f"{_END}WARC-Date: {DATE}{_END}Content-Type: {media}{_END}")]
    for name, value in fields:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(_END)), F.lit("")))
    lines += [F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_END * 2), block, F.lit(_END * 2)]
    return F.concat(*lines).cast("binary")


def _id(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def records(pages: DataFrame) -> DataFrame:
    """The records of all pages, the three of a page one after another, as binary column ``record``."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html"))
    first = p.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1").select("digest", "first")
    p = p.join(first, "digest", "left").withColumn("revisit", F.coalesce(
        F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.lit(False)))
    p = p.withColumn("n", F.monotonically_increasing_id())
    main = _id(F.lit("main"), F.col("n"), F.col("page_id"), F.col("digest"))
    target = F.regexp_replace("url", r"[\r\n]", "")
    host = F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#\r\n]*)", 1)
    path = F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#\r\n]*([^#\r\n]*)", 1)
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("bytes").cast("string"), F.lit(_END * 2))
    answer = _record(
        F.when(F.col("revisit"), "revisit").otherwise("response"), main, "application/http; msgtype=response",
        F.when(F.col("revisit"), head).otherwise(F.concat(head, F.col("html"))),
        ("WARC-Target-URI", target), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))))
    ask = _record(F.lit("request"), _id(F.lit("request"), F.col("n"), F.col("page_id"), F.col("digest")), "application/http; msgtype=request",
                  F.concat(F.lit("GET "), F.when(path == "", "/").otherwise(path), F.lit(f" HTTP/1.1{_END}Host: "), host, F.lit(_END * 2)),
                  ("WARC-Target-URI", target), ("WARC-Concurrent-To", main))
    about = _record(F.lit("metadata"), _id(F.lit("metadata"), F.col("n"), F.col("page_id"), F.col("digest")), "application/warc-fields",
                    F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(_END)), F.lit("")),
                             F.lit("revisit: "), F.col("revisit").cast("string"), F.lit(_END)),
                    ("WARC-Target-URI", target), ("WARC-Concurrent-To", main))
    return p.select(F.explode(F.array(ask, answer, about)).alias("record"))


def _file_rows(batches):
    held, size = [], 0

    def file():
        # The writer puts the last line feed.
        return pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], names=["content"])

    for batch in batches:
        for r in batch.column(0):
            held.append(r.as_py())
            size += len(held[-1])
            if size >= FILE_BYTES:
                yield file()
                held, size = [], 0
    if held:
        yield file()


def write_archives(spark: SparkSession, pages: DataFrame, path: str) -> None:
    ship_package(spark)
    write_files(records(pages).mapInArrow(_file_rows, "content binary"), path, compression="gzip")


def parse(data: bytes):
    """(headers in lower case, block) of each record; ValueError if a record is cut off."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + 4
        stop = start + int(headers["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} is cut off")
        yield headers, data[start:stop]
        at = stop + 4


_ROW = ("record_type string, record_id string, concurrent_to string, target_uri string, payload_digest string, "
        "payload binary, payload_sha256 string, fields map<string,string>")


def _record_rows(batches):
    names = [x.split()[0] for x in _ROW.split(", ")]
    kinds = [pa.string()] * 5 + [pa.binary(), pa.string(), pa.map_(pa.string(), pa.string())]
    for batch in batches:
        for content in batch.column("content"):
            data = content.as_buffer().to_pybytes()
            data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
            rows, size = [], 0
            for h, block in parse(data):
                kind, payload, fields = h["warc-type"], block, []
                if kind in ("response", "request", "revisit"):
                    payload = block.partition(b"\r\n\r\n")[2]
                elif h.get("content-type") == "application/warc-fields":
                    fields = [tuple(x.strip() for x in line.split(":", 1)) for line in block.decode("utf-8", "replace").split("\r\n") if ":" in line]
                rows.append((kind, h.get("warc-record-id"), h.get("warc-concurrent-to"), h.get("warc-target-uri"),
                             h.get("warc-payload-digest", "").removeprefix("sha256:") or None, payload,
                             hashlib.sha256(payload).hexdigest(), fields))
                size += len(payload)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under path."""
    ship_package(spark)
    return read_files(spark, path).select("content").mapInArrow(_record_rows, _ROW)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response (or revisit), request, metadata; the latter two null if missing."""
    names = [c for c in records.columns if c != "concurrent_to"]
    side = lambda name: records.where(F.col("record_type") == name).select(
        F.col("concurrent_to").alias("capture_id"), F.struct(*names).alias(name))
    main = records.where(F.col("record_type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"), F.struct(*names).alias("response"))
    return main.join(side("request"), "capture_id", "left").join(side("metadata"), "capture_id", "left")


def op2_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    write_archives(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    read = read_archives(spark, path).withColumn("payload_bytes", F.octet_length("payload").cast("long")).drop("payload")
    seen = assemble(staged(spark, read, "records")).select(
        F.col("metadata.fields")["page-id"].cast("long").alias("page_id"), F.col("response.record_type").alias("record_type"),
        F.col("response.payload_digest").alias("named"), F.col("response.payload_sha256").alias("had"), F.col("response.payload_bytes").alias("bytes"))
    # A revisit's payload is that of the response with its digest.
    kept = seen.where(F.col("record_type") == "response").groupBy(F.col("had").alias("named")).agg(
        F.min("page_id").alias("refers"), F.max("bytes").alias("full_bytes"))
    again = F.col("record_type") == "revisit"
    return seen.join(kept, "named", "left").select(
        "page_id", F.when(again, F.col("full_bytes")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(again, F.col("named")).otherwise(F.col("had")).alias("payload_digest"), "record_type",
        F.when(again, F.col("refers")).alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS d, octet_length(encode(coalesce(html, '')))::BIGINT AS n FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""
