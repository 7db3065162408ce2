import hashlib

import pytest
from pyspark.sql import functions as F

from qamill.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")


def captures(spark, path):
    return warc.assemble(warc.read_archives(spark, path)).select(
        F.col("metadata.fields")["page-id"].alias("page_id"), "response.record_type", "response.payload",
        "response.target_uri", F.col("request.target_uri").alias("asked")).collect()


def test_round_trip_with_hard_payloads(spark, tmpdir_shared):
    big = "<p>é</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40
    rows = [(1, "http://a.b/c?d=e#f", big), (2, "http://a.b/", big), (3, None, None), (4, "no url\r\nX: y", ""), (5, "http://ü.x", "short"),
            (6, "http://ü.x", "short"), (7, "https://h", "long " * 100_000), (8, "u", "\n"), (9, "u", "\r\n\r\n")]
    warc.write_archives(spark, pages(spark, rows), tmpdir_shared)
    got = {int(r.page_id): r for r in captures(spark, tmpdir_shared)}
    assert sorted(got) == list(range(1, 10))
    for i, url, html in rows:
        revisit = i == 2
        assert got[i].record_type == ("revisit" if revisit else "response")
        assert bytes(got[i].payload) == (b"" if revisit else (html or "").encode())
        assert got[i].target_uri == got[i].asked == (url or "").replace("\r", "").replace("\n", "")


def test_files_are_bounded(spark, tmpdir_shared, monkeypatch):
    rows = [(i, "http://x/", f"{i} " * 500) for i in range(60)]
    content = warc.records(pages(spark, rows)).collect()
    assert len(content) == 180
    warc.write_archives(spark, pages(spark, rows), tmpdir_shared)
    assert len(captures(spark, tmpdir_shared)) == 60


def test_null_and_repeated_ids_and_empty_table(spark, tmp_path):
    same = "same payload " * 20
    rows = [(None, "u", same), (5, "u", same), (5, "u", same), (2, "u", same), (None, "v", "alone " * 30)]
    d = str(tmp_path / "t")
    pages(spark, rows).write.parquet(f"{d}/pages.parquet")
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.op2_warc_transactions(spark, d).collect()), key=str)
    h = hashlib.sha256(same.encode()).hexdigest()
    alone = hashlib.sha256(("alone " * 30).encode()).hexdigest()
    assert got == sorted([(None, "revisit", 2, 260, h), (5, "revisit", 2, 260, h), (5, "revisit", 2, 260, h), (2, "response", None, 260, h),
                          (None, "response", None, 180, alone)], key=str)
    e = str(tmp_path / "e")
    pages(spark, []).write.parquet(f"{e}/pages.parquet")
    assert warc.op2_warc_transactions(spark, e).collect() == []


def test_cut_off_record():
    good = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [b for _, b in warc.parse(good * 2)] == [b"abc"] * 2
    for bad in (good[:-3], b"x" + good, good + b"WARC/1.1\r\n"):
        with pytest.raises(ValueError):
            list(warc.parse(bad))
