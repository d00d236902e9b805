from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from burnlens.llm import archive as A
from burnlens.session import scratch_path

PAGES = "page_id long, url string, html string, digest string, size int, header string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], PAGES)


def expected(rows):
    newest = {}
    for i, _, h in rows:
        h = h or ""
        newest[h] = max(newest.get(h, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 1000 and newest[h or ""] != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", newest[h or ""] if again else None))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_round_trip(data):
    src = data("pages")
    out = A.round_trip(src)
    rows = [(r.page_id, r.url, r.html) for r in src.collect()]
    assert result(out) == expected(rows)
    assert {r.page_id: bytes(r.payload).decode() for r in out.collect()} == {i: h or "" for i, _, h in rows}


def test_copies_and_odd_pages(spark):
    big, limit = "é" * 700, "x" * 1000
    rows = [(1, "http://a", big), (2, None, big), (3, "u\r\nv", big), (4, "u", limit), (5, "u", limit), (6, "u", "x" * 999), (7, "u", "x" * 999),
            (8, "u", None), (9, "u", ""), (10, "u", "a\r\n\r\nWARC/1.1\r\n\0"), (3, "again", big), (11, "u", "z" * 2_000_000)]
    assert result(A.round_trip(pages(spark, rows))) == expected(rows)
    assert A.round_trip(pages(spark, [])).count() == 0


def test_pages_without_an_id(spark):
    big, alone = "b" * 1500, "a" * 1500
    rows = [(None, "u", big), (4, "u", big), (None, "u", alone), (None, "u", alone), (None, None, None), (3, "u", big)]
    got = result(A.round_trip(pages(spark, rows)))
    kinds = [(r[0], r[1], r[3], r[4]) for r in got]
    assert sorted(kinds, key=str) == sorted([(None, 1500, "revisit", 4), (4, 1500, "response", None), (None, 1500, "response", None), (None, 1500, "response", None),
                                             (None, 0, "response", None), (3, 1500, "revisit", 4)], key=str)


def test_payloads_are_stored_once_and_verified(spark):
    path = scratch_path(spark, "archive_test")
    A.write(pages(spark, [(i, "u", "p" * 2000) for i in range(20)] + [(20, "u", "q" * 2000)]), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 2 and spark.read.parquet(f"{path}/headers").count() == 21
    bad = scratch_path(spark, "archive_bad")
    held = spark.read.parquet(f"{path}/payloads")
    held.withColumn("packed", F.first("packed").over(__import__("pyspark").sql.Window.orderBy("digest"))).write.parquet(f"{bad}/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{bad}/headers")
    with pytest.raises(Exception, match="doesn't match its digest"):
        A.read(spark, bad).collect()
