"""Content-addressed WARC archive (operator 9).

An archive is two tables in the shared folder: ``payloads`` keeps every
distinct payload once, compressed, under its SHA-1; ``headers`` keeps the exact
header block of every record with the digest of its payload. A record's bytes
are rebuilt by joining the two (``records``), and ``read`` parses them again.

Of the records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one
with the largest page_id is the response, the others revisit it; shorter
payloads are always responses. Repeated rows of that page_id are responses too.

Contract cases: NULL html is the empty payload; an empty table gives an empty
archive; extra columns are ignored; a NULL url gives an empty target URI; a NULL
page_id has the record id "none": it revisits the response of its payload, and is
one itself if no equal payload has an id. A very long page is one payload of a batch.

Memory and skew: equal payloads are combined by max() before the shuffle, so a
task sends each distinct payload once. The rebuilding join is on the digest, where Spark splits a hot digest's
headers over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnlens.llm.common import string_buffers
from burnlens.session import scratch_path

REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
NO_ID = "none"  # in the record id of a page without one


def _digests(batches: Iterable[pa.RecordBatch], keep: bool) -> Iterator[pa.RecordBatch]:
    import zstandard
    pack = zstandard.ZstdCompressor(level=3).compress if keep else lambda t: None
    for batch in batches:
        data, off = string_buffers(batch.column(2))
        raw = memoryview(data)
        size = [int(b - a) for a, b in zip(off[:-1], off[1:])]
        text = [bytes(raw[a:b]) for a, b in zip(off[:-1], off[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([hashlib.sha1(t).hexdigest() for t in text], pa.string()),
             pa.array(size, pa.int64()), pa.array([pack(t) for t in text], pa.binary())],
            names=["page_id", "url", "digest", "size", "packed"])


def digested(pages: DataFrame, keep: bool) -> DataFrame:
    """page_id, url, digest, size, packed (the payload as one zstd frame, or NULL)."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return src.mapInArrow(lambda b: _digests(b, keep), "page_id long, url string, digest string, size long, packed binary")


def header_block() -> F.Column:
    """The WARC/1.1 header block of a record, up to and with the empty line."""
    revisit = F.col("refers_to").isNotNull()
    rid = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit(NO_ID)), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", rid(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("X-Payload-Length", F.col("size").cast("string")),
        F.when(revisit, F.concat(line("WARC-Refers-To", rid(F.col("refers_to"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit(CRLF))


def write(pages: DataFrame, path: str) -> None:
    """Write the archive of ``pages`` under ``path`` (payloads/ and headers/)."""
    spark = pages.sparkSession
    (digested(pages, True).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.max("size").alias("size"), F.max("packed").alias("packed"))
     .select("digest", "keeper", "size", "packed").write.parquet(f"{path}/payloads"))
    keepers = spark.read.parquet(f"{path}/payloads").where(F.col("size") >= REVISIT_BYTES).select("digest", "keeper")
    (digested(pages, False).drop("packed").join(keepers, "digest", "left")
     .withColumn("refers_to", F.when(~F.col("keeper").eqNullSafe(F.col("page_id")), F.col("keeper")))
     .select("digest", F.encode(header_block(), "utf-8").alias("header"))
     .write.parquet(f"{path}/headers"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record rebuilt: header block bytes and the stored payload (NULL
    for a digest that the archive lacks); revisits carry their payload too."""
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", "packed")
    return headers.join(payloads, "digest", "left")


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parse rebuilt records; the digest and length are taken from the payload
    itself, and a record whose payload doesn't match its header is an error."""
    import zstandard
    unpack = zstandard.ZstdDecompressor()
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    for batch in batches:
        out: list[tuple] = []
        for header, packed in zip(batch.column("header").to_pylist(), batch.column("packed").to_pylist()):
            lines = header.decode("utf-8").split(CRLF)
            fields = dict(x.split(": ", 1) for x in lines[1:] if x)
            page, kind = fields["WARC-Record-ID"][10:-1], fields["WARC-Type"]
            page = None if page == NO_ID else int(page)
            if packed is None:
                raise ValueError(f"record {page}: payload {fields['WARC-Payload-Digest']} is not in the archive")
            payload = unpack.decompress(packed)
            digest = hashlib.sha1(payload).hexdigest()
            if f"sha1:{digest}" != fields["WARC-Payload-Digest"] or len(payload) != int(fields["X-Payload-Length"]):
                raise ValueError(f"record {page}: its payload doesn't match its digest")
            refers = int(fields["WARC-Refers-To"][10:-1]) if kind == "revisit" else None
            out.append((page, fields["WARC-Target-URI"], len(payload), digest, kind, refers, payload))
        cols = list(zip(*out)) or [()] * 7
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    payload of every record of the archive, verified."""
    return records(spark, path).mapInArrow(
        _parse, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write an archive in the shared folder and read it back."""
    path = scratch_path(pages.sparkSession, "warc_archive")
    write(pages, path)
    return read(pages.sparkSession, path)
