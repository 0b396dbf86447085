"""WARC archives: write one transaction per page, read records back, assemble transactions.

``write`` stores three records per page: the request, the response (or a revisit, profile
identical-payload-digest) and metadata, the first and last pointing at the middle one through
WARC-Concurrent-To. A record is one string, and the text writer's line separator is the blank lines
that end a WARC record, so Spark's own committed output files are valid WARC 1.1 files (gzip, one
member per file). ``read`` parses any WARC files by Content-Length, one file per task at a time,
``assemble`` joins the records of a transaction through the concurrent-to identifiers into one nested
row per capture.

Equal payloads: the digest's smallest page is found by a partial aggregation, and joined back by
digest; the skew-join rule splits a payload that a third of all pages share.

Defined cases: a null ``html`` is an empty payload, which counts as equal to other empty ones; a null
``page_id`` sorts after all others; rows that repeat the smallest page_id of a payload are all
responses; a null ``url`` is written empty, line ends inside a URL are left out. Files must be under 2 GB (``records_per_file`` bounds
them), a limit of Spark's binary file reader.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import common
from tidemill.session import ensure_checkpoint_dir

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Payloads shorter than this are written as responses even when they repeat.
LEAST_REVISIT = 0
RECORDS_PER_FILE = 60_000
#: The base-32 alphabet of RFC 4648 beside the digits that radix 32 uses.
_RADIX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORDS = ("record_type string, record_id string, concurrent_to string, target_uri string, payload_digest string, "
           "declared_digest string, payload_bytes long, fields map<string,string>, payload binary")


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base-32 SHA-1 of a string's UTF-8 bytes, by five hex digits to four letters."""
    digest = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _RADIX, _BASE32)


def _record(kind: str, record_id: Column, content_type: str, body: Column, extra: list[Column]) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    return F.concat(F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {DATE}\r\nContent-Type: {content_type}\r\n"),
                    line("WARC-Record-ID", F.concat(F.lit("<"), record_id, F.lit(">"))), *extra,
                    line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"), body)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write(pages: DataFrame, path: str, least_revisit: int = LEAST_REVISIT, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the archives of ``pages`` (page_id, url, html) to ``path``."""
    page = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", base32_sha1(F.col("html")))
    first = (page.where(F.octet_length("html") >= least_revisit)
             .select("digest", F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url").alias("page"))
             .groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    known = page.join(first, "digest", "left").withColumn(
        "revisit", F.col("first").isNotNull() & ~F.col("first.page_id").eqNullSafe(F.col("page_id")))
    new_id = lambda: F.concat(F.lit("urn:uuid:"), F.uuid())
    known = known.withColumns({"own_id": new_id(), "request_id": new_id(), "metadata_id": new_id()})
    uri = _header("WARC-Target-URI", F.col("url"))
    beside = _header("WARC-Concurrent-To", F.concat(F.lit("<"), F.col("own_id"), F.lit(">")))
    declared = _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("html").cast("string"), F.lit("\r\n\r\n"))
    response = _record("response", F.col("own_id"), "application/http; msgtype=response", F.concat(http, F.col("html")), [uri, declared])
    revisit = _record("revisit", F.col("own_id"), "application/http; msgtype=response", http, [
        uri, declared, F.lit(f"WARC-Profile: {PROFILE}\r\n"), F.lit(f"WARC-Refers-To-Date: {DATE}\r\n"),
        _header("WARC-Refers-To-Target-URI", F.coalesce("first.url", F.lit("")))])
    host = F.regexp_extract("url", r"^[^:/]+://([^/?#]*)", 1)
    target = F.regexp_extract("url", r"^[^:/]+://[^/?#]*([^#]*)", 1)
    request = _record("request", F.col("request_id"), "application/http; msgtype=request",
                      F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")),
                      [uri, beside])
    metadata = _record("metadata", F.col("metadata_id"), "application/warc-fields",
                       F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n")), [uri, beside])
    (known.select(F.explode(F.array(request, F.when(F.col("revisit"), revisit).otherwise(response), metadata)).alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def parse(stream, with_payload: bool) -> Iterator[tuple]:
    """The records of one archive, as tuples of ``RECORDS``; the payload's digest is taken from its bytes."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"a record begins with {line[:40]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8").partition(":")
            head[name.strip().lower()] = value.strip()
        length = int(head["content-length"])
        body = stream.read(length)
        if len(body) < length:
            raise EOFError("a record is cut off")
        kind = head["warc-type"]
        fields: dict[str, str] = {}
        payload, size = body, length
        if head.get("content-type", "").startswith("application/http"):
            top, _, payload = body.partition(b"\r\n\r\n")
            for row in top.split(b"\r\n")[1:]:
                name, _, value = row.decode("utf-8", "replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            size = int(fields.get("content-length", 0)) if kind == "revisit" else len(payload)
        elif head.get("content-type", "") == "application/warc-fields":
            for row in body.split(b"\r\n"):
                name, found, value = row.decode("utf-8", "replace").partition(":")
                if found:
                    fields[name.strip().lower()] = value.strip()
        own = kind in ("response", "resource")
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode() if own else None
        bare = lambda name: head[name].strip("<>") if name in head else None
        yield (kind, bare("warc-record-id"), bare("warc-concurrent-to"), head.get("warc-target-uri"), digest,
               head.get("warc-payload-digest", "").rpartition(":")[2] or None, size, list(fields.items()),
               payload if with_payload and own else None)


def read(spark: SparkSession, path: str, with_payload: bool = True, records_per_batch: int = 512) -> DataFrame:
    """All records under ``path`` (see ``RECORDS``); without payloads only their digests and sizes are kept."""
    kinds = [pa.string()] * 6 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                raw = content.as_buffer()
                stream = io.BufferedReader(pa.BufferReader(raw))
                if raw.size >= 2 and raw[:2].to_pybytes() == b"\x1f\x8b":
                    stream = gzip.GzipFile(fileobj=stream)
                found = []
                for record in parse(stream, with_payload):
                    found.append(record)
                    if len(found) == records_per_batch:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)
                        found = []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .where("length > 0").select("content").mapInArrow(rows, RECORDS))


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: its response or revisit, with the requests and metadata that name it.

    A capture is a response, revisit or resource record. Records that name no capture of these
    archives are left out; a capture without request or metadata has empty lists.
    """
    def beside(kind: str, name: str, *fields: str) -> DataFrame:
        return (records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull())
                .groupBy(F.col("concurrent_to").alias("record_id")).agg(F.collect_list(F.struct(*fields)).alias(name)))

    captures = records.where(F.col("record_type").isin("response", "revisit", "resource"))
    empty = lambda c: F.coalesce(F.col(c), F.array())
    return (captures.join(beside("request", "requests", F.col("record_id").alias("id"), "target_uri", "fields"), "record_id", "left")
            .join(beside("metadata", "metadata", F.col("record_id").alias("id"), "fields"), "record_id", "left")
            .select("record_id", "record_type", "target_uri",
                    F.struct("payload_bytes", F.coalesce("payload_digest", "declared_digest").alias("payload_digest"),
                             "declared_digest", "fields", "payload").alias("response"),
                    empty("requests").alias("requests"), empty("metadata").alias("metadata")))


def captures_of(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Archive ``pages`` in the shared folder, read the archives back and assemble the captures.

    The parsed records are kept as a table, as assembling reads them once for every kind of record.
    """
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    return assemble(common.staged(read(spark, path, with_payload), "warc-records"))


def page_table(captures: DataFrame) -> DataFrame:
    """page_id, payload size and digest, record type, and the page that a revisit refers to."""
    flat = captures.select(F.get("metadata", F.lit(0))["fields"]["page-id"].try_cast("long").alias("page_id"),
                           F.col("response.payload_bytes").alias("payload_bytes"),
                           F.col("response.payload_digest").alias("payload_digest"), "record_type", "target_uri")
    origin = (flat.where("record_type = 'response'").groupBy("payload_digest").agg(F.min("page_id").alias("origin")))
    return (flat.join(origin, "payload_digest", "left")
            .select("page_id", "payload_bytes", "payload_digest", "record_type",
                    F.when(F.col("record_type") == "revisit", F.col("origin")).alias("refers_to"), "target_uri"))
