"""WARC archives without repeated payloads.

Headers, not payloads, are grouped by payload digest to find each payload's first
record. The others become revisit records that refer to it. Reading resolves them:
revisits are joined to the responses they name.

Archives are written by Spark's text writer, a record a row: a record ends with two
line ends, which is the writer's line separator. So they can lie in any store that
Spark writes to.
"""

import gzip
import re
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# Bytes of an archive before compression, about. A task reads an archive whole.
ARCHIVE_BYTES = 32_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "page_id long, record_type string, record_id string, refers_to_id string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def base32(hexed: Column) -> Column:
    """Base 32 of 40 hexadecimal digits: each ten of them are eight digits of that base,
    whose signs are then exchanged."""
    eights = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in range(1, 41, 10)]
    return F.translate(F.concat(*eights), DIGITS, ALPHABET)


def digested(pages: DataFrame) -> DataFrame:
    """page_id, url, html and the payload's bytes and SHA-1, in hexadecimal digits; null
    html is empty."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html"))
    return rows.withColumn("bytes", F.octet_length("html").cast("long")).withColumn(
        "sha1", F.sha1(F.col("html").cast("binary"))
    )


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat(F.coalesce(page.cast("string"), F.lit("null")), F.lit("|"), digest).cast("binary"))
    parts = [F.substring(h, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def resolved(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``digested`` with the payload's digest in base 32 and the page id of its response,
    ``first``. Rows meet by the SHA-1 as it is: only what is written is recoded, once.

    Records with equal payloads of at least ``least_bytes`` share the smallest page id,
    and null if none has one; smaller ones are their own. Pages that repeat both a
    response's id and payload are responses too.
    """
    rows = digested(pages)
    firsts = rows.groupBy("sha1").agg(F.min("page_id").alias("_least"), base32(F.col("sha1")).alias("digest"))
    own = F.when(F.col("bytes") >= least_bytes, F.col("_least")).otherwise(F.col("page_id"))
    return rows.join(firsts, "sha1").withColumn("first", own).drop("_least", "sha1")


def records(rows: DataFrame, date: str) -> DataFrame:
    """The text of each record, without the line ends that close it."""
    revisit = ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    uri = F.regexp_replace("url", r"[\x00-\x20]", "%20")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", uri),
        _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first"), F.col("digest")))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes a record for each row of ``pages`` (page_id, url, html), compressed.

    Null html is an empty payload, a null url or page id has no header line. Payloads
    shuffle once, by digest; where Spark doesn't broadcast the digests it splits the
    pages of a payload that very many share.
    """
    size = pages.agg(F.count("*"), F.sum(F.octet_length("html"))).first()
    each = max(1, int(ARCHIVE_BYTES * size[0] / max(1, size[1] or 0))) if size[0] else 1
    records(resolved(pages, least_bytes), date).write.option("lineSep", "\r\n\r\n").option(
        "maxRecordsPerFile", min(each, 1_000_000)
    ).option("compression", "gzip").text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(headers, payload) of each record: lengths lead, so payloads may hold anything."""
    at, view = 0, memoryview(data)
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = dict(re.findall(r"([^:\r\n]+): ([^\r\n]*)\r\n", data[at : end + 2].decode()))
        start = end + 4
        block = view[start : start + int(head["Content-Length"])]
        body = data.index(b"\r\n\r\n", start) + 4
        yield head, view[body : start + len(block)]
        at = start + len(block) + 4


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives under ``path``.

    Digest and bytes of a response are taken from its payload, and a digest that
    differs from the header's is an error. Of a revisit the digest is the header's;
    its bytes and payload are null.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.binary()]
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for head, payload in parse(gzip.decompress(content.as_py())):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = head["WARC-Type"] == "response"
                    if response and b32encode(sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"the payload of {head['WARC-Record-ID']} is not what its header says")
                    page = head.get("X-Page-ID")
                    rows.append(
                        (
                            None if page is None else int(page),
                            head["WARC-Type"],
                            head["WARC-Record-ID"],
                            head.get("WARC-Refers-To"),
                            digest,
                            len(payload) if response else None,
                            bytes(payload) if response and payloads else None,
                        )
                    )
                    size += len(payload) * payloads
                    if len(rows) == 1000 or size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(each, RECORD)


def resolve(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record.

    Revisits get the bytes and the page id of the response that they name.
    """
    named = (
        found.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("_named"))
        .agg(F.min("page_id").alias("_page"), F.min("payload_bytes").alias("_bytes"))
    )
    joined = found.join(named, F.col("refers_to_id") == F.col("_named"), "left")
    return joined.select(
        "page_id",
        F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.col("_page").alias("refers_to"),
    )
