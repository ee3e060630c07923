"""Content-addressed WARC archive.

``write_archive`` gives every page a WARC/1.1 record.  Payload bytes are stored once, under their
SHA-256, as ``resource`` records in ``path/payloads``; the exact header of every page's record is in
``path/headers``.  Of pages with equal payloads of at least ``least_bytes`` the one with the least
page_id is the response, the others are revisits that refer to it; smaller ones are all responses.
``read_archive`` reads both back, checks length and both digests of each payload, and joins them to the
original records.

Files are written by Spark's text writer (the blank lines between records are its line ends) and are
gzip; a file holds at most ``RECORDS_PER_FILE`` payloads, as a file is read at once.

Null html is an empty payload, a null url has no target line, and control characters in a url are
percent-encoded.  A null page_id is never the first of its payload: such rows are revisits where a page with an id has
it, else responses.  Repeated rows of the first page are all responses.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_BYTES = 0
RECORDS_PER_FILE = 512
DATE = "1970-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BETWEEN = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: str) -> Column:
    """Base-32 SHA-1: five hexadecimal digits are four characters."""
    digest = F.sha1(F.col(payload).cast("binary"))
    groups = [F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int") for i in range(8)]
    return F.concat(*(F.substring(F.lit(BASE32), F.shiftright(g, k).bitwiseAND(31) + 1, F.lit(1)) for g in groups for k in (15, 10, 5, 0)))


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; those whose value is null are left out."""
    return F.concat_ws("\r\n", F.lit("WARC/1.1"), *(F.concat(F.lit(f"{name}: "), value) for name, value in pairs))


def _page_urn(column: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))


def _safe_url(url: str) -> Column:
    out = F.col(url)
    for code in (*range(32), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}")) if code in (9, 10, 13) else out
    return F.regexp_replace(out, "[\\x00-\\x1F\\x7F]", "%1A")


def write_archive(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload")).withColumns(
        {"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")}
    )
    stored = base.groupBy("digest", "n_bytes").agg(F.first("payload").alias("payload"))
    resource = _lines(
        ("WARC-Type", F.lit("resource")),
        ("WARC-Record-ID", F.concat(F.lit("<urn:sha256:"), F.col("digest"), F.lit(">"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1("payload"))),
        ("Content-Length", F.col("n_bytes").cast("string")),
    )
    writer = stored.select(F.concat(resource, F.lit(BETWEEN), "payload")).write.option("lineSep", BETWEEN)
    writer.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(f"{path}/payloads")

    rows = base.select("page_id", "url", "digest", "n_bytes")
    first = rows.where(F.col("n_bytes") >= least_bytes).groupBy(F.col("digest")).agg(F.min("page_id").alias("first_id"))
    rows = rows.join(first, "digest", "left").withColumn(
        "again", F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    )
    header = _lines(
        ("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        ("WARC-Record-ID", _page_urn("page_id")),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", _safe_url("url")),
        ("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(F.col("again"), _page_urn("first_id"))),
        ("WARC-Profile", F.when(F.col("again"), PROFILE)),
        ("Content-Length", F.col("n_bytes").cast("string")),
    )
    rows.select(header).write.option("lineSep", BETWEEN).option("compression", "gzip").text(f"{path}/headers")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, record_type, refers_to, digest, n_bytes, header)`` of each record."""
    lines = spark.read.option("lineSep", BETWEEN).text(f"{path}/headers").withColumnRenamed("value", "header")

    def field(name: str, pattern: str = "(.*)") -> Column:
        got = F.regexp_extract("header", f"\r\n{name}: {pattern}(?:\r\n|$)", 1)
        return F.when(got != "", got)

    return lines.where("header <> ''").select(
        field("WARC-Record-ID", "<urn:page:(-?[0-9]*)>").cast("long").alias("page_id"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Refers-To", "<urn:page:(-?[0-9]*)>").cast("long").alias("refers_to"),
        field("WARC-Block-Digest", "sha256:([0-9a-f]*)").alias("digest"),
        field("Content-Length").cast("long").alias("n_bytes"),
        "header",
    )


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and payload of each record of one file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        fields = dict(re.findall(r"^([\w-]+): (.*)$", data[at:end].decode().replace("\r", ""), re.M))
        begin = end + 4
        stop = begin + int(fields["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a record's length is wrong")
        yield fields, data[begin:stop]
        at = stop + 4


def read_payloads(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """``(digest, payload_bytes, payload_digest[, payload])``, each checked against its digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, payload in parse_records(gzip.decompress(content.as_py())):
                    strong = hashlib.sha256(payload).hexdigest()
                    weak = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if fields["WARC-Record-ID"] != f"<urn:sha256:{strong}>" or fields["WARC-Payload-Digest"] != f"sha1:{weak}":
                        raise ValueError(f"payload {fields['WARC-Record-ID']} is damaged")
                    rows.append((strong, len(payload), weak, payload))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
                kinds = [pa.string(), pa.int64(), pa.string(), pa.binary()]
                n = 4 if with_payload else 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns[:n], kinds[:n], strict=True)], names=NAMES[:n])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/payloads")
    return files.select("content").mapInArrow(run, "digest string, payload_bytes long, payload_digest string" + ", payload binary" * with_payload)


NAMES = ["digest", "payload_bytes", "payload_digest", "payload"]


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every page's record: header fields joined with the stored payload."""
    records = read_headers(spark, path).join(read_payloads(spark, path, with_payload), "digest")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "header", *(["payload"] if with_payload else []))
