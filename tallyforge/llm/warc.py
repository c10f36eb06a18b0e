"""WARC archives: one record a page, revisits for repeated payloads, and their resolution.

Headers (id, digest, length) are shuffled by payload digest; the payloads are not. The record with the smallest id of each
payload is written as a response, the others as revisits that refer to it, all with fresh headers. Archives are gzip-compressed
streams of records, written by Spark's text writer: a record ends in CRLF CRLF, which is its line separator here. Reading goes
by Content-Length, so payloads may hold that sequence.

Defined cases: a null payload is the empty payload; rows with a null id are revisits of an equal payload that has an id, and
responses without one; repeated rows (same id and payload) are written each, with the same type; an empty table gives an
archive folder without records; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's UTF-8 bytes: 40 hexadecimal digits in eight groups of 20 bits."""
    digits = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digits, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def record_id(page_id: Column, digest: Column) -> Column:
    """The same id whenever a page with that payload is written."""
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def planned_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
                    min_bytes: int = 0) -> DataFrame:
    """Each row with its payload, digest, record type and the page it refers to.

    Payloads of fewer than ``min_bytes`` bytes are never made revisits.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"), sha1_base32(body).alias("payload_digest"),
    )
    headers = rows.drop("payload").filter(F.col("payload_bytes") >= min_bytes)
    firsts = (headers.filter("page_id IS NOT NULL").groupBy("payload_digest")
              .agg(F.min(F.struct("page_id", "url")).alias("first")))
    revisits = (headers.join(firsts, "payload_digest")
                .filter(~F.col("page_id").eqNullSafe(F.col("first.page_id")))
                .select("page_id", "payload_digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url"))
                .distinct())
    a, b = rows.alias("a"), revisits.alias("b")
    return (a.join(b, F.col("a.page_id").eqNullSafe(F.col("b.page_id"))
                   & (F.col("a.payload_digest") == F.col("b.payload_digest")), "left")
            .select("a.*", "b.refers_to", "b.refers_url")
            .withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")))


def _line(name: str, value: Column | str) -> Column:
    value = F.regexp_replace(value, r"[\r\n]", "") if isinstance(value, Column) else F.lit(value)
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archives(records: DataFrame, path: str, records_per_file: int = 1000) -> None:
    """Writes planned records. A file holds at most ``records_per_file`` records, as readers take a file at a time."""
    revisit = F.col("record_type") == "revisit"
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", record_id(F.col("page_id"), F.col("payload_digest"))), _line("WARC-Date", now),
        _line("WARC-Target-URI", F.col("url")), _line("X-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(
            _line("WARC-Profile", PROFILE),
            _line("WARC-Refers-To", record_id(F.col("refers_to"), F.col("payload_digest"))),
            _line("WARC-Refers-To-Target-URI", F.col("refers_url")))).otherwise(""),
        _line("Content-Type", "application/http; msgtype=response"),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END),
    )
    (records.select(F.concat(head, block).alias("value")).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse_records(stream: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an uncompressed archive."""
    at, end = 0, END.encode()
    while at < len(stream):
        stop = stream.index(end, at)
        first, *lines = stream[at:stop].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines)
        at = stop + 4 + int(fields["Content-Length"])
        yield fields, stream[stop + 4:at]
        at += 4


READ = ("record_id string, record_type string, page_id long, url string, refers_to_record string, payload_bytes long, "
        "payload_digest string, payload string")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row a record: ids, type, and for responses the payload's length and digest, taken from its bytes.

    Without ``payloads`` the payload column is null. A response whose bytes do not have the digest of its header is an error.
    """
    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = {name.split()[0]: [] for name in READ.split(", ")}
                for fields, block in parse_records(gzip.decompress(content.as_py())):
                    stated, kind, page = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"], fields.get("X-Page-ID")
                    body = block.partition(END.encode())[2]
                    found = base64.b32encode(hashlib.sha1(body).digest()).decode()
                    if kind == "response" and found != stated:
                        raise ValueError(f"{fields['WARC-Record-ID']}: the payload has digest {found}, the header {stated}")
                    whole = kind == "response"
                    for name, value in (
                        ("record_id", fields["WARC-Record-ID"]), ("record_type", kind), ("page_id", None if page is None else int(page)),
                        ("url", fields.get("WARC-Target-URI")), ("refers_to_record", fields.get("WARC-Refers-To")),
                        ("payload_bytes", len(body) if whole else None), ("payload_digest", found if whole else stated),
                        ("payload", body.decode("utf-8") if whole and payloads else None),
                    ):
                        rows[name].append(value)
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                    [(k, pa.int64() if k in ("page_id", "payload_bytes") else pa.string()) for k in rows]))

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, READ)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Each record with length, digest, payload and page of the response that holds its payload."""
    own = records.filter("record_type = 'response'")
    targets = own.dropDuplicates(["record_id"]).select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest", "payload")
    back = records.filter("record_type = 'revisit'").select("record_id", "record_type", "page_id", "url", "refers_to_record")
    found = back.join(targets, "refers_to_record", "left")
    return own.withColumn("refers_to", F.lit(None).cast("long")).unionByName(found)
