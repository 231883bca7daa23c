"""Deduplicated WARC archives: write one record per page, then read them back and resolve revisits.

Only headers (page_id, digest, size) are shuffled by payload digest, summed up before the shuffle; the pages then take
their verdict in a join by page_id, which is even however many pages share a payload. Records are packed in tasks into
archives of about ``ARCHIVE_BYTES`` (one record may be larger); Spark's text writer stores each as one gzip file, its
line end being the last byte of the last record. Reading parses whole archives, measures and hashes payloads anew and
joins revisit records to the responses they name; responses that are named meet their revisits under ``SALTS`` keys.

Defined results: a null or empty html is an empty payload, always a response. Of equal payloads of at least
``MIN_REVISIT_BYTES`` the smallest page_id is the response; rows that repeat that page_id are responses too. A null
page_id counts as larger than any other; if all are null, all are responses. A null url is written as an empty target;
control characters in it are percent-encoded. An empty table gives no archive and no rows. Other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm.tables import staged, table
from postlake.session import shared_dir

ARCHIVE_BYTES = 16 << 20
MIN_REVISIT_BYTES = 100
SALTS = 32  # over which the revisits of one response are spread
RECORD_DATE = "2024-01-01T00:00:00Z"

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Fixed value: the profile of the WARC standard for revisits with an identical payload.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PARSED = "page_id long, url string, record_id string, kind string, names string, bytes long, digest string, told string"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}')}>"


def _clean(url: str | None) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url or "")


def record(page_id, url, payload: bytes, digest: str, original: int | None, original_url: str | None, date: str) -> bytes:
    """One record with its closing line ends; ``original`` is the response's page for a revisit."""
    block = _HTTP + payload if original is None else _HTTP
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if original is not None:
        head += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To: {record_id(original, digest)}",
            f"WARC-Refers-To-Target-URI: {_clean(original_url)}",
            f"WARC-Refers-To-Date: {date}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_originals(pages: DataFrame) -> DataFrame:
    """page_id, url, html (null for revisits), digest, original, original_url."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("html"), F.sha2(payload, 256).alias("digest")
    )
    headers = rows.filter(F.octet_length("html") >= MIN_REVISIT_BYTES).select("page_id", "url", "digest")
    groups = (
        headers.groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.min_by("url", "page_id").alias("original_url"), F.count("*").alias("n"))
        .filter("n > 1 AND original IS NOT NULL")
        .drop("n")
    )
    revisits = (
        headers.drop("url")
        .join(groups, "digest")
        .filter("page_id IS NULL OR page_id > original")
        .groupBy("page_id", "digest")
        .agg(F.first("original").alias("original"), F.first("original_url").alias("original_url"))
        .withColumnsRenamed({"page_id": "r_page", "digest": "r_digest"})
    )
    by_page = [F.col("page_id").eqNullSafe(F.col("r_page")), F.col("digest") == F.col("r_digest")]
    return rows.join(revisits, by_page, "left").select(
        "page_id",
        "url",
        F.when(F.col("original").isNull(), F.col("html")).alias("html"),
        "digest",
        "original",
        "original_url",
    )


def write_archives(pages: DataFrame, path: str, date: str = RECORD_DATE, archive_bytes: int = ARCHIVE_BYTES) -> None:
    def pack(batches) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i) for i in range(6))):
                page_id, url, html, digest, original, original_url = (v.as_py() for v in row)
                parts.append(record(page_id, url, (html or "").encode(), digest, original, original_url, date))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield archive(parts)
                    parts, size = [], 0
        if parts:
            yield archive(parts)

    def archive(parts: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)[:-1].decode()], pa.string())], ["value"])

    packed = with_originals(pages).mapInArrow(pack, "value string")
    packed.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        head = dict(line.split(": ", 1) for line in lines[1:])
        size = int(head["Content-Length"])
        yield head, data[end + 4 : end + 4 + size]
        at = end + 8 + size


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, told_digest."""

    def parse(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for head, block in _records(gzip.decompress(content.as_py())):
                    page, kind = head.get("Page-Id"), head["WARC-Type"]
                    payload = block[block.index(b"\r\n\r\n") + 4 :] if kind == "response" else None
                    out.append(
                        (
                            None if page is None else int(page),
                            head["WARC-Target-URI"],
                            head["WARC-Record-ID"],
                            kind,
                            head.get("WARC-Refers-To"),
                            None if payload is None else len(payload),
                            None if payload is None else hashlib.sha256(payload).hexdigest(),
                            head["WARC-Payload-Digest"].removeprefix("sha256:"),
                        )
                    )
                if not out:  # the writer leaves an empty file for an empty table
                    continue
                types = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.string()]
                names = [f.split()[0] for f in _PARSED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = staged(files.mapInArrow(parse, _PARSED), "headers")
    told = parsed.filter("kind = 'revisit'").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    named = told.select(F.col("names").alias("record_id")).distinct()
    originals = (
        parsed.filter("kind = 'response'")
        .join(named, "record_id", "left_semi")
        .groupBy("record_id")
        .agg(F.first("page_id").alias("o_page"), F.first("bytes").alias("o_bytes"), F.first("digest").alias("o_digest"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        .withColumnsRenamed({"record_id": "o_record", "salt": "o_salt"})
    )
    to_original = (F.col("names") == F.col("o_record")) & (F.col("salt") == F.col("o_salt"))
    resolved = told.join(originals, to_original, "left")
    out = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "told_digest"]
    responses = parsed.filter("kind <> 'revisit'").select(
        "page_id", "url", "bytes", "digest", "kind", F.lit(None).cast("long"), "told"
    )
    revisits = resolved.select("page_id", "url", "o_bytes", "o_digest", "kind", "o_page", "told")
    return responses.toDF(*out).union(revisits.toDF(*out))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page as its record says after a round trip through the archives."""
    path = shared_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)
