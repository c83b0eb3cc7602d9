"""WARC archives with resolved revisits, written and read through Spark's own file sources.

Headers alone are shuffled by payload digest; the smallest page id of each digest is its response and
the other records become revisits of it, which keep their headers and drop their payload.  Records are
rows of a text sink whose line separator is the record separator, so archives land on any file system
Spark writes to and appear only when their task commits.  Reading walks each archive by Content-Length.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.scratch import written
from pricelens.llm.skew import spread_join

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 100
FILE_BYTES = 64 << 20


def record_headers(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest`` of every page; a null html is an empty payload."""
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.octet_length(html).cast("long").alias("payload_bytes"),
                        F.sha2(html, 256).alias("payload_digest"))


def resolve_revisits(headers: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Headers with ``refers_to``: the response's page id for revisits, else null.

    Equal payloads of at least ``min_bytes`` share one response, the smallest page id; a row without a
    page id is a response of its own, and repeated rows of the smallest page id are all responses.
    """
    large = headers.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    first = large.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"))
    joined = spread_join(headers, first, "payload_digest", F.coalesce("page_id", F.lit(-1)))
    revisits = (F.col("payload_bytes") >= min_bytes) & (F.col("page_id") > F.col("first_id"))
    return joined.withColumn("refers_to", F.when(revisits, F.col("first_id"))).drop("first_id")


def _record_id(page_id, digest):
    h = F.sha2(F.concat_ws("/", F.lit("record"), page_id.cast("string"), digest), 256)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in (
        (1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _line(name: str, value):
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))).otherwise("")


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                   min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write one WARC 1.1 record per page row under ``path``, payloads stored once.

    Record ids derive from page id and digest, so a task that runs again writes the same archive.
    Control signs in a url are written as ``%XX``; a null url or page id leaves its header out.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"))
    found = written(resolve_revisits(record_headers(pages), min_bytes), "warc-headers")
    total = found.agg(F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()[0]
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // FILE_BYTES))
    # revisits lose their payload: only they need their decision joined, all rows share its shuffle
    decided = found.filter("refers_to is not null").select("page_id", "payload_digest", "refers_to").distinct()
    key = ["page_id", "payload_digest"]
    rows = rows.withColumn("payload_digest", F.sha2("html", 256)).repartition(files, *key).join(decided, key, "left")
    digest, size = F.col("payload_digest"), F.octet_length("html")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    size.cast("string"), F.lit(CRLF * 2))
    url = F.col("url")
    for c in (9, 10, 13, 32):
        url = F.replace(url, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), digest)), _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", url), _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to"), digest))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))), _line("Page-ID", F.col("page_id")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "))
    (rows.select(F.concat(head, F.octet_length(block).cast("string"), F.lit(CRLF * 2), block))
     .write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path))


def parse_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of one archive, read by Content-Length."""
    buffer, ended = bytearray(), False

    def fill(n: int) -> bool:
        nonlocal ended
        while len(buffer) < n and not ended:
            more = next(chunks, None)
            if more is None:
                ended = True
            else:
                buffer.extend(more)
        return len(buffer) >= n

    while fill(1):
        end = buffer.find(b"\r\n\r\n")
        while end < 0:
            if not fill(len(buffer) + 1):
                raise ValueError("archive ends inside a header")
            end = buffer.find(b"\r\n\r\n")
        lines = bytes(buffer[:end]).decode("utf-8").split(CRLF)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        if not fill(end + 4 + size + 4):
            raise ValueError("archive ends inside a record")
        block = bytes(buffer[end + 4:end + 4 + size])
        if buffer[end + 4 + size:end + 8 + size] != b"\r\n\r\n":
            raise ValueError("record is longer than its Content-Length")
        del buffer[:end + 8 + size]
        yield fields, block


def _inflate(packed: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    member = zlib.decompressobj(31)
    while packed:
        out = member.decompress(packed, step)
        if out:
            yield out
        if member.eof:
            packed = member.unused_data
            member = zlib.decompressobj(31)
        else:
            packed = member.unconsumed_tail
            if not out and not packed:
                raise ValueError("archive is cut off")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``, payload digests recomputed and checked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "page_id", "url", "record_type", "refers_to_record", "payload_digest", "payload_bytes"]
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for packed in batch.column(0):
                rows = []
                for fields, block in parse_records(_inflate(packed.as_py())):
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = None
                    if fields["WARC-Type"] == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        size = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                    page = fields.get("Page-ID")
                    rows.append((fields["WARC-Record-ID"], None if page is None else int(page),
                                 fields.get("WARC-Target-URI"), fields["WARC-Type"], fields.get("WARC-Refers-To"),
                                 digest, size))
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                                 names=names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(read, "record_id string, page_id long, url string, record_type string, "
                                  "refers_to_record string, payload_digest string, payload_bytes long")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records with revisits joined to the responses they refer to.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to, url``; a revisit has the length of
    its response's payload.
    """
    records = written(read_records(spark, path), "warc-records")
    originals = (records.filter("record_type = 'response'").groupBy("record_id")
                 .agg(F.min("page_id").alias("original_id"), F.min("payload_bytes").alias("original_bytes"))
                 .withColumnRenamed("record_id", "refers_to_record"))
    revisits = spread_join(records.filter("record_type = 'revisit'"), originals, "refers_to_record",
                           F.coalesce("page_id", F.lit(-1)))
    whole = records.filter("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"), "url")
    return whole.unionByName(revisits.select(
        "page_id", F.col("original_bytes").alias("payload_bytes"), "payload_digest", "record_type",
        F.col("original_id").alias("refers_to"), "url"))
