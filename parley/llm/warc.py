"""WARC archives whose repeated payloads are revisit records.

Headers (page_id, payload digest, payload length) are shuffled by payload digest, without the
payloads; of each digest with several records the one with the largest page_id is the response,
and the others are joined to it and written as revisit records, without a payload and with a fresh
header that refers to the response.

A record is text: its header block, the payload in UTF-8 and CR LF CR LF, which is exactly what
Spark's text writer makes with that line separator. So archives are written by Spark, to any file
system it knows, with its commit protocol: a lost executor's part is written again, never half.
Archives are gzip files of at most ``records_per_file`` records. They are read one file at a time,
inflated as a stream and cut by Content-Length, so a payload may hold any separator.

Defined results: html null: empty payload; payloads under ``min_bytes``: always a response; rows
that repeat the response's page_id and payload are responses too (a record cannot refer to itself);
page_id null: written as ``null``, read back as null, and never the largest; url null: an empty
target URI; control characters in a url are percent-encoded; empty table: no rows; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm.common import pick

END = "\r\n\r\n"
READ_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, intact boolean, payload string")


def headers(pages: DataFrame) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest (lower-case hex SHA-1)."""
    return (
        pick(pages, page_id="long", url="string", html="string")
        .withColumn("html", F.coalesce("html", F.lit("")))
        .withColumn("payload_bytes", F.octet_length("html").cast("long"))
        .withColumn("payload_digest", F.sha1(F.col("html").cast("binary")))
    )


def resolve_revisits(records: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Add ``refers_to``: for revisits the response's page_id, else null."""
    responses = (
        records.where(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest").agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n")
    )
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return (
        records.join(responses, "payload_digest", "left")
        .withColumn("refers_to", F.when(revisit, F.col("response_id")))
        .drop("response_id")
    )


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def record_text(date: str) -> Column:
    """A whole record without its closing CR LF CR LF, which the writer adds."""
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    is_revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    body = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("html")))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), _record_id(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(is_revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                  "\r\nWARC-Refers-To: "), _record_id(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit(END), body,
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 1000, records_per_file: int = 2000,
                   date: str = "2025-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages`` (page_id, url, html) as gzip archives below ``path``."""
    resolved = resolve_revisits(headers(pages), min_bytes)
    (resolved.select(record_text(date).alias("value")).write
     .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


class _Stream:
    """Reads an inflated gzip file by length or up to a separator, holding little more than asked."""

    def __init__(self, packed: bytes, step: int = 1 << 16):
        self.packed, self.at, self.step = memoryview(packed), 0, step
        self.inflate, self.buffer, self.start = zlib.decompressobj(31), bytearray(), 0

    def _more(self) -> bool:
        if self.start > 1 << 20:
            del self.buffer[:self.start]
            self.start = 0
        while self.at < len(self.packed):
            if self.inflate.eof:  # the next member
                rest = self.inflate.unused_data
                self.at -= len(rest)
                self.inflate = zlib.decompressobj(31)
            piece = self.packed[self.at:self.at + self.step]
            self.at += len(piece)
            got = self.inflate.decompress(piece)
            if got:
                self.buffer += got
                return True
        return False

    def upto(self, mark: bytes) -> bytes | None:
        seen = self.start
        while (end := self.buffer.find(mark, seen)) < 0:
            behind = max(self.start, len(self.buffer) - len(mark) + 1) - self.start
            if not self._more():
                if len(self.buffer) > self.start:
                    raise ValueError("a record's header is cut off")
                return None
            seen = self.start + behind
        out = bytes(self.buffer[self.start:end])
        self.start = end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.start < n:
            if not self._more():
                raise ValueError("a record's block is cut off")
        out = bytes(self.buffer[self.start:self.start + n])
        self.start += n
        return out


def _fields(block: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in block.decode().split("\r\n")[1:])}


def _page(urn: str | None) -> int | None:
    said = urn[len("<urn:x-page:"):-1] if urn else "null"
    return None if said == "null" else int(said)


def read_file(packed: bytes) -> Iterator[tuple]:
    """The records of one archive, in order, as tuples of READ_SCHEMA."""
    stream, end = _Stream(packed), END.encode()
    while (block := stream.upto(end)) is not None:
        head = _fields(block)
        body = stream.take(int(head["content-length"]))
        if stream.take(len(end)) != end:
            raise ValueError("a record does not end where its length says")
        http, _, payload = body.partition(end)
        kind, said = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
        length = int(_fields(http)["content-length"])
        if kind == "response":
            digest = hashlib.sha1(payload).hexdigest()
            intact, length, text = digest == said and length == len(payload), len(payload), payload.decode()
        else:
            digest, intact, text = said, True, None
        yield (_page(head["warc-record-id"]), head["warc-target-uri"], length, digest, kind,
               _page(head.get("warc-refers-to")), intact, text)


def _read_batches(batches: Iterator[pd.DataFrame], with_payload: bool) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
    for batch in batches:
        for packed in batch["content"]:
            rows, held = [], 0
            for r in read_file(packed):
                rows.append(r if with_payload else (*r[:-1], None))
                held += len(r[-1] or "") if with_payload else 0
                if len(rows) >= 4096 or held > 1 << 24:
                    yield _frame(rows, names)
                    rows, held = [], 0
            if rows:
                yield _frame(rows, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "payload_bytes", "refers_to"):
        out[c] = pd.array([r[names.index(c)] for r in rows], dtype="Int64")
    return out


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record below ``path``: READ_SCHEMA. ``intact``: digest and length are as the header
    says; ``payload`` is null for revisits."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInPandas(lambda b: _read_batches(b, with_payload), READ_SCHEMA)
