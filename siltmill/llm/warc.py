"""WARC archives with repeated payloads written once.

Digests are computed and resolved without payloads: headers are grouped by payload digest, and only
the ids of repeats are joined to the rows that carry payloads. Records are composed by column
expressions and written by Spark's text writer with the record end as its separator, so a lost or
repeated task leaves no half-written archive. Archives are read back as binary files and parsed by
their Content-Length as a stream.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.llm.common import text_batches
from siltmill.scratch import materialize, new_path

END = "\r\n\r\n"
MIN_PAYLOAD = 1000
#: Records of one archive file by the bytes of their payloads, so that a file holds at most FILE_BYTES of payloads, or one
#: larger record: (bytes, most records), and one record a file beyond.
FILE_BYTES = 1 << 28
KINDS = ((1 << 14, FILE_BYTES >> 14), (1 << 20, FILE_BYTES >> 20), (1 << 25, FILE_BYTES >> 25))
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit("\r\n")), F.lit(""))


def resolve(headers: DataFrame, key: str, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``headers(key, digest, size)`` -> ``(key, digest, refers_to)`` of the rows to be revisit records.

    Of rows with one digest and at least ``min_payload`` bytes, that with the largest key is the original.
    The largest key comes from a map-side combined aggregate; no group is gathered.
    """
    long = headers.where((F.col("size") >= min_payload) & F.col(key).isNotNull())
    keep = long.groupBy("digest").agg(F.max(key).alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return long.join(keep, "digest").where(F.col(key) < F.col("refers_to")).select(key, "digest", "refers_to")


def write_archives(pages: DataFrame, path: str, date: str, page="page_id", url="url", payload="html", min_payload: int = MIN_PAYLOAD) -> None:
    """Writes a record for each row of ``pages`` to gzipped archives under ``path``.

    ``payload`` may be text (as UTF-8) or bytes; null is empty. Rows whose key is null are always
    responses; rows repeated under the largest key of their payload are all responses, with equal
    records. ``date`` is the WARC-Date of every record, so that a repeated task writes the same bytes.
    Payloads of any length are written whole; longer ones go to files of fewer records, so that any file
    can be read by one task. Other columns are ignored, whatever their names.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{page}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("body"))
    digest, size = F.sha1("body"), F.octet_length("body")
    headers = materialize(rows.select("key", digest.alias("digest"), size.cast("long").alias("size")), "headers")
    largest = headers.agg(F.max("size")).first()[0] or 0
    repeats = materialize(resolve(headers, "key", min_payload), "revisits")
    marked = rows.withColumn("digest", digest).join(repeats.distinct(), ["key", "digest"], "left")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("body").cast("string"), F.lit(END))
    again = F.col("refers_to").isNotNull()
    block = F.when(again, F.encode(http, "utf-8")).otherwise(F.concat(F.encode(http, "utf-8"), F.col("body")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _uuid(F.col("key"), F.col("digest"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        _header("X-Source-Key", F.col("key")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Refers-To", F.when(again, _uuid(F.col("refers_to"), F.col("digest")))),
        _header("WARC-Profile", F.when(again, PROFILE)),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"),
        F.lit(END),
    )
    record = F.concat(F.encode(head, "utf-8"), F.col("block"))
    low = -1
    for high, records in (*KINDS, (None, 1)):
        some = marked.where(size > low) if high is None else marked.where(size.between(low + 1, high))
        out = some.withColumn("block", block).select(record.cast("string").alias("value"))  # the cast keeps the bytes
        out.write.mode("errorifexists" if low < 0 else "append").option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records).text(path)
        low = high
        if high is None or largest <= high:
            break


class Stream:
    """Decompressed bytes of an archive, a few at a time."""

    def __init__(self, data: bytes, step: int = 1 << 16):
        self.data, self.at, self.step = data, 0, step
        self.packed = data[:2] == b"\x1f\x8b"
        self.unzip = zlib.decompressobj(31)
        self.buffer = bytearray()

    def _more(self) -> bool:
        if self.at >= len(self.data):
            return False
        chunk = self.data[self.at : self.at + self.step]
        self.at += len(chunk)
        while self.packed and chunk:
            self.buffer += self.unzip.decompress(chunk)
            chunk = self.unzip.unused_data
            if chunk:  # the next member
                self.unzip = zlib.decompressobj(31)
        if not self.packed:
            self.buffer += chunk
        return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (i := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self._more():
                return None
        found = bytes(self.buffer[:i])
        del self.buffer[: i + len(mark)]
        return found

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        if len(self.buffer) < n:
            raise ValueError("an archive ends within a record")
        found = bytes(self.buffer[:n])
        del self.buffer[:n]
        return found


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; header names in lower case."""
    stream = Stream(data)
    while (head := stream.until(END.encode())) is not None:
        lines = head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        block = stream.take(int(headers["content-length"]))
        if stream.take(4) != END.encode():
            raise ValueError("a record is not closed")
        yield headers, block


SCHEMA = "key string, record_id string, record_type string, refers_id string, url string, digest string, payload_bytes long, payload_sha1 string, payload binary"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives under ``path`` (plain or gzipped, any number of members).

    ``payload`` is the block after its HTTP header, null for revisits and unless ``payloads``;
    ``payload_bytes`` and ``payload_sha1`` are measured on it, ``digest`` is what the record states.
    """
    files = text_batches(spark.read.format("binaryFile").load(path).select("content"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for b in batches:
            for data in b["content"]:
                rows, held = [], 0
                for h, block in parse(data):
                    body = block.partition(END.encode())[2]
                    fresh = h.get("warc-type") != "revisit"
                    rows.append((
                        h.get("x-source-key"), h.get("warc-record-id"), h.get("warc-type"), h.get("warc-refers-to"), h.get("warc-target-uri"),
                        h.get("warc-payload-digest", "").removeprefix("sha1:") or None, len(body) if fresh else None,
                        hashlib.sha1(body).hexdigest() if fresh else None, body if fresh and payloads else None,
                    ))
                    held += len(body) if payloads else 200
                    if held > 8_000_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return files.mapInPandas(read, SCHEMA)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with what revisits refer to: ``refers_key``, and the original's bytes, digest and payload.

    A revisit whose original is in none of the archives keeps nulls there. One original may have
    very many revisits; the join's larger side can be split by adaptive execution.
    """
    revisits, originals = records.where("record_type = 'revisit'"), records.where("record_type <> 'revisit'")
    wanted = revisits.select(F.col("refers_id").alias("record_id")).distinct()
    known = originals.join(wanted, "record_id", "left_semi").dropDuplicates(["record_id"])
    known = known.select(F.col("record_id").alias("refers_id"), F.col("key").alias("refers_key"), *(F.col(c).alias(f"o_{c}") for c in ("payload_bytes", "payload_sha1", "payload")))
    found = revisits.join(known, "refers_id", "left").select(
        "key", "record_id", "record_type", "refers_id", "url", "digest", F.col("o_payload_bytes").alias("payload_bytes"),
        F.col("o_payload_sha1").alias("payload_sha1"), F.col("o_payload").alias("payload"), "refers_key",
    )
    return originals.withColumn("refers_key", F.lit(None).cast("string")).unionByName(found)


def deduplicate_archives(spark: SparkSession, source: str, target: str, date: str, min_payload: int = MIN_PAYLOAD) -> None:
    """Rewrites the archives under ``source`` as deduplicated ones with fresh headers under ``target``;
    what were revisits get their originals' payloads first, so chains of archives collapse."""
    whole = resolve_revisits(materialize(read_archives(spark, source), "records"))
    write_archives(whole, target, date, page="key", payload="payload", min_payload=min_payload)


def round_trip(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", page="page_id", url="url", payload="html", min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``(key, payload_bytes, payload_digest, record_type, refers_to)`` as read back from freshly written archives.

    A row for each row of ``pages``, repeated ones included; null payloads are empty, null keys are never
    revisits, payloads of any length are kept whole, and an empty table gives no row. Other columns are ignored.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path, date, page, url, payload, min_payload)
    records = materialize(read_archives(spark, path, payloads=False), "records")
    kind = pages.schema[page].dataType.simpleString()
    return resolve_revisits(records).select(
        F.col("key").cast(kind).alias("key"), "payload_bytes", F.col("payload_sha1").alias("payload_digest"), "record_type", F.col("refers_key").cast(kind).alias("refers_to")
    )
