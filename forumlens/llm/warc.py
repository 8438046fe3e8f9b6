"""WARC archives of pages: payloads as chunk rows with running digests, repeated payloads as revisits."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm.common import stage
from forumlens.session import checkpoint_dir

#: Payload bytes of one chunk; longer payloads become segmented records.
CHUNK = 1 << 20
#: Payloads below this are always stored.
MIN_REVISIT = 100
GAP = b"\r\n\r\n"
#: Records are gathered to about this many bytes before a task hands them on.
FLUSH = 4 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunks(payload: memoryview, size: int) -> Iterator[tuple[int, memoryview, str, bool]]:
    """(chunk number from 1, bytes, SHA-256 of the payload so far, whether it is the last); cut between characters."""
    digest, at, number = hashlib.sha256(), 0, 0
    while True:
        end = min(len(payload), at + size)
        while end < len(payload) and payload[end] & 0xC0 == 0x80:
            end -= 1
        if end <= at and end < len(payload):
            raise ValueError("a chunk holds less than one character")
        digest.update(payload[at:end])
        number += 1
        yield number, payload[at:end], digest.hexdigest(), end == len(payload)
        if end == len(payload):
            return
        at = end


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _head(fields: list[tuple[str, str]], length: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + GAP


def records(page: int | None, url: str | None, payload: memoryview, digest: str, refers: int | None, size: int) -> Iterator[bytes]:
    """The WARC records of a page, without the gap that follows each: one, or one for each chunk."""
    own = f"<urn:page:{'null' if page is None else page}>"
    target = [] if url is None else [("WARC-Target-URI", _uri(url))]
    reply = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + GAP
    common = [("WARC-Date", DATE), *target, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Refers-To", f"<urn:page:{refers}>"), ("WARC-Profile", PROFILE)]
        yield _head(fields + common, len(reply)) + reply
        return
    for number, data, _, last in chunks(payload, size):
        if number == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common]
            block = reply
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{number}>"), ("WARC-Date", DATE)]
            fields.append(("WARC-Segment-Origin-ID", own))
            block = b""
        if not (number == 1 and last):
            fields.append(("WARC-Segment-Number", str(number)))
            if last:
                fields.append(("WARC-Segment-Total-Length", str(len(reply) + len(payload))))
        yield b"".join((_head(fields, len(block) + len(data)), block, data))


def _written(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        held_bytes = 0
        for batch in batches:
            small = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")]
            for row, payload in enumerate(batch.column("payload")):
                page, url, digest, refers = (c[row] for c in small)
                for record in records(page, url, memoryview(payload.as_buffer()), digest, refers, size):
                    held.append(record)
                    held_bytes += len(record)
                    if held_bytes >= FLUSH:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).cast(pa.string())], names=["value"])
                        held, held_bytes = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()).cast(pa.string())], names=["value"])

    return run


def write_archives(pages: DataFrame, folder: str, chunk_bytes: int = CHUNK) -> None:
    """Write a WARC record for each row of `pages` (page_id, url, html) to gzip archives under `folder`.

    Of rows with equal payloads of 100 bytes or more, that with the smallest page_id is stored and the others
    are revisit records of it; null html is an empty payload, null urls have no target, a page_id that repeats
    with an equal payload is stored each time, and rows without a page_id are never referred to. A payload
    longer than `chunk_bytes` becomes a segmented record, so neither side ever builds it in one piece.
    Archives are text files in Spark's sense, committed by its writer: a lost task leaves nothing behind.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).withColumn(
        "digest", F.sha2(F.col("payload").cast("binary"), 256)
    )
    again = stage(
        rows.where(F.octet_length("payload") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    placed = rows.join(again, "digest", "left").withColumn(
        "refers_to", F.when(F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()), F.col("first"))
    )
    lines = placed.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(_written(chunk_bytes), "value string")
    lines.write.option("lineSep", GAP.decode()).option("compression", "gzip").text(folder)


class Reader:
    """Reads records from the bytes of an archive as they come, holding one header or one piece of a block."""

    def __init__(self):
        self.rest = b""
        self.left: int | None = None
        self.fields: dict[str, str] = {}
        self.reply: dict[str, str] | None = None
        self.page: dict = {}
        self.digest = hashlib.sha256()

    def feed(self, data: bytes) -> Iterator[dict]:
        """Chunk rows: page_id, chunk, bytes and digest of the payload so far, last, and the record's fields."""
        self.rest += data
        while True:
            if self.left is None:
                if self.rest[:4] == GAP or (self.rest[:2] == b"\r\n" and len(self.rest) > 2):
                    self.rest = self.rest[2:]
                    continue
                end = self.rest.find(GAP)
                if end <= 0:
                    return
                self.fields = _fields(self.rest[:end])
                self.rest = self.rest[end + 4 :]
                self.left = int(self.fields["content-length"])
                self.reply = None if self.fields["warc-type"] != "continuation" else {}
                if self.reply is None:
                    self.digest = hashlib.sha256()
                    self.page = {"fields": self.fields, "bytes": 0, "chunk": 0}
                elif self.fields["warc-segment-origin-id"] != self.page["fields"]["warc-record-id"]:
                    raise ValueError(f"segment of {self.fields['warc-segment-origin-id']} out of place")
            if self.reply is None:
                end = self.rest.find(GAP)
                if end < 0:
                    return
                self.reply = _fields(self.rest[:end])
                self.left -= end + 4
                self.rest = self.rest[end + 4 :]
                self.page["length"] = int(self.reply["content-length"])
            piece = self.rest[: self.left]
            self.digest.update(piece)
            self.page["bytes"] += len(piece)
            self.rest = self.rest[len(piece) :]
            self.left -= len(piece)
            if self.left:
                return
            self.left = None
            self.page["chunk"] += 1
            yield self._row()

    def _row(self) -> dict:
        first, number = self.page["fields"], self.fields.get("warc-segment-number")
        last = number is None or "warc-segment-total-length" in self.fields
        declared = first["warc-payload-digest"].removeprefix("sha256:")
        revisit = first["warc-type"] == "revisit"
        so_far = declared if revisit else self.digest.hexdigest()
        if last and not revisit and (so_far != declared or self.page["bytes"] != self.page["length"]):
            raise ValueError(f"payload of {first['warc-record-id']} differs from its digest")
        return {
            "page_id": _page(first["warc-record-id"]),
            "chunk": self.page["chunk"],
            "upto_bytes": self.page["length"] if revisit else self.page["bytes"],
            "upto_digest": so_far,
            "last": last,
            "record_type": first["warc-type"],
            "refers_to": _page(first["warc-refers-to"]) if revisit else None,
        }


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(": ") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value for name, _, value in pairs}


def _page(record: str) -> int | None:
    number = record.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "null" else int(number)


ROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("chunk", pa.int64()),
        ("upto_bytes", pa.int64()),
        ("upto_digest", pa.string()),
        ("last", pa.bool_()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = Reader()
    for batch in batches:
        rows = []
        for line in batch.column("value"):
            rows += reader.feed(line.as_buffer().to_pybytes() + GAP)
        yield pa.RecordBatch.from_pylist(rows, schema=ROW)
    if reader.left:
        raise ValueError("an archive ends inside a record")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per chunk of every record under `folder`, each payload checked against its digest.

    Columns: page_id, chunk (from 1), upto_bytes and upto_digest (of the payload up to this chunk; of the
    whole payload for a revisit), last, record_type, refers_to. An archive is read by one task in its order.
    """
    lines = spark.read.option("lineSep", GAP.decode()).text(folder)
    schema = (
        "page_id long, chunk long, upto_bytes long, upto_digest string, last boolean, record_type string, refers_to long"
    )
    return lines.mapInArrow(_read, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write `pages` to archives in the shared folder and list what they hold, one row per page."""
    spark = pages.sparkSession
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder)
    return read_archives(spark, folder).where("last").select(
        "page_id",
        F.col("upto_bytes").alias("payload_bytes"),
        F.col("upto_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
