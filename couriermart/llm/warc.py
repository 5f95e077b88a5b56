"""WARC archives that are written and read in bounded pieces.

A payload longer than a chunk becomes a response record and ``continuation`` records, as
WARC/1.1 segments them, so that no record in an archive is longer than a chunk. Every
record ends with two line breaks, which makes an archive a text file of one row per record
with that separator: Spark's own writer and reader move the bytes, to whatever store the
path names, and Python tasks only frame and parse them, piece by piece.

Reading gives a table of chunks: record id, chunk number, bytes, and the digest and length
of the payload so far, so that the last chunk carries those of the whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of payload that a record holds at most.
CHUNK_BYTES = 1 << 20
#: Shorter payloads are always stored as they are.
LEAST_REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
BREAK = b"\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
#: Rows of one Arrow batch that leave a task hold about so many bytes.
BATCH_BYTES = 4 << 20

CHUNKS = (
    "record_id string, page_id long, url string, record_type string, refers_to long, chunk_no int, chunk binary, "
    "payload_bytes long, payload_digest string, last boolean"
)


def find_revisits(pages: DataFrame, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, refers_to``: whose payload a page repeats.

    Of pages with equal payloads, the smallest ``page_id`` keeps its payload. Rows with
    that same id all keep it; a group that has only NULL ids repeats nothing. The groups
    are counted before anything is joined, and only ids and digests of repeated payloads
    go into the join; a frequent payload is split by Spark's skew handling.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    hashed = pages.select(
        "page_id",
        "url",
        "html",
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha2(html, 256).alias("payload_digest"),
    )
    firsts = (
        hashed.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
        .drop("n")
    )
    repeats = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return hashed.join(firsts, "payload_digest", "left").select(
        "page_id", "url", "html", "payload_bytes", "payload_digest", F.when(repeats, F.col("first_id")).alias("refers_to")
    )


def _record_id(page_id: int | None, url: str | None, segment: int) -> str:
    digest = hashlib.md5(f"{page_id}|{url}|{segment}".encode()).hexdigest()
    return f"<urn:uuid:{digest[:8]}-{digest[8:12]}-{digest[12:16]}-{digest[16:20]}-{digest[20:]}>"


def _frame(kind: str, headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}"]
    lines += [f"{name}: {value}" for name, value in headers if value is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + BREAK + block


def _records(page_id, url, html: memoryview, digest, size, refers_to, chunk_bytes: int) -> Iterator[bytes]:
    """The records of one page."""
    name = _record_id(page_id, url, 1)
    about = [
        ("WARC-Record-ID", name),
        ("WARC-Target-URI", None if url is None else quote(url, safe="%/:?&=#+,;@!$'()*[]~")),
        ("X-Page-ID", page_id),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", size),
    ]
    if refers_to is not None:
        about += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("X-Refers-To-Page-ID", refers_to),
        ]
        yield _frame("revisit", about, b"")
        return
    total = len(HTTP_HEAD) + len(BREAK) + size
    cuts = range(0, max(size, 1), chunk_bytes)
    if len(cuts) > 1:
        about.append(("WARC-Segment-Number", 1))
    about.append(("Content-Type", "application/http;msgtype=response"))
    for number, start in enumerate(cuts, 1):
        piece = bytes(html[start : start + chunk_bytes])
        if number == 1:
            yield _frame("response", about, HTTP_HEAD + BREAK + piece)
            continue
        more = [
            ("WARC-Record-ID", _record_id(page_id, url, number)),
            ("WARC-Segment-Origin-ID", name),
            ("WARC-Segment-Number", number),
            ("WARC-Segment-Total-Length", total if number == len(cuts) else None),
        ]
        yield _frame("continuation", more, piece)


def write_warc(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write a record per row of ``pages (page_id, url, html)`` as gzipped archives below ``path``.

    A NULL page is an empty payload, NULL ids and URLs are left out of the header. Further
    columns are ignored; repeated rows get records of their own.
    """

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            fields = [batch.column(name) for name in ("page_id", "url", "html", "payload_digest", "payload_bytes", "refers_to")]
            for row in range(batch.num_rows):
                page_id, url, html, digest, length, refers_to = (f[row] for f in fields)
                # The value's own buffer, so that a payload is not copied whole.
                payload = memoryview(html.as_buffer() or b"") if html.is_valid else memoryview(b"")
                for record in _records(
                    page_id.as_py(), url.as_py(), payload, digest.as_py(), length.as_py(), refers_to.as_py(), chunk_bytes
                ):
                    held.append(record)
                    size += len(record)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])

    framed = find_revisits(pages).mapInArrow(frame, "value binary")
    framed.select(F.col("value").cast("string")).write.option("lineSep", BREAK.decode()).option(
        "compression", "gzip"
    ).text(path)


class _Parser:
    """Turns an archive's pieces, which end at double line breaks, into chunks."""

    def __init__(self) -> None:
        self.headers: dict[bytes, bytes] | None = None
        self.wanted = self.got = self.skip = 0
        self.block: list[bytes] = []
        self.record: dict | None = None

    def feed(self, piece: bytes) -> dict | None:
        """A finished chunk, if ``piece`` ends one."""
        if self.skip:
            piece, self.skip = piece[self.skip :], 0
        if self.headers is None:
            if not piece:
                return None
            self.headers = dict(
                (name.strip().lower(), value.strip())
                for name, _, value in (line.partition(b":") for line in piece.split(b"\r\n")[1:])
            )
            self.wanted, self.got, self.block = int(self.headers[b"content-length"]), 0, []
            return None
        self.block.append(piece)
        self.got += len(piece)
        if self.got < self.wanted:
            self.block.append(BREAK)
            self.got += len(BREAK)
            if self.got <= self.wanted:
                return None
            # The block ends with part of a double break, so the one behind the record was found too early.
            self.skip = len(BREAK) - (self.got - self.wanted)
        headers, block = self.headers, b"".join(self.block)[: self.wanted]
        self.headers, self.block = None, []
        return self._chunk(headers, block)

    def _chunk(self, headers: dict[bytes, bytes], block: bytes) -> dict:
        kind = headers[b"warc-type"].decode()
        if kind != "continuation":
            number = lambda name: int(headers[name]) if name in headers else None
            self.record = {
                "record_id": headers[b"warc-record-id"].decode(),
                "page_id": number(b"x-page-id"),
                "url": headers[b"warc-target-uri"].decode() if b"warc-target-uri" in headers else None,
                "record_type": kind,
                "refers_to": number(b"x-refers-to-page-id"),
            }
            self.hash, self.size, self.chunk_no = hashlib.sha256(), 0, 0
            self.segmented = b"warc-segment-number" in headers
            if kind == "revisit":
                digest = headers[b"warc-payload-digest"].decode().removeprefix("sha256:")
                return self.record | {
                    "chunk_no": 1, "chunk": b"", "payload_bytes": number(b"x-payload-length"), "payload_digest": digest, "last": True,
                }
            block = block[block.index(BREAK) + len(BREAK) :]
        self.hash.update(block)
        self.size += len(block)
        self.chunk_no += 1
        return self.record | {
            "chunk_no": self.chunk_no,
            "chunk": block,
            "payload_bytes": self.size,
            "payload_digest": self.hash.hexdigest(),
            "last": not self.segmented or b"warc-segment-total-length" in headers,
        }


def read_warc(spark: SparkSession, path: str, chunks: bool = True) -> DataFrame:
    """The chunk table of the archives below ``path``; without ``chunks`` only the last row of each
    record and no bytes, which is what digests and lengths need.

    An archive is read by one task from its start, so its size is what bounds a task; a
    record in it is held one chunk at a time.
    """
    schema = pa.schema(
        [
            ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
            ("refers_to", pa.int64()), ("chunk_no", pa.int32()), ("chunk", pa.binary()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("last", pa.bool_()),
        ]
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, held, size = _Parser(), [], 0
        for batch in batches:
            for piece in batch.column(0):
                chunk = parser.feed(piece.as_py())
                if chunk is None or not (chunks or chunk["last"]):
                    continue
                if not chunks:
                    chunk["chunk"] = None
                held.append(chunk)
                size += 500 + len(chunk["chunk"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    lines = spark.read.option("lineSep", BREAK.decode()).text(path)
    return lines.select(F.col("value").cast("binary")).mapInArrow(parse, CHUNKS)
