"""WARC archives: one gzip member per record, written by tasks and read sequentially.

Of records with equal payloads of at least ``MIN_SHARED`` bytes the one with the smallest id is a response and the
others are revisits that name it; smaller payloads are all responses. Every record carries the SHA-256 of the full
payload. The reader inflates member by member with a bounded buffer, frames the block by Content-Length and verifies
the digest of every response.

Defined results: a null payload is the empty one; a null id gets no number in its record and revisits the smallest
known id with its payload (with none, it is a response); rows that repeat an id and its payload are each what that id
is; an empty table gives no files. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from flowlab.llm.files import create, reader, spread
from flowlab.llm.tables import batch_of, written
from flowlab.storage import scratch_path

MIN_SHARED = 100
FILE_BYTES = 256 << 20
LEVEL = 6
CHUNK = 1 << 16
HEAD_LIMIT = 1 << 20

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

URN = "urn:page:"


class WarcError(ValueError):
    """An archive that is cut short, badly framed, or whose payload does not match its digest."""


# ---------------------------------------------------------------- records


def field(value: str) -> str:
    """A header value on one line: what would end the line is percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None, serial: str) -> bytes:
    """The bytes of a record; ``original`` is the response that a revisit refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original is not None else http + payload
    lines = [
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: <{URN}{serial if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {field(url)}")
    if original is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{URN}{original}>"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Members:
    """The gzip members of a stream, inflated a chunk at a time."""

    def __init__(self, source: BinaryIO):
        self.source, self.ahead, self.offset = source, b"", 0

    def __iter__(self) -> Iterator[tuple[int, Iterator[bytes]]]:
        """The start of each member in the file and its inflated chunks, which must be used up in turn."""
        while self.ahead or self._more():
            yield self.offset, self._inflated()

    def _more(self) -> bool:
        self.ahead = bytes(self.source.read(CHUNK))
        return bool(self.ahead)

    def _inflated(self) -> Iterator[bytes]:
        unpacker = zlib.decompressobj(31)
        while not unpacker.eof:
            if not self.ahead and not self._more():
                raise WarcError(f"the member at {self.offset} is cut short")
            before = len(self.ahead)
            try:
                out = unpacker.decompress(self.ahead, CHUNK)
            except zlib.error as broken:
                raise WarcError(f"the member at {self.offset} is not gzip: {broken}") from broken
            self.ahead = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
            self.offset += before - len(self.ahead)
            if out:
                yield out


def framed(chunks: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record: the block has exactly Content-Length bytes."""
    data = bytearray()
    cut = -1
    for chunk in chunks:
        data += chunk
        cut = data.find(b"\r\n\r\n")
        if cut >= 0 or len(data) > HEAD_LIMIT:
            break
    if cut < 0 or not data.startswith(b"WARC/1."):
        raise WarcError("a record without a WARC head")
    headers = {}
    for line in bytes(data[:cut]).decode("utf-8").split("\r\n")[1:]:
        name, found, value = line.partition(":")
        if not found:
            raise WarcError(f"not a header: {line[:80]}")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise WarcError("a record without Content-Length")
    size, rest = int(length), data[cut + 4:]
    for chunk in chunks:
        rest += chunk
        if len(rest) > size + 4:
            raise WarcError("a block longer than its Content-Length")
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError("a block that does not end where Content-Length says")
    return headers, bytes(rest[:size])


def records(source: BinaryIO) -> Iterator[dict]:
    """Every record of an archive in order; raises ``WarcError`` at the first that is not whole."""
    for offset, chunks in Members(source):
        headers, block = framed(chunks)
        head, _, payload = block.partition(b"\r\n\r\n")
        kind, digest = headers.get("warc-type"), headers.get("warc-payload-digest", "").removeprefix("sha256:")
        if kind == "revisit":
            sizes = [v for n, _, v in (x.partition(b":") for x in head.split(b"\r\n")) if n.lower() == b"content-length"]
            size, payload = int(sizes[0]) if sizes else None, None
        else:
            size = len(payload)
            if hashlib.sha256(payload).hexdigest() != digest:
                raise WarcError(f"the payload at {offset} does not match its digest")
        yield {
            "record_type": kind, "record_id": headers.get("warc-record-id", "").strip("<>"), "url": headers.get("warc-target-uri"),
            "payload": payload, "payload_bytes": size, "payload_digest": digest,
            "refers_to": headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None, "offset": offset,
        }


# ---------------------------------------------------------------- Spark


def originals(pages: DataFrame, min_shared: int) -> DataFrame:
    """``page, digest, original``: for each id and payload that others share, the smallest id that has the payload."""
    shared = pages.filter(F.octet_length("payload") >= min_shared).select("page", F.sha2("payload", 256).alias("digest"))
    groups = shared.groupBy("digest").agg(F.min("page").alias("original"), F.count("*").alias("n")).filter("n > 1")
    return shared.join(groups.select("digest", "original"), "digest").filter(
        "original is not null and not (page <=> original)"
    ).dropDuplicates(["page", "digest"])


def write_warc(
    pages: DataFrame, folder: str, *, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_shared: int = MIN_SHARED, file_bytes: int = FILE_BYTES, level: int = LEVEL,
) -> DataFrame:
    """Writes a record per row; returns the manifest ``path, records, bytes``."""
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.encode(F.col(f"`{html}`").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    # Digests alone are shuffled to find copies; a page meets its original by its own id and digest.
    first = written(originals(rows, min_shared), "warc-originals").select(F.col("page").alias("p"), F.col("digest").alias("d"), "original")
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows = rows.join(first, F.col("page").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left").select(
        "page", "url", "payload", "digest", "original"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lines, out, serial = TaskContext.get().partitionId(), [], None, 0
        path, count, size = "", 0, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path, out = create(folder, ".warc.gz")
                    count = size = 0
                serial += 1
                data = member(record(*row, f"none-{part}-{serial}"), level)
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= file_bytes:
                    out.close()
                    lines.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            lines.append((path, count, size))
        if lines:
            yield batch_of(manifest, *zip(*lines))

    manifest = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
    return written(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


RECORD = (
    "record_type string, record_id string, url string, payload binary, payload_bytes long, payload_digest string, "
    "refers_to string, offset long"
)


def read_warc(spark_paths: DataFrame, path: str = "path", payloads: bool = True) -> DataFrame:
    """Every record of the archives named by a column, one task for a file at a time. ``payloads=False`` reads and
    verifies the payloads but does not return them."""
    files = spread(spark_paths.select(F.col(f"`{path}`").alias("path")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch.column(0).to_pylist():
                with reader(place) as source:
                    rows, held = [], 0
                    for r in records(source):
                        held += len(r["payload"] or b"") + 500
                        if not payloads:
                            r["payload"] = None
                        rows.append(r)
                        if held >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([
        ("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()), ("payload", pa.binary()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("offset", pa.int64()),
    ])
    return files.mapInArrow(read, RECORD)


def page_number(name):
    """The number in a record's name; null where it has none."""
    return F.expr(f"try_cast(substring({name}, {len(URN) + 1}) as bigint)")


def warc_round_trip(pages: DataFrame, payloads: bool = False, **options) -> DataFrame:
    """Records as read back from the archives just written, with ``page_id`` and ``original`` as numbers."""
    manifest = write_warc(pages, scratch_path(pages.sparkSession, "warc"), **options)
    found = read_warc(manifest, payloads=payloads)
    return found.withColumns({"page_id": page_number("record_id"), "original": page_number("refers_to")})
