"""WARC archives: writing pages as records, and reading archives record by record.

Every record is a gzip member of its own. The reader decompresses an archive in small steps, frames
each record by its content length and checks its digests; it never holds more than one record
beside the compressed archive. Archives are rows of (archive, content), as Spark's ``binaryFile``
source gives them for files on disk.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# An archive is closed once it holds this much; one record is never split.
ARCHIVE_BYTES = 8 * 1024 * 1024
STEP = 64 * 1024
DATE = "2000-01-01T00:00:00Z"  # records carry no time of their own
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVES = "archive string, content binary"
RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string,"
    " refers_to bigint, url string, payload binary, problem string"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member. A revisit states the payload's size in its HTTP header only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    # Line breaks and other controls cannot stand in a header.
    target = "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {page_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        *([f"WARC-Profile: {REVISIT_PROFILE}"] if revisit else []),
        *([f"WARC-Refers-To: {page_urn(refers_to)}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(whole) + packer.flush()


def writer(archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        members: list[bytes] = []
        size = n = 0

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"archive": [f"part-{task:06d}-{n:06d}.warc.gz"], "content": [b"".join(members)]}
            )

        for batch in batches:
            for row in zip(*(batch[c] for c in ("page_id", "url", "payload", "sha1", "refers_to")), strict=True):
                page_id, url, payload, sha1, refers_to = (v.as_py() for v in row)
                digest = base64.b32encode(sha1).decode()
                members.append(record(page_id, url, payload, digest, refers_to))
                size += len(members[-1])
                if size >= archive_bytes:
                    yield archive()
                    members, size, n = [], 0, n + 1
        if members:
            yield archive()

    return run


def build_archives(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """(archive, content) rows that hold one record per page.

    Of pages with equal payloads of at least ``min_revisit_bytes`` bytes the one with the smallest
    id is a response and the others revisit it; repeated rows with that id are all responses, and
    so are pages without any id to refer to. A null payload is the empty one.

    Only digests and ids are grouped, with partial minima, so a payload that a third of all pages
    share costs one short row per task there; the join that brings the answer back to the pages
    can be split by AQE on its many side.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.unhex(F.sha1(payload)).alias("sha1"),
    )
    # What all but a few payloads need is nothing: they are alone.
    shared = (
        rows.filter(F.length("payload") >= min_revisit_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first is not null")
        .select("sha1", "first")
    )
    repeats = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    typed = rows.join(shared, "sha1", "left").select(
        "page_id", "url", "payload", "sha1", F.when(repeats, F.col("first")).alias("refers_to")
    )
    return typed.mapInArrow(writer(archive_bytes), ARCHIVES)


class Reader:
    """The records of one archive, in order, as (header, block, problem)."""

    def __init__(self, content: bytes | memoryview, step: int = STEP):
        self.content, self.step, self.at = memoryview(content), step, 0

    def member(self) -> Iterator[bytes]:
        """The plain bytes of the next gzip member, piece by piece."""
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            piece = self.content[self.at : self.at + self.step]
            if not piece:
                raise EOFError("the archive ends inside a record")
            yield inflate.decompress(piece)
            self.at += len(piece) - len(inflate.unused_data)

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
        while self.at < len(self.content):
            try:
                yield self.one()
            except (EOFError, ValueError, zlib.error) as error:
                # Without its end the next record's beginning is unknown.
                yield {}, b"", f"{type(error).__name__}: {error}"
                return

    def one(self) -> tuple[dict[str, str], bytes, str | None]:
        plain = bytearray()
        pieces = self.member()
        end = -1
        while end < 0:
            piece = next(pieces, None)
            if piece is None:
                raise ValueError("a record without a complete header")
            seen = max(0, len(plain) - 3)
            plain += piece
            end = plain.find(b"\r\n\r\n", seen)
        version, *lines = plain[:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        header = {}
        for line in lines:
            name, _, value = line.partition(":")
            header[name.strip().lower()] = value.strip()
        size = int(header["content-length"]) if header.get("content-length", "").isdigit() else -1
        if size < 0:
            raise ValueError("no content length")
        del plain[: end + 4]
        for piece in pieces:
            plain += piece
            if len(plain) > size + 4:
                raise ValueError("a record longer than its content length")
        if len(plain) != size + 4 or plain[size:] != b"\r\n\r\n":
            raise ValueError("a record shorter than its content length")
        block = bytes(plain[:size])
        stated = header.get("warc-block-digest")
        wrong = stated is not None and stated != f"sha1:{base32_sha1(block)}"
        return header, block, "block digest differs" if wrong else None


def page_record(header: dict[str, str], block: bytes, problem: str | None) -> tuple:
    head, _, body = block.partition(b"\r\n\r\n")
    kind = header.get("warc-type")
    digest = (header.get("warc-payload-digest") or "").removeprefix("sha1:")
    size = len(body)
    if kind == "revisit":
        for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            if name.strip().lower() == "content-length" and value.strip().isdigit():
                size = int(value)
    elif header and digest != base32_sha1(body):
        problem = problem or "payload digest differs"
    return (
        page_of(header.get("warc-record-id")),
        size,
        digest or None,
        kind,
        page_of(header.get("warc-refers-to")),
        header.get("warc-target-uri"),
        None if kind == "revisit" or not header else body,
        problem,
    )


def read_archives(
    archives: DataFrame, content_col: str = "content", with_payload: bool = True
) -> DataFrame:
    """One row per record, in the columns of ``RECORDS``; archives are read where they lie.

    ``problem`` tells of digests that differ and, as the last row of an archive, of a record that
    cannot be framed; what stands before it is kept. An empty or null archive has no records.
    A revisit has the size and digest of the payload it refers to and no payload.
    """
    names = [x.strip().split(" ")[0] for x in RECORDS.split(",")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                for found in Reader(content.as_buffer() if content.is_valid else b""):
                    row = page_record(*found)
                    if not with_payload:
                        row = (*row[:6], None, row[7])
                    rows.append(dict(zip(names, row, strict=True)))
                    held += len(row[6] or b"") + 200
                    if held > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select(F.col(content_col).alias("content")).mapInArrow(run, RECORDS)
