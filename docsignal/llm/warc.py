"""WARC archives compressed with Zstandard: a writer and a checking reader.

An archive is a run of Zstandard frames.  The first may be a skippable frame (magic 0x184D2A5D)
holding the dictionary, plain or itself compressed; every other frame holds exactly one record.
Frame ends are found from block headers, so a reader can start at any frame offset.

Archives travel as rows ``(path, content)``, the form in which ``spark.read.format("binaryFile")``
gives files; ``write_archives`` makes such rows, to be saved by any Spark writer.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docsignal.llm.common import key_back, key_column, map_batches, materialize

# Fixed values of the formats.
FRAME_MAGIC, DICTIONARY_MAGIC = 0xFD2FB528, 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSION = "WARC/1.1"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 16 << 20  # of uncompressed payload
DICTIONARY_BYTES, SAMPLE_RECORDS = 16 << 10, 256
PAGE_ID = "urn:page:"

ARCHIVES = "path string, length long, content binary"
RECORDS = (
    "path string, offset long, record_type string, record_id string, target_uri string, date string,"
    " refers_to_id string, payload_bytes long, payload_digest string, payload binary, error string"
)


class ArchiveError(ValueError):
    """An archive or record that breaks the format."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- frames -------------------------------------------------------------------------------------


def frames(data: memoryview) -> Iterator[tuple[int, int, int]]:
    """``(magic, start, end)`` of every frame; for skippable frames the span of their content."""
    at, size = 0, len(data)

    def need(end: int) -> int:
        if end > size:
            raise ArchiveError(f"frame at {at} runs past the end of the archive")
        return end

    while at < size:
        need(at + 8)
        magic, length = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            end = need(at + 8 + length)
            yield magic, at + 8, end
        elif magic == FRAME_MAGIC:
            end = need(_blocks_end(data, at, need))
            yield magic, at, end
        else:
            raise ArchiveError(f"no frame starts at {at}")
        at = end


def _blocks_end(data: memoryview, at: int, need) -> int:
    descriptor = data[at + 4]
    single, checksum = descriptor >> 5 & 1, descriptor >> 2 & 1
    content_size = (single, 2, 4, 8)[descriptor >> 6]
    p = at + 5 + (1 - single) + (0, 1, 2, 4)[descriptor & 3] + content_size
    last = 0
    while not last:
        need(p + 3)
        header = int.from_bytes(data[p : p + 3], "little")
        last, kind, length = header & 1, header >> 1 & 3, header >> 3
        if kind == 3:
            raise ArchiveError(f"reserved block type at {p}")
        p = need(p + 3 + (1 if kind == 1 else length))
    return p + 4 * checksum


def load_dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    """The dictionary of a leading skippable frame's content, which may itself be compressed."""
    if content[:4] == struct.pack("<I", FRAME_MAGIC):
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return zstandard.ZstdCompressionDict(content)


# ---- records ------------------------------------------------------------------------------------


def build_record(headers: Sequence[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one whole record; fails unless every byte is accounted for."""
    head, found, rest = record.partition(b"\r\n\r\n")
    if not found:
        raise ArchiveError("record without end of headers")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] not in (VERSION, "WARC/1.0"):
        raise ArchiveError(f"unknown version line {lines[0][:40]!r}")
    headers = _headers(lines[1:])
    for name in REQUIRED:
        if name.lower() not in headers:
            raise ArchiveError(f"record without {name}")
    length = headers["content-length"]
    if not (length.isascii() and length.isdigit()):
        raise ArchiveError(f"Content-Length {length[:40]!r} is no number")
    block = rest[: int(length)]
    if len(block) != int(length):
        raise ArchiveError(f"Content-Length {length}, but {len(block)} bytes")
    if rest[int(length) :] != b"\r\n\r\n":
        raise ArchiveError("record does not end after its block")
    return headers, block


def _headers(lines: Sequence[str]) -> dict[str, str]:
    headers: dict[str, str] = {}
    for line in lines:
        name, found, value = line.partition(":")
        if not found or not name or name != name.strip():
            raise ArchiveError(f"bad header line {line[:40]!r}")
        headers[name.lower()] = value.strip()
    return headers


def read_record(record: bytes) -> dict[str, object]:
    """The fields of one record, with lengths and digests checked."""
    headers, block = parse_record(record)
    kind = headers["warc-type"]
    row: dict[str, object] = {
        "record_type": kind, "record_id": headers["warc-record-id"], "date": headers["warc-date"],
        "target_uri": headers.get("warc-target-uri"), "refers_to_id": headers.get("warc-refers-to"),
    }
    block_digest = headers.get("warc-block-digest")
    if block_digest and block_digest != "sha1:" + digest_of(block):
        raise ArchiveError("block digest differs")
    if kind not in ("response", "revisit"):
        return row | {"payload_bytes": len(block), "payload": block}
    status, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        raise ArchiveError("HTTP headers without end")
    http = _headers(status.decode("utf-8").split("\r\n")[1:])
    row["payload_bytes"] = int(http.get("content-length", len(payload)))
    row["payload_digest"] = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response":
        if row["payload_bytes"] != len(payload):
            raise ArchiveError("payload length differs from the HTTP header")
        if row["payload_digest"] not in (None, digest_of(payload)):
            raise ArchiveError("payload digest differs")
        row["payload"] = payload
    elif payload or not row["refers_to_id"]:
        raise ArchiveError("revisit with a payload or without what it refers to")
    return row


def read_archive(content: bytes) -> Iterator[tuple[int, dict[str, object]]]:
    """``(offset, fields)`` of every record; broken records give ``{"error": ...}``.

    A broken frame chain ends the archive with an error row, since later frames cannot be found.
    """
    view, decoder, at = memoryview(content), zstandard.ZstdDecompressor(), 0
    try:
        for n, (magic, start, end) in enumerate(frames(view)):
            at = start
            if magic in SKIPPABLE:
                if magic == DICTIONARY_MAGIC and n == 0:
                    decoder = zstandard.ZstdDecompressor(load_dictionary(bytes(view[start:end])))
                continue
            try:
                record = decoder.decompressobj().decompress(view[start:end])
                yield start, read_record(record)
            except (ArchiveError, zstandard.ZstdError, UnicodeDecodeError, ValueError) as error:
                yield start, {"error": f"{type(error).__name__}: {error}"}
    except (ArchiveError, zstandard.ZstdError) as error:
        yield at, {"error": f"{type(error).__name__}: {error}"}


# ---- tables -------------------------------------------------------------------------------------


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of archives ``(path, content)`` as rows of ``RECORDS``.

    Every record is decoded from its own frame and checked; ``error`` says what is wrong with a
    record that fails.  NULL or empty content gives no rows.
    """
    names = [c.split()[0] for c in RECORDS.split(",")]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for offset, fields in read_archive(content.as_py() or b""):
                    rows.append({"path": path.as_py(), "offset": offset} | fields)
                    held += len(fields.get("payload") or b"")
                    if held >= 4 << 20 or len(rows) >= 5000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return map_batches(archives.select("path", "content"), run, RECORDS)


def write_archives(
    records: DataFrame,
    archive_bytes: int = ARCHIVE_BYTES,
    level: int = 3,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Archives ``(path, length, content)`` of ``(page_id, url, payload, digest, refers_to)`` rows.

    Each task fills archives of about ``archive_bytes`` payload.  The dictionary of an archive is
    fitted on its first ``SAMPLE_RECORDS`` payloads; too few or too short ones give none.
    """

    def archive(rows: list[tuple], number: int) -> tuple[str, bytes]:
        samples = [r[2] for r in rows[:SAMPLE_RECORDS] if r[2]]
        parts, dictionary = [], None
        try:
            if len(samples) >= 16:
                dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
        except zstandard.ZstdError:
            dictionary = None
        if dictionary is not None:
            raw = dictionary.as_bytes()
            parts.append(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        encode = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{number:05d}.warc.zst"
        info = build_record(
            [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{name}>"),
             ("WARC-Date", date), ("Content-Type", "application/warc-fields")],
            b"software: docsignal\r\nformat: WARC File Format 1.1\r\n",
        )
        parts.append(encode.compress(info))
        parts += [encode.compress(page_record(*r, date=date)) for r in rows]
        return name, b"".join(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, number = [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal rows, held, number
            name, content = archive(rows, number)
            rows, held, number = [], 0, number + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(content)]), pa.array([content], pa.binary())],
                names=["path", "length", "content"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append(row)
                held += len(row[2])
                if held >= archive_bytes:
                    yield flush()
        if rows:
            yield flush()

    return map_batches(
        records.select("page_id", "url", "payload", "digest", "refers_to"), run, ARCHIVES
    )


def page_record(
    page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str
) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [("WARC-Type", "response" if refers_to is None else "revisit")]
    headers += [("WARC-Record-ID", f"<{PAGE_ID}{page_id}>"), ("WARC-Date", date)]
    if url:
        headers.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    headers.append(("Content-Type", "application/http; msgtype=response"))
    headers.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    block = http.encode()
    if refers_to is None:
        block += payload
    else:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{PAGE_ID}{refers_to}>")]
    headers.append(("WARC-Block-Digest", f"sha1:{digest_of(block)}"))
    return build_record(headers, block)


def page_records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, digest, refers_to)`` of all pages, equal payloads revisited.

    Of payloads of at least ``min_revisit_bytes`` bytes that are equal (by digest and length), the
    one with the smallest page_id is the response; the others carry its page_id in ``refers_to``.

    NULL html is an empty payload, NULL url no target.  A NULL page_id is smaller than any other.
    Rows repeated with one page_id and payload are each written, all as responses if that page is
    the first.  Other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payload = batch.column(2).cast(pa.large_binary()).fill_null(b"").cast(pa.binary())
            digest = pa.array([digest_of(p.as_buffer()) for p in payload], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), payload, digest],
                names=["page_id", "url", "payload", "digest"],
            )

    rows = map_batches(
        pages.select(key_column("page_id").alias("page_id"), "url", "html"),
        run,
        "page_id long, url string, payload binary, digest string",
    )
    # Only keys and digests are grouped and joined by digest, which copies may make hot; payloads
    # are joined by page, which is even.
    size = F.octet_length("payload").cast("long")
    thin = rows.where(size >= min_revisit_bytes).select("page_id", "digest", size.alias("n"))
    first = thin.groupBy("digest", "n").agg(
        F.min("page_id").alias("refers_to"), F.count("*").alias("rows")
    )
    links = (
        thin.join(first.where("rows > 1"), ["digest", "n"])
        .where("page_id != refers_to")
        .select("page_id", "digest", "refers_to")
        .distinct()
    )
    return rows.join(links, ["page_id", "digest"], "left")


def archive_pages(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read the records back."""
    archives = write_archives(page_records(pages, min_revisit_bytes))
    return read_archives(materialize(archives, "warc"))


def page_of(record_id: str) -> F.Column:
    """The page_id in a record id ``<urn:page:N>``."""
    number = F.regexp_extract(record_id, rf"^<{PAGE_ID}(-?\d+)>$", 1)
    return F.nullif(number, F.lit("")).cast("long")


def page_summary(records: DataFrame) -> DataFrame:
    """What the archives say of each page; any broken record fails the job."""
    sound = F.when(F.col("error").isNull(), F.col("record_type")).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("broken record:"), "path", "error"))
    )
    rows = records.withColumn("record_type", sound).where("record_type in ('response', 'revisit')")
    rows = rows.withColumns({"page_id": page_of("record_id"), "refers_to": page_of("refers_to_id")})
    return rows.select(
        key_back("page_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        key_back("refers_to").alias("refers_to"),
    )


