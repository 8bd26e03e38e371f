"""Archives of web pages: WARC records in Zstandard frames that share a dictionary.

Equal payloads are found by digest before anything is written: of each set of
equal ones one record is a response, the others are revisits that name it. Each
task then fills archives of a bounded size. An archive begins with a skippable
frame that holds a dictionary trained on a sample of its own records; every
record is a frame of its own after it, so a reader that knows a frame's place
opens one record alone, and needs nothing but the archive.

Archives are written by Spark's text writer, that is through any file system
that Spark reaches and by its commit protocol: a task that is repeated replaces
what it had written. The writer's line separator is an empty skippable frame,
which readers of Zstandard pass over.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.shared import marked
from strata.session import extracted

#: Payloads below this many bytes are never revisits.
LEAST_REVISIT = 1000
#: Bytes of records of an archive, before compression; a larger record has an archive of its own.
ARCHIVE_BYTES = 64_000_000
#: Bytes of records that a dictionary is trained on, and of the dictionary.
SAMPLE_BYTES, DICTIONARY_BYTES = 4_000_000, 112_640
#: Bytes of records that one Arrow batch gives on.
BATCH_BYTES = 8_000_000
LEVEL = 3
#: The frame that holds a dictionary, an empty frame to pass over, the magic numbers of frames.
DICTIONARY_FRAME, PASSED_OVER, FRAME = 0x184D2A5D, b"P*M\x18\x00\x00\x00\x00", 0xFD2FB528
#: Fixed value: the profile of a revisit by payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("8c5f1f52-0d0e-4a44-9d0e-2f6c1f6a7a11")
_TYPES = ("response", "revisit")

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def payload(html: Column) -> Column:
    """The bytes of a page; none for null."""
    return F.coalesce(html.cast("binary"), F.lit(b""))


def repeated_payloads(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The repeated payloads (key, leader): those that two or more rows have, with the largest id."""
    body = payload(F.col(html_col))
    held = pages.select(F.col(id_col).alias("id"), F.sha2(body, 256).alias("key")).filter(F.octet_length(body) >= LEAST_REVISIT)
    return held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("leader")).filter("n > 1").drop("n")


def records(pages: DataFrame, repeated: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, payload, record_type, refers_to) for each page, ids as strings.

    Pages that no other page equals are dealt by their own digests, those below
    the size of revisits by id and address, so that no key gathers them.
    """
    body = payload(F.col(html_col))
    alone = F.concat(F.lit("-"), F.xxhash64(marked(F.col(id_col)), marked(F.col(url_col)), F.col(html_col)).cast("string"))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        body.alias("payload"),
        F.when(F.octet_length(body) >= LEAST_REVISIT, F.sha2(body, 256)).otherwise(alone).alias("key"),
    )
    found = rows.join(repeated, "key", "left")
    again = F.col("leader").isNotNull() & ~F.col("leader").eqNullSafe(F.col("id"))
    return found.select(
        F.col("id").cast("string").alias("id"),
        "url",
        "payload",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("leader").cast("string")).alias("refers_to"),
    )


# --- records ---


def record_id(page: str | None, digest: bytes) -> str:
    """The same for the same page and payload, in whatever task."""
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page}:{digest.hex()}')}>"


def packed(head: dict[str, str], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page: str | None, url: str | None, body: bytes, kind: str, refers_to: str | None, date: str) -> bytes:
    """One WARC record. A revisit holds the HTTP head, which tells the size, and no payload."""
    digest = hashlib.sha1(body).digest()
    target = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http + body if kind == "response" else http
    head = {"WARC-Type": kind, "WARC-Record-ID": record_id(page, digest), "WARC-Date": date, "WARC-Target-URI": target}
    head["WARC-Payload-Digest"] = f"sha1:{base64.b32encode(digest).decode()}"
    if page is not None:
        head["WARC-Page-ID"] = page
    if kind == "revisit":
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "WARC-Refers-To-Page-ID": refers_to}
    head |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    return packed(head, block)


def info_record(date: str) -> bytes:
    block = b"software: strata\r\nformat: WARC File Format 1.1\r\n"
    head = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_NAMES, date)}>", "WARC-Date": date}
    return packed(head | {"Content-Type": "application/warc-fields", "Content-Length": str(len(block))}, block)


def unpacked(record: bytes) -> tuple[dict[str, str], bytes]:
    """Head and block of a record; a record that is not whole is refused."""
    end = record.index(b"\r\n\r\n")
    version, *lines = record[:end].decode().split("\r\n")
    head = dict(line.split(": ", 1) for line in lines)
    block = record[end + 4 : -4]
    if not version.startswith("WARC/1.") or len(block) != int(head["Content-Length"]) or record[-4:] != b"\r\n\r\n":
        raise ValueError(f"broken WARC record {head.get('WARC-Record-ID')}")
    return head, block


# --- archives ---


def dictionary_of(held: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Dictionary trained on the records with the smallest digests, up to the size of a sample.

    Too few records train none; their own bytes then are the dictionary.
    """
    sample, size = [], 0
    for record in sorted(held, key=lambda r: hashlib.blake2b(r, digest_size=8).digest()):
        sample.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(max(1024, min(DICTIONARY_BYTES, size // 32)), sample, k=1024, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_frames(held: list[bytes]) -> Iterator[bytes]:
    """The frames of one archive: its dictionary, then its records."""
    dictionary = dictionary_of(held)
    content = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
    yield struct.pack("<II", DICTIONARY_FRAME, len(content)) + content
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    for record in held:
        yield compressor.compress(record)


def _archived(date: str, archive_bytes: int):
    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, place = 0, 0

        def frames(held: list[bytes]) -> Iterator[pa.RecordBatch]:
            nonlocal archive, place
            some, size = [], 0
            for frame in archive_frames(held):
                some.append(frame)
                size += len(frame)
                if size >= BATCH_BYTES:
                    yield batch_of(some)
                    some, size = [], 0
            if some:
                yield batch_of(some)
            archive += 1

        def batch_of(some: list[bytes]) -> pa.RecordBatch:
            nonlocal place
            places = range(place, place + len(some))
            place += len(some)
            return pa.record_batch([pa.array([archive] * len(some), pa.int32()), pa.array(places, pa.int64()), pa.array(some, pa.binary())], names=["archive", "place", "frame"])

        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(n) for n in ("id", "url", "payload", "record_type", "refers_to")), strict=True):
                record = page_record(*(value.as_py() for value in row), date)
                if held and size + len(record) > archive_bytes:
                    yield from frames(held)
                    held, size = [], 0
                if not held:
                    held, size = [info_record(date)], 0
                held.append(record)
                size += len(record)
        if held:
            yield from frames(held)

    return apply


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: datetime | None = None, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes a record for each row of the pages to archives below ``path``.

    Rows with equal payloads of ``LEAST_REVISIT`` bytes or more: those with the
    largest id are responses, the others revisits of it; rows without an id are
    revisits where any has one, else responses. A null page is an empty payload,
    a null address ``about:blank``; blanks and control characters of an address
    are escaped. Equal rows have a record each, with the same record id. No rows
    write no archive. Other columns are not looked at. A task begins a new
    archive before its records go over ``archive_bytes``.
    """
    date = (date or datetime.now(timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ")
    with extracted(repeated_payloads(pages, id_col, html_col), "repeated-payloads") as repeated:
        frames = records(pages, repeated, id_col, url_col, html_col).mapInArrow(_archived(date, archive_bytes), "archive int, place long, frame binary")
        ordered = frames.sortWithinPartitions("archive", "place").select("archive", F.col("frame").cast("string").alias("frame"))
        ordered.write.partitionBy("archive").option("lineSep", PASSED_OVER.decode()).text(path)


def frame_end(data: bytes, start: int) -> int:
    """Where the frame that begins at ``start`` ends, by the sizes of its blocks."""
    (magic, size) = struct.unpack_from("<II", data, start)
    if magic >> 4 == DICTIONARY_FRAME >> 4:
        return start + 8 + size
    if magic != FRAME:
        raise ValueError(f"no frame at {start}")
    checksum = data[start + 4] & 4
    at, last = start + zstandard.frame_header_size(data[start : start + 18]), False
    while not last:
        block = int.from_bytes(data[at : at + 3], "little")
        last = bool(block & 1)
        at += 3 + (1 if (block >> 1) & 3 == 1 else block >> 3)
    return at + (4 if checksum else 0)


def archive_records(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of an archive's records."""
    magic, size = struct.unpack_from("<II", data, 0) if data else (0, 0)
    dictionary = None
    if magic == DICTIONARY_FRAME:
        content = data[8 : 8 + size]
        if content[:4] == struct.pack("<I", FRAME):
            content = zstandard.ZstdDecompressor().decompress(content)
        dictionary = zstandard.ZstdCompressionDict(content)
    decompressor, at = zstandard.ZstdDecompressor(dict_data=dictionary), 0
    while at < len(data):
        end = frame_end(data, at)
        if data[at : at + 4] == struct.pack("<I", FRAME):
            yield at, end - at, decompressor.decompress(data[at:end])
        at = end


def _read(payloads: bool):
    def parsed(name: str, offset: int, length: int, record: bytes) -> tuple | None:
        head, block = unpacked(record)
        if head["WARC-Type"] not in _TYPES:
            return None
        http, _, body = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"\r\nContent-Length: ([0-9]+)", http)[1])
        digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:"))
        if head["WARC-Type"] == "response" and (len(body) != size or hashlib.sha1(body).digest() != digest):
            raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
        if head["WARC-Type"] == "revisit":
            body = None
        return name, offset, length, head.get("WARC-Page-ID"), head["WARC-Target-URI"], size, digest.hex(), head["WARC-Type"], head.get("WARC-Refers-To-Page-ID"), body if payloads else None

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([(f.name, {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in RECORDS.fields])
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, size = [], 0
                for offset, length, record in archive_records(content.as_py()):
                    if (row := parsed(name.as_py(), offset, length, record)) is not None:
                        rows.append(row)
                        size += len(record) if payloads else 200
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    return apply


RECORDS = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("page_id", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The response and revisit records of the archives below ``path``, as ``RECORDS``.

    ``offset`` and ``length`` are the frame's place in its archive. Every payload
    is held against its digest; a revisit has none, its size and digest are those
    of the response it names. A path without archives gives no rows.
    """
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    return files.option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("path", "content").mapInArrow(_read(payloads), RECORDS)
