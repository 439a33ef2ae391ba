"""WARC archives compressed record by record with a Zstandard dictionary of their own.

An archive is one file: a skippable frame with the dictionary, trained on records of that archive, then one Zstandard
frame per record, so any record can be read on its own and none is copied to be read. Of records with equal payloads of
at least ``LEAST_SHARED`` bytes, the one with the smallest id is a response and the others are revisits that refer to it.

Spark's own text writer makes the files, with task commit on any file system: a line is a run of whole frames, and the line
separator is an empty skippable frame, which readers pass over. A file ends after ``LINES`` lines. An archive that reaches
its size in bytes before is filled up with empty lines, so the next one begins a file of its own, with its own dictionary:
no archive is larger than ``ARCHIVE_BYTES`` by more than a line (or a single larger record), however large a task is. The
dictionary is trained on the first ``SAMPLE_BYTES`` of an archive's records (rows lie in no order), and is left out where
those are too few to train on.

Defined cases: a null payload is empty; a null url gives no target header, control characters in one are percent-coded;
a null id is written and read back as null and refers to the smallest id like others; rows equal in id and payload are
each a response if their id is the smallest; a very long page is a record, and may be an archive, of its own; other columns
are ignored; an empty table gives no records.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm.base import texts
from cartwright.operators.joins import lookup_join

LEAST_SHARED = 100
SAMPLE_BYTES = 4 << 20
#: Bytes at which an archive is closed, and lines of a file. A line is closed at so many bytes that half of the lines do.
ARCHIVE_BYTES = 128 << 20
LINES = 512
DICTIONARY_BYTES = 64 << 10
LEAST_SAMPLES = 8
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Fixed values of the formats: the skippable frame that holds a dictionary, the first of the sixteen skippable
#: frames, and an empty one of that kind as text.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"

_CONTROL = re.compile(rb"[\x00-\x20\x7f]")


# ---- writing --------------------------------------------------------------------------------------


def record(id_: str, url: bytes | None, payload: bytes, digest: str, size: int, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the response's HTTP header, with its length, and no payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + (b"" if revisit else payload)
    head = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Record-ID: <urn:page:%s>" % id_.encode(),
            b"WARC-Date: " + DATE.encode(), b"WARC-Payload-Digest: sha256:" + digest.encode()]
    if url is not None:
        head.append(b"WARC-Target-URI: " + _CONTROL.sub(lambda m: b"%%%02X" % m[0][0], url))
    if revisit:
        head += [b"WARC-Profile: " + PROFILE.encode(), b"WARC-Refers-To: <urn:page:%d>" % refers_to]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> bytes | None:
    """A dictionary in Zstandard's format, or None where the samples are too few or too alike to make one."""
    if len(samples) < LEAST_SAMPLES:
        return None
    size = min(DICTIONARY_BYTES, max(1 << 10, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8, f=20, accel=4, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return None


def _records(batch: pa.RecordBatch, numbered: Iterator[int]) -> Iterator[bytes]:
    columns = [batch["id"].to_pylist(), texts(batch["url"]), texts(batch["payload"]), batch["digest"].to_pylist(),
               batch["first"].to_pylist()]
    for n, (id_, url, payload, digest, first) in zip(numbered, zip(*columns)):
        revisit = first is not None and first != id_
        name = f"-:{digest}:{n}" if id_ is None else str(id_)
        yield record(name, url, payload, digest, len(payload), first, revisit)


def _archives(records: Iterator[bytes], archive_bytes: int) -> Iterator[list[bytes]]:
    """The lines of one archive after the other, a few at a time; all but the last archive have ``LINES``."""
    held: deque[bytes] = deque()
    while True:
        size = sum(map(len, held))
        while size < SAMPLE_BYTES and (one := next(records, None)) is not None:
            held.append(one)
            size += len(one)
        if not held:
            return
        made = train(_first(held))
        line, size, lines, written = [struct.pack("<II", DICTIONARY_MAGIC, len(made)) + made] if made else [], 0, 0, 0
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=made and zstandard.ZstdCompressionDict(made))
        while written < archive_bytes and (one := held.popleft() if held else next(records, None)) is not None:
            line.append(compressor.compress(one))
            size += len(line[-1])
            if size >= archive_bytes // (LINES // 2):
                yield [b"".join(line)]
                line, size, lines, written = [], 0, lines + 1, written + size
        if line:
            yield [b"".join(line)]
            lines += 1
        if not held and (one := next(records, None)) is not None:
            held.append(one)
        if held:
            yield [b""] * (LINES - lines)


def _first(records: Iterable[bytes]) -> list[bytes]:
    """The first ``SAMPLE_BYTES`` of records."""
    taken, size = [], 0
    for one in records:
        if size >= SAMPLE_BYTES:
            break
        taken.append(one)
        size += len(one)
    return taken


def _frames(batches: Iterator[pa.RecordBatch], archive_bytes: int) -> Iterator[pa.RecordBatch]:
    numbered = iter(range(1 << 62))
    for lines in _archives((r for b in batches for r in _records(b, numbered)), archive_bytes):
        yield _batch(lines)


def _batch(frames: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])


def write_archives(pages: DataFrame, path: str, id_: str = "page_id", url: str = "url", payload: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record per row of ``pages`` into archives of about ``archive_bytes`` below ``path``."""
    body = F.coalesce(F.col(f"`{payload}`"), F.lit("")).alias("payload")
    whole = pages.select(F.col(f"`{id_}`").cast("bigint").alias("id"), F.col(f"`{url}`").alias("url"), body).withColumn(
        "digest", F.sha2(F.col("payload").cast("binary"), 256))
    narrow = whole.select("id", "digest", F.octet_length("payload").alias("size")).where(F.col("size") >= LEAST_SHARED)
    shared = narrow.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
    # Only rows of shared payloads meet their payload's first id; the pages follow by a key that is never null or hot.
    key = F.xxhash64("id", "digest").alias("key")
    of_row = lookup_join(narrow, shared.select("digest", "first"), "digest", "inner", narrow.select("digest"), ["id"]).select(
        key, "first").distinct()
    frames = (whole.withColumn("key", key).join(of_row, "key", "left").select("id", "url", "payload", "digest", "first")
              .mapInArrow(lambda batches: _frames(batches, archive_bytes), "frame binary"))
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).option(
        "compression", "none").option("maxRecordsPerFile", LINES).text(path)


# ---- reading --------------------------------------------------------------------------------------

_STEP = 1 << 14


def frames(data: memoryview) -> Iterator[bytes]:
    """The records of one archive, decompressed with the dictionary in its leading frame."""
    decompressor, at = zstandard.ZstdDecompressor(), 0
    while at < len(data):
        magic, = struct.unpack_from("<I", data, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            size, = struct.unpack_from("<I", data, at + 4)
            if magic == DICTIONARY_MAGIC and at == 0:
                decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[8:8 + size])))
            at += 8 + size
            continue
        reader, parts = decompressor.decompressobj(), []
        while not reader.eof:
            if at >= len(data):
                raise ValueError("the archive ends within a frame")
            chunk = data[at:at + _STEP]
            parts.append(reader.decompress(chunk))
            at += len(chunk) - len(reader.unused_data)
        yield b"".join(parts)


def parsed(raw: bytes) -> dict:
    """The fields of a record; a payload that differs from its digest or length is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = rest[:int(fields[b"Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha256:")
    kind = fields[b"WARC-Type"].decode()
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields[b'WARC-Record-ID']!r} differs from its digest")
    number = lambda name: (lambda v: None if v is None or v.startswith(b"<urn:page:-:") else int(v[10:-1]))(fields.get(name))
    url = fields.get(b"WARC-Target-URI")
    return {"id": number(b"WARC-Record-ID"), "url": url and url.decode(), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": number(b"WARC-Refers-To"), "payload": payload if kind == "response" else None}


_READ = pa.schema([("id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archives(spark: SparkSession, path: str, id_: str = "page_id", with_payload: bool = False) -> DataFrame:
    """Every record of the archives below ``path``: id, url, payload_bytes, payload_digest, record_type, refers_to and,
    ``with_payload``, payload (of responses)."""
    schema = _READ.append(pa.field("payload", pa.binary())) if with_payload else _READ

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for raw in frames(memoryview(content.as_buffer())):
                    row = parsed(raw)
                    rows.append({k: row[k] for k in schema.names})
                    size += len(raw) if with_payload else 256
                    if size >= 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    ddl = "id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return files.mapInArrow(read, ddl + (", payload binary" if with_payload else "")).withColumnRenamed("id", id_)
