"""A distributed census of 64-bit keys: which keys of each chunk of documents occur more than once overall.

Documents are dealt to chunks by a hash of their content, hot copies also by their place. Each chunk sends its distinct keys, sorted and cut into
buckets by their leading bits, with a one-byte count; each bucket adds up the counts and answers every chunk with those of its keys
that occur at least twice. A key travels once per chunk whatever its frequency, so no task receives a group that grows with a hot
key's rows; a document's text is shuffled once and a key costs ``width`` bytes and one byte of count on its way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.base import binary, partitions, power_of_two
from cartwright.operators.joins import hot_key_hashes

SENT = "bucket int, chunk int, keys binary, counts binary"
ANSWER = "chunk int, bucket int, keys binary, classes binary"
_SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("classes", pa.binary())])

#: Classes per doubling of a key's number of occurrences.
CLASSES = 8


@dataclass(frozen=True)
class Layout:
    """Numbers of chunks and buckets, and the key bytes sent: 8 for whole hashes, 4 for their leading 32 bits more than the bucket's."""

    chunks: int
    bits: int
    width: int

    @property
    def buckets(self) -> int:
        return 1 << self.bits

    def trim(self, hashes: np.ndarray) -> np.ndarray:
        """The part of a hash that is a key here."""
        return hashes if self.width == 8 else hashes >> np.uint64(32 - self.bits)

    def bucket_of(self, keys: np.ndarray) -> np.ndarray:
        if self.bits == 0 and self.width == 8:
            return np.zeros(len(keys), np.uint64)
        return keys >> np.uint64(64 - self.bits if self.width == 8 else 32)

    def packed(self, keys: np.ndarray) -> bytes:
        return binary(keys if self.width == 8 else keys.astype(np.uint32))

    def unpacked(self, blob: bytes, buckets: np.ndarray) -> np.ndarray:
        if self.width == 8:
            return np.frombuffer(blob, np.uint64)
        return np.frombuffer(blob, np.uint32).astype(np.uint64) | (buckets.astype(np.uint64) << np.uint64(32))


@dataclass(frozen=True)
class Sizes:
    """What a task may hold: bytes of text in a chunk and keys in a bucket at least, and the fewest keys that a message
    from a chunk to a bucket should have."""

    chunk_bytes: int = 8 << 20
    bucket_keys: int = 1 << 20
    message_keys: int = 64


#: Bytes of text per key: a word and a space.
WORD_BYTES = 5


def layout(docs: DataFrame, text: str, width: int, sizes: Sizes = Sizes()) -> Layout:
    """Numbers of chunks and buckets from one aggregate over the whole input."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{text}`"))), F.lit(0)).alias("b")).first()["b"]
    return layout_for(total, partitions(docs.sparkSession), width, sizes)


def layout_for(total: int, parts: int, width: int, sizes: Sizes = Sizes()) -> Layout:
    """The layout for so many bytes of text. Every chunk writes to every bucket, so beyond about 130 GB chunks and buckets
    grow with the square root of the input: messages then keep about ``message_keys`` keys, some 600 bytes, at any size.
    A bucket's task needs about 45 bytes a key: 170 MB at 1 TB, 500 MB at 10 TB, 1.7 GB at 100 TB."""
    keys = total / WORD_BYTES
    held = np.sqrt(sizes.message_keys * keys)
    buckets = power_of_two(max(parts, keys / max(sizes.bucket_keys, held)))
    return Layout(max(3 * parts, int(total // max(sizes.chunk_bytes, held * WORD_BYTES))), buckets.bit_length() - 1, width)


def chunk_of(lay: Layout, docs: DataFrame) -> Column:
    """The chunk of a row, from its content alone. Rows that are equal in every column and so many that their chunk would be
    much larger than others are spread by their place as well: each of their chunks then asks for the same keys."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    content = F.xxhash64(*plain)
    hot = hot_key_hashes(docs.select(content.alias("content")), {"content": T.LongType()}, lay.chunks)
    spread = F.when(F.xxhash64(content).isin(list(hot)), F.monotonically_increasing_id()).otherwise(F.lit(0)) if hot else F.lit(0)
    return F.pmod(F.xxhash64(content, spread), F.lit(lay.chunks)).cast("int").alias("chunk")


def send(keys: np.ndarray, chunk: int, lay: Layout) -> pa.Table:
    """One chunk's message: its distinct keys by bucket, with counts up to 255."""
    found, counts = np.unique(lay.trim(keys), return_counts=True)
    buckets = lay.bucket_of(found)
    cuts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])) if len(found) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(found)) if len(found) else cuts
    counts = np.minimum(counts, 255).astype(np.uint8)
    return pa.table([
        pa.array(buckets[cuts].astype(np.int32)), pa.array(np.full(len(cuts), chunk, np.int32)),
        pa.array([lay.packed(found[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
        pa.array([binary(counts[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
    ], schema=_SENT)


def answer(sent: pa.Table, lay: Layout) -> pa.Table:
    """One bucket's answers. The class of a key is the logarithm of its occurrences in steps of a ``CLASSES``-th doubling."""
    bucket = sent["bucket"][0].as_py()
    blobs = sent["keys"].to_pylist()
    keys = np.frombuffer(b"".join(blobs), np.uint64 if lay.width == 8 else np.uint32)
    counts = np.frombuffer(b"".join(sent["counts"].to_pylist()), np.uint8)
    rows = np.repeat(np.arange(len(blobs), dtype=np.int32), [len(b) // lay.width for b in blobs])
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    totals = np.add.reduceat(counts[order].astype(np.int64), starts)
    per_key = np.diff(np.append(starts, len(ordered)))
    classes = np.minimum(255, np.floor(CLASSES * np.log2(totals))).astype(np.uint8)
    keep = np.repeat(totals > 1, per_key)
    rows_out = rows[order][keep]
    by_row = np.argsort(rows_out, kind="stable")  # keys stay sorted within a row
    rows_out, keys_out, classes_out = rows_out[by_row], ordered[keep][by_row], np.repeat(classes, per_key)[keep][by_row]
    cuts = np.flatnonzero(np.concatenate([[True], rows_out[1:] != rows_out[:-1]])) if len(rows_out) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(rows_out)) if len(rows_out) else cuts
    chunks = sent["chunk"].to_numpy()
    return pa.table([
        pa.array(chunks[rows_out[cuts]].astype(np.int32)), pa.array(np.full(len(cuts), bucket, np.int32)),
        pa.array([binary(keys_out[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
        pa.array([binary(classes_out[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
    ], schema=_ANSWER)


@dataclass(frozen=True)
class Repeated:
    """A chunk's keys that occur at least twice overall, sorted, with their classes (8 for two occurrences)."""

    lay: Layout
    keys: np.ndarray
    classes: np.ndarray

    @staticmethod
    def of(answers: pa.Table, lay: Layout) -> Repeated:
        blobs = answers["keys"].to_pylist()
        buckets = np.repeat(answers["bucket"].to_numpy(), [len(b) // lay.width for b in blobs])
        keys = lay.unpacked(b"".join(blobs), buckets)
        classes = np.frombuffer(b"".join(answers["classes"].to_pylist()), np.uint8)
        order = np.argsort(keys, kind="stable")
        return Repeated(lay, keys[order], classes[order])

    def classes_of(self, hashes: np.ndarray) -> np.ndarray:
        """Zero for a key that occurs once overall."""
        if not len(self.keys):
            return np.zeros(len(hashes), np.uint8)
        wanted = self.lay.trim(hashes)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.classes[at], 0).astype(np.uint8)


def census(chunked: DataFrame, keys_of: Callable[[pa.Table], np.ndarray], lay: Layout,
           finish: Callable[[pa.Table, Repeated], pa.Table], schema: str) -> DataFrame:
    """Count ``keys_of`` every chunk and ``finish`` each chunk with the answers to it.

    ``chunked`` has a column ``chunk``; both uses of it read the same shuffle.
    """

    def ask(group: pa.Table) -> pa.Table:
        return send(keys_of(group), group["chunk"][0].as_py(), lay)

    def close(group: pa.Table, answers: pa.Table) -> pa.Table:
        return finish(group, Repeated.of(answers, lay))

    sent = chunked.groupBy("chunk").applyInArrow(ask, SENT)
    answers = sent.groupBy("bucket").applyInArrow(lambda t: answer(t, lay), ANSWER)
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(close, schema)


def slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Start and end of consecutive runs of the given sizes."""
    at = 0
    for size in sizes:
        yield at, at + size
        at += size
