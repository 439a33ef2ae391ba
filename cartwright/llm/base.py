"""Helpers shared by the operators: reading, staging, word splitting, hashing, and set layouts.

A word is a maximal run of bytes other than space and ``\\x09``-``\\x0D``; ``bytes.split()`` splits exactly there.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.session import shared_folder

#: The same word pattern for Spark's and DuckDB's regular expressions.
WORD_BREAK = r"[\x20\x09-\x0D]+"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, if their path doesn't have it yet."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """Hold one session setting for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, and lost executors lose nothing.

    The write's shuffle files go once it has ended; the frame is not run again.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    with setting(spark, CLEANUP_CONF, "true"):
        frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def power_of_two(n: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(n, 1)))))


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with every inner field nullable, as Arrow functions declare theirs."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _nullable(kind.valueType))
    return kind


def rest_of(frame: DataFrame, *taken: str) -> Column:
    """Every other column in one struct, so that operators may name theirs freely."""
    others = [F.col(f"`{c}`") for c in frame.columns if c not in taken]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("_"))
    return rest.cast(_nullable(frame.select(rest.alias("rest")).schema["rest"].dataType))


def unrest(frame: DataFrame, columns: list[str], found: list[str]) -> DataFrame:
    """Undo ``rest_of``: the ``columns`` it held that are not found anew, then those that are."""
    held = [F.col(f"rest.`{c}`").alias(c) for c in columns if c not in found]
    return frame.select(*held, *[F.col(f"`{c}`") for c in found])


# ---- words and hashes inside tasks ----------------------------------------------------------------

#: Bytes of text hashed at once; the arrays take some thirty times as much. A longer text is hashed in stretches that
#: end with a word, and its windows in overlapping runs of words, so only its word hashes are held whole.
BLOCK_BYTES = 1 << 19
_BREAK = re.compile(rb"[\x20\x09-\x0D]")
#: Words from this length on are hashed one by one: a polynomial modulo 2^64 is weak on very long periodic strings.
LONG_WORD = 512

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(len(values))[0], dtype=np.uint64, out=out[1:])
    return out


def stretches(text: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, or of the word that is longer; no word is cut."""
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash and the start of every word of a text."""
    data = np.frombuffer(text, np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    sums = _sums(data.astype(np.uint64) + np.uint64(1))
    hashes = mixed((sums[ends] - sums[starts]) * _powers(len(data) + 1)[1][starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts >= LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(text[starts[i]:ends[i]])
    return hashes, starts


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash, modulo 2^64, of every ``width`` consecutive word hashes.

    The word hashes already have 64 random bits and the base is odd, so windows that differ in one word never agree.
    """
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    sums = _sums(hashes)
    return mixed((sums[width:] - sums[:-width]) * _powers(n)[1][: n - width + 1])


@dataclass(frozen=True)
class Block:
    """Word hashes of some consecutive texts, one after the other."""

    first: int
    ends: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and position of every window that lies in one text."""
        parts = list(self.window_parts(width))
        return parts[0] if len(parts) == 1 else tuple(np.concatenate(side) for side in zip(*parts))

    def window_parts(self, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """As ``windows``, in runs of at most ``BLOCK_BYTES`` words; a block of several texts is one."""
        if len(self.ends) == 1:
            for start in range(0, max(1, len(self.hashes) - width + 1), BLOCK_BYTES):
                found = rolling(self.hashes[start:start + BLOCK_BYTES + width - 1], width)
                yield found, np.arange(start, start + len(found), dtype=np.int32 if len(self.hashes) < 1 << 31 else np.int64)
            return
        found = rolling(self.hashes, width)
        room = np.repeat(self.ends, self.counts)[: len(found)]
        at = np.flatnonzero(np.arange(width, width + len(found)) <= room)
        yield found[at], at


def blocks(raw: list[bytes | None]) -> Iterator[Block]:
    """Whole texts in order, hashed together up to ``BLOCK_BYTES``; null has no words."""
    at = 0
    while at < len(raw):
        to, size, parts = at, 0, []
        while to < len(raw) and (to == at or size + len(raw[to] or b"") < BLOCK_BYTES):
            parts.append(raw[to] or b"")
            size += len(parts[-1]) + 1
            to += 1
        if size > BLOCK_BYTES + 1:  # one text alone
            hashes = np.concatenate([word_hashes(part)[0] for part in stretches(parts[0])])
            yield Block(at, np.array([len(hashes)]), hashes)
            at = to
            continue
        hashes, starts = word_hashes(b" ".join(parts))
        limits = np.cumsum([len(p) + 1 for p in parts])
        yield Block(at, np.searchsorted(starts, limits), hashes)
        at = to


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column; null stays None."""
    return column.cast(pa.binary()).to_pylist()


def binary(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()
