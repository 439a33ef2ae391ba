"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Entries become whole numbers, ``x = floor(scale * c)``. Each distinct vector counts once (the fit list). A task takes its
share of the list in blocks of rows, shifts each dimension by its least value there and packs every bit of every dimension
across the rows into 64-bit words. The product sum of two dimensions is then the sum, over pairs of their bit planes, of
popcounts of the planes' conjunction, weighted by powers of two: exact whatever the order of rows, tasks and retries. The
shift is undone in whole numbers too, and the covariance is centred as ``n * products - sums x sums`` before anything is
divided, so nothing cancels; ``eigh`` sees entries that are rounded once.

What the driver receives is the sums and products by pair of dimensions, whatever the number of rows. Sums travel as
digits of ``DIGIT`` bits and so have no largest value.

Defined cases: rows whose vector is null, empty, holds a null or non-finite entry or one whose whole number exceeds 64 bits
are left out, and so are vectors of another length than most (the smaller, if two lengths tie); a null id is kept; repeated
rows each have their own result and count once in the fit; components without variance (the eigenvalue is not above
rounding) have a null ``whitened``; without any variance ``explained`` is null; ``deviation`` is null where it exceeds 64
bits; a table without usable rows gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
COMPONENTS = 4
#: Bytes of one block's unpacked planes; a block has at least 64 rows.
BLOCK_BYTES = 1 << 24
#: Bits of the digits in which sums travel.
DIGIT = 40

_DIGITS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("digit", pa.int32()), ("value", pa.int64())])
WHITENED_DDL = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whole(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id, x`` of the rows that take part, entries as whole numbers."""
    rows = vectors.select(F.col(f"`{id_}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    sound = rows.where((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < float(1 << 63))))
    usual = sound.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return sound.where(F.size("v") == (usual["n"] if usual else 0)).select(
        "id", F.transform("v", lambda c: F.floor(c * scale).cast("bigint")).alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


# ---- bit-sliced products --------------------------------------------------------------------------


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """The bit planes of unsigned numbers (rows, dimensions) as words (dimensions, bits, words), rows packed."""
    each = (y.T[:, None, :] >> np.arange(bits, dtype=np.uint64)[None, :, None]) & np.uint64(1)
    packed = np.packbits(each.astype(np.uint8), axis=2)
    room = -packed.shape[2] % 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, 0), (0, room)))).view(np.uint64)


def block_moments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums by dimension and product sums by pair of dimensions (upper triangle) of one block, as Python's whole numbers."""
    rows, width = x.shape
    low = x.min(axis=0)
    y = x.view(np.uint64) - low.view(np.uint64)
    bits = max(1, int(y.max()).bit_length())
    words = planes(y, bits)
    exact = np.int64 if 2 * bits + rows.bit_length() < 62 else object
    weights = np.array([1 << b for b in range(bits)], exact)
    shifted = np.zeros((width, width), exact)
    for i in range(width):
        for a in range(bits):
            met = np.bitwise_count(words[i, a] & words[i:]).sum(axis=2, dtype=np.int64).astype(exact)
            shifted[i, i:] += (met @ weights) * weights[a]
    ones = (np.bitwise_count(words).sum(axis=2, dtype=np.int64).astype(exact) @ weights).astype(object)
    low = low.astype(object)
    products = shifted.astype(object) + np.outer(low, ones) + np.outer(ones, low) + rows * np.outer(low, low)
    return ones + rows * low, products


def block_rows(width: int, bits: int = 64) -> int:
    return max(64, BLOCK_BYTES // (width * bits) // 64 * 64)


def _digits(value: int) -> Iterator[int]:
    """Digits of a whole number, lowest first; the last one has the sign."""
    while not -(1 << DIGIT) < value < 1 << DIGIT:
        yield value & ((1 << DIGIT) - 1)
        value >>= DIGIT
    yield value


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's count (at -1, -1), sums (at -1, j) and products (at i <= j), in digits."""
    n, sums, products = 0, 0, 0
    for batch in batches:
        x = matrix(batch["x"]) if batch.num_rows else np.zeros((0, 0), np.int64)
        for at in range(0, len(x), block_rows(x.shape[1])):
            s, p = block_moments(np.ascontiguousarray(x[at:at + block_rows(x.shape[1])]))
            sums, products = sums + s, products + p
        n += len(x)
    if n:
        width = len(sums)
        values = [(-1, -1, n), *((-1, j, sums[j]) for j in range(width)),
                  *((i, j, products[i, j]) for i in range(width) for j in range(i, width))]
        out = [(i, j, k, d) for i, j, v in values for k, d in enumerate(_digits(v))]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _DIGITS)], schema=_DIGITS)


@dataclass(frozen=True)
class Fit:
    """The fit list's size and sums by dimension, and the components of its covariance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def rounding(self) -> float:
        """The largest eigenvalue that may be nothing but rounding."""
        return float(len(self.sums) * np.finfo(float).eps * max(self.eigenvalues, default=0.0))


def components(n: int, sums: list[int], products: dict[tuple[int, int], int], k: int) -> Fit:
    width = len(sums)
    covariance = np.zeros((width, width))
    for (i, j), p in products.items():
        covariance[i, j] = covariance[j, i] = (n * p - sums[i] * sums[j]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:k]
    axes, values = vectors[:, order], values[order]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))] < 0, -1, 1)
    trace = np.trace(covariance)
    share = values / trace if trace > 0 else np.full(len(values), np.nan)
    fit = Fit(n, sums, axes, values, share, 0.0)
    real = values > fit.rounding
    scaled = axes[:, real] / np.sqrt(values[real])
    error = np.abs(scaled.T @ covariance @ scaled - np.eye(int(real.sum()))).max(initial=0.0)
    return Fit(n, sums, axes, values, share, float(error))


def fit(rows: DataFrame, k: int = COMPONENTS) -> Fit | None:
    """Fit to the distinct ``x`` of ``rows``; None without any."""
    found = (rows.select("x").distinct().mapInArrow(_moments, "i int, j int, digit int, value bigint")
             .groupBy("i", "j", "digit").agg(F.sum("value").alias("value")))
    totals: dict[tuple[int, int], int] = {}
    for r in found.collect():
        totals[r["i"], r["j"]] = totals.get((r["i"], r["j"]), 0) + (r["value"] << DIGIT * r["digit"])
    if not totals:
        return None
    n = totals.pop((-1, -1))
    sums = [totals.pop((-1, j)) for j in range(sum(i < 0 for i, _ in totals))]
    return components(n, sums, totals, k)


# ---- rows -----------------------------------------------------------------------------------------


def centred(x: np.ndarray, found: Fit) -> np.ndarray:
    """``n * x - S``: whole numbers, of Python's kind where 64 bits might not hold the sum of their squares."""
    reach = found.n * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, found.sums))
    exact = np.int64 if x.shape[1] * reach * reach < 1 << 63 else object
    return x.astype(exact) * found.n - np.array(found.sums, exact)


def whitened(rows: DataFrame, found: Fit) -> DataFrame:
    """One row per row and component."""
    k = found.axes.shape[1]
    real = found.eigenvalues > found.rounding
    scaled = np.where(real, found.axes / np.sqrt(np.where(real, found.eigenvalues, 1.0)), np.nan)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = centred(matrix(batch["x"]), found)
            squares = [v if v < 1 << 63 else None for v in (apart * apart).sum(axis=1).tolist()]
            seen = (apart / found.n).astype(np.float64) @ scaled
            times = np.repeat(np.arange(batch.num_rows), k)
            flat = lambda a: pa.array(a.ravel(), from_pandas=True)
            yield pa.RecordBatch.from_arrays([
                batch["id"].take(pa.array(times)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(len(times), found.n)), pa.array(squares, pa.int64()).take(pa.array(times)), flat(seen),
                flat(np.tile(found.explained, batch.num_rows)), pa.array(np.full(len(times), found.identity_error)),
            ], WHITENED_DDL.replace(" bigint", "").replace(" double", "").replace(" int", "").split(", "))

    return rows.mapInArrow(project, WHITENED_DDL)


def whiten(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every usable row and component."""
    rows = whole(vectors, id_, vector)
    found = fit(rows, k)
    return whitened(rows, found) if found else rows.sparkSession.createDataFrame([], WHITENED_DDL)
