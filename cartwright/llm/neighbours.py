"""Approximate nearest neighbours by a forest of hash prefixes.

Vectors are dealt to blocks by place: to the nearest of a few landmarks (means of a sample), there to rings by distance
from it, and a ring of many vectors to several blocks by a hash. In its block every vector gets one long hash string per
tree (64 signs of random projections of the vector less the block's mean), and each tree is a sorted array of those
strings. A query descends in all trees of a block to its longest common prefixes and then ascends in all trees at once, one
length for all, taking in every vector that shares a prefix of that length in any tree. Candidates are ranked by exact
distance in double precision.

The ascent stops where it is likely enough that nothing nearer is missed: at angle t two vectors agree in a sign with
probability 1 - t/pi, hence in a prefix of l signs in one of n trees with 1 - (1 - (1 - t/pi)^l)^n, which must reach
``LIKELY`` at the angle of the query's k-th candidate. Near neighbours end the ascent early; where all are about as far
as each other it ends near the root, which is then close to a scan of the block.

A query searches its own block first. The distance of its k-th candidate there bounds what may still matter: by the
triangle inequality a ring around a landmark holds nothing nearer than the query's distance from the ring, so rings beyond
the bound are left out without losing a neighbour, and in the others the ascent also ends where a vector within the bound
would have been met. Only the ``LANDMARKS`` times ``RINGS`` rings at most reach the driver, whatever the size of the table.

Every task holds one block and streams the queries that reach it, ``QUERIES`` at a time. A block moves twice, once for its
own queries and once for others, however many they are; one that more than ``PART`` queries reach, and more than a
partition's share, is copied once per such share, so copies never exceed the blocks and partitions together. The landmarks
come from a hash sample of about ``SAMPLE`` vectors.

Defined cases: vectors that are null, all zeros, of another length than most (the smaller, if two lengths tie), or hold
a null or non-finite component take no part, nor do null ids; equal distances go to the smaller id; a query never
meets rows with its own id; rows equal in id and vector are one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwright.llm.base import partitions, staged

TREES = 16
BITS = 64
LIKELY = 0.95
BLOCK = 8_192
QUERIES = 2_048
PART = 1 << 17
SAMPLE = 4_096
#: Candidates with which the ascent begins.
FIRST = 64
#: Landmarks at most, and vectors for each of them while there are fewer: blocks then are smaller than ``BLOCK``, but
#: queries reach fewer. Rings around a landmark at most, and rounds that move landmarks to the means of what is nearest.
LANDMARKS = 256
CELL = 1_024
RINGS = 8
ROUNDS = 8

_FOUND = pa.schema([("id", pa.int64()), ("v", pa.list_(pa.float64())), ("block", pa.int64()), ("bound", pa.float64()),
                    ("vec_ids", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])
_FOUND_DDL = "id bigint, v array<double>, block bigint, bound double, vec_ids array<bigint>, scores array<double>"


def usable(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """``id, v`` of the rows that take part, each once."""
    v = F.col("v")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{id_}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & sound).distinct()
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return rows.where(F.size("v") == (usual["n"] if usual else 0))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


class Forest:
    """The trees of one block."""

    def __init__(self, vectors: np.ndarray, centre: np.ndarray, trees: int, seed: int):
        self.vectors, self.centre, self.trees = vectors, centre, trees
        self.axes = np.random.default_rng(seed).standard_normal((trees, vectors.shape[1], BITS))
        self.codes, self.order = [], []
        for tree in range(trees):
            codes = self.strings(vectors, tree)
            order = np.argsort(codes, kind="stable")
            self.codes.append(codes[order])
            self.order.append(order)

    def strings(self, vectors: np.ndarray, tree: int) -> np.ndarray:
        signs = (vectors - self.centre) @ self.axes[tree] > 0
        return np.packbits(signs, axis=1).view(">u8").ravel().astype(np.uint64)

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every tree, query and prefix length: where the strings with that prefix begin and end."""
        free = np.array([(1 << (BITS - n)) - 1 for n in range(BITS + 1)], np.uint64)
        starts = np.zeros((self.trees, len(queries), BITS + 1), np.int64)
        ends = np.zeros_like(starts)
        for tree in range(self.trees):
            codes = self.strings(queries, tree)[:, None]
            starts[tree] = np.searchsorted(self.codes[tree], codes & ~free, "left")
            ends[tree] = np.searchsorted(self.codes[tree], codes | free, "right")
        return starts, ends

    def members(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows in the given range of any tree."""
        seen = np.zeros(len(self.vectors), bool)
        for tree, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
            seen[self.order[tree][a:b]] = True
        return np.flatnonzero(seen)

    def reach(self, angle: float) -> int:
        """The longest prefix at which a vector at this angle is likely enough to have been met."""
        agree = 1 - angle / np.pi
        once = 1 - (1 - LIKELY) ** (1 / self.trees)
        if agree >= 1:
            return BITS
        return 0 if agree <= 0 else min(BITS, int(np.log(once) / np.log(agree)))


def _angle(a: np.ndarray, b: np.ndarray) -> float:
    size = np.linalg.norm(a) * np.linalg.norm(b)
    return float(np.arccos(np.clip(a @ b / size, -1, 1))) if size else np.pi / 2


def ascents(forest: Forest, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
            bounds: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query the ids and distances of its k nearest candidates in one block; with ``bounds``, of those within them."""
    starts, ends = forest.ranges(queries)
    met = (ends - starts).sum(axis=0)
    for q, (query, own) in enumerate(zip(queries, query_ids)):
        bound = np.inf if bounds is None else bounds[q]
        away = np.linalg.norm(query - forest.centre)
        # A vector within the bound lies at this angle from the query at most, seen from the centre.
        enough = forest.reach(float(np.arcsin(bound / away))) if bound < away else 0
        length = int(np.flatnonzero(met[q] >= min(FIRST, met[q, 0]))[-1])
        while True:
            rows = forest.members(starts[:, q, length], ends[:, q, length])
            rows = rows[ids[rows] != own]
            scores = np.sqrt(((forest.vectors[rows] - query) ** 2).sum(axis=1))
            best = np.lexsort((ids[rows], scores))[:k]
            if not length or enough >= length:
                break
            if len(best) < k:
                length -= 1
                continue
            likely = max(enough, forest.reach(_angle(forest.vectors[rows[best[-1]]] - forest.centre, query - forest.centre)))
            if likely >= length:
                break
            length = likely
        best = best[scores[best] <= bound]
        yield ids[rows[best]], scores[best]


def search(forest: Forest, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest candidates of each query in one block: query ids, ids, distances."""
    found = list(ascents(forest, ids, queries, query_ids, k))
    return (np.repeat(query_ids, [len(i) for i, _ in found]), np.concatenate([i for i, _ in found]),
            np.concatenate([d for _, d in found]))


# ---- blocks by place ------------------------------------------------------------------------------


def _nearest(vectors: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """The nearest landmark of each vector, or one about as near."""
    return np.argmin((landmarks**2).sum(axis=1) - 2 * (vectors @ landmarks.T), axis=1)


def landmarks_of(sample: np.ndarray, n: int, seed: int) -> np.ndarray:
    """At most n landmarks: different vectors of the sample, moved to the means of what is nearest to them."""
    distinct = np.unique(sample, axis=0)
    found = distinct[np.random.default_rng(seed).permutation(len(distinct))[:n]]
    for _ in range(ROUNDS):
        near = _nearest(sample, found)
        sizes = np.bincount(near, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, near, sample)
        found = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], found)
    return found


def _placed(batches: Iterator[pa.RecordBatch], landmarks: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            vectors = _matrix(batch["v"])
            near = _nearest(vectors, landmarks)
            far = np.linalg.norm(vectors - landmarks[near], axis=1)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(near.astype(np.int32)), pa.array(far)],
                                             ["id", "v", "landmark", "far"])


@dataclass(frozen=True)
class Ring:
    """The vectors between two distances from a landmark, in consecutively numbered blocks."""

    landmark: int
    low: float
    high: float
    first: int
    blocks: int


def _dealt(placed: DataFrame, seed: int) -> tuple[DataFrame, list[Ring]]:
    """``id, v, block`` of the placed vectors, and the rings. Both tables broadcast hold ``LANDMARKS`` times ``RINGS`` rows
    at most."""
    spark = placed.sparkSession
    counts = placed.groupBy("landmark").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()
    cut = [(r["landmark"], min(RINGS, -(-r["n"] // BLOCK)), r["far"]) for r in counts]
    rings = spark.createDataFrame([(i, n, far / n or float("inf")) for i, n, far in cut], "landmark int, rings int, width double")
    ring = F.least(F.col("rings") - 1, F.floor(F.col("far") / F.col("width")).cast("int"))
    ringed = placed.join(F.broadcast(rings), "landmark").select("id", "v", "landmark", "far", ring.alias("ring"))
    found, numbered, first = [], [], 0
    for r in sorted(ringed.groupBy("landmark", "ring").agg(
            F.count(F.lit(1)).alias("n"), F.min("far").alias("low"), F.max("far").alias("high")).collect()):
        blocks = -(-r["n"] // BLOCK)
        found.append(Ring(r["landmark"], r["low"], r["high"], first, blocks))
        numbered.append((r["landmark"], r["ring"], first, blocks))
        first += blocks
    places = spark.createDataFrame(numbered, "landmark int, ring int, first bigint, blocks bigint")
    block = F.col("first") + F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.col("blocks"))
    return ringed.join(F.broadcast(places), ["landmark", "ring"]).select("id", "v", block.alias("block")), found


def routes(queries: np.ndarray, bounds: np.ndarray, own: np.ndarray, landmarks: np.ndarray, rings: list[Ring]) -> Iterator[tuple[np.ndarray, int]]:
    """Blocks other than their own that may hold a vector within the bounds, with the queries that reach them."""
    before, away = None, None
    for ring in rings:
        if ring.landmark != before:
            before, away = ring.landmark, np.linalg.norm(queries - landmarks[ring.landmark], axis=1)
        gap = np.maximum(away - ring.high, ring.low - away)
        near = gap <= bounds + 1e-9 * (away + ring.high)
        if near.any():
            for block in range(ring.first, ring.first + ring.blocks):
                reached = np.flatnonzero(near & (own != block))
                if len(reached):
                    yield reached, block


def _routed(batches: Iterator[pa.RecordBatch], landmarks: np.ndarray, rings: list[Ring], whole: bool) -> Iterator[pa.RecordBatch]:
    """The queries once per block they reach, or only how many of a batch reach each block."""
    for batch in batches:
        if not batch.num_rows:
            continue
        found = routes(_matrix(batch["v"]), batch["bound"].to_numpy(), batch["block"].to_numpy(), landmarks, rings)
        if not whole:
            pairs = [(block, len(reached)) for reached, block in found]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], pa.int64()) for i in (0, 1)], ["block", "n"])
            continue
        for reached, block in found:
            some = batch.select(["id", "v", "bound"]).take(pa.array(reached))
            yield some.append_column("block", pa.array(np.full(len(reached), block, np.int64)))


# ---- search ---------------------------------------------------------------------------------------


def _searched(batches: Iterator[pa.RecordBatch], k: int, trees: int, seed: int, with_vectors: bool) -> Iterator[pa.RecordBatch]:
    """Rows in order of block, part and kind: a block's vectors (kind 0) make a forest, its queries (kind 1) stream by."""
    held_for, held, forest, ids = None, [], None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        marks = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("block", "part", "kind")])
        cuts = [0, *(np.flatnonzero((np.diff(marks) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            block, part, kind = marks[:, start].tolist()
            if kind == 0:
                if held_for != (block, part):
                    held_for, held, forest = (block, part), [], None
                held.append(batch.slice(start, end - start))
                continue
            if forest is None:
                vectors = pa.Table.from_batches(held)
                matrix, ids, held = _matrix(vectors["v"]), vectors["id"].to_numpy(), []
                forest = Forest(matrix, matrix.mean(axis=0), trees, seed)
            for at in range(start, end, QUERIES):
                some = batch.slice(at, min(QUERIES, end - at))
                found = list(ascents(forest, ids, _matrix(some["v"]), some["id"].to_numpy(), k, some["bound"].to_numpy()))
                edges = pa.array(np.cumsum([0] + [len(i) for i, _ in found]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    some["id"], some["v"] if with_vectors else pa.nulls(len(found), _FOUND.field("v").type), some["block"],
                    pa.array([float(d[-1]) if len(d) == k else float("inf") for _, d in found]),
                    pa.ListArray.from_arrays(edges, pa.array(np.concatenate([i for i, _ in found]))),
                    pa.ListArray.from_arrays(edges, pa.array(np.concatenate([d for _, d in found])))], schema=_FOUND)


def _met(vectors: DataFrame, queries: DataFrame, k: int, trees: int, seed: int, with_vectors: bool) -> DataFrame:
    """The queries of every block and part with what they find there."""
    row = lambda frame, kind, bound: frame.select("block", "part", F.lit(kind).alias("kind"), "id", "v", bound.alias("bound"))
    both = row(vectors, 0, F.lit(float("inf"))).unionByName(row(queries, 1, F.col("bound")))
    return both.repartition("block", "part").sortWithinPartitions("block", "part", "kind").mapInArrow(
        lambda batches: _searched(batches, k, trees, seed, with_vectors), _FOUND_DDL)


def nearest(vectors: DataFrame, is_query, k: int = 10, id_: str = "vec_id", vector: str = "embedding", trees: int = TREES,
            seed: int = 0) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for every row that ``is_query`` (a condition on ``id``)."""
    spark = vectors.sparkSession
    rows = staged(usable(vectors, id_, vector), "vectors")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    share = F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(share < SAMPLE / n).select("v").toArrow()["v"]
    landmarks = landmarks_of(_matrix(sample), min(LANDMARKS, -(-n // min(CELL, BLOCK))), seed)
    placed = staged(rows.mapInArrow(lambda b: _placed(b, landmarks), "id bigint, v array<double>, landmark int, far double"), "placed")
    dealt, rings = _dealt(placed, seed)

    part, open_ = F.lit(0).alias("part"), F.lit(float("inf")).alias("bound")
    at_home = staged(_met(dealt.select("*", part), dealt.where(is_query).select("*", part, open_), k, trees, seed, True), "home")

    asked = at_home.select("id", "v", "block", "bound")
    reach = asked.mapInArrow(lambda b: _routed(b, landmarks, rings, False), "block bigint, n bigint").groupBy("block").agg(F.sum("n").alias("n"))
    reach = staged(reach, "reach")
    total = reach.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    parts = reach.select("block", F.ceil(F.col("n") / max(PART, -(-total // partitions(spark)))).cast("int").alias("parts"))
    copied = dealt.join(parts, "block").select("block", "id", "v", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    sent = asked.mapInArrow(lambda b: _routed(b, landmarks, rings, True), "id bigint, v array<double>, bound double, block bigint")
    sent = sent.join(parts, "block").select("block", "id", "v", "bound", F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int").alias("part"))
    away = _met(copied, sent, k, trees, seed, False)

    found = at_home.unionByName(away).select(F.col("id").alias("query_id"), F.explode(F.arrays_zip("vec_ids", "scores")).alias("f")).select(
        "query_id", F.col("f.vec_ids").alias("vec_id"), F.col("f.scores").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.distinct().withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
