"""Interaction audit of filters by a Gray-code walk over their subsets.

Each text is read once and leaves a failure bit per filter. Per part of the corpus that makes a cell for every mask of
failures, holding counts of documents, good ones and toxic ones. The walk visits all subsets of the filters in Gray-code
order, so one filter is switched at a time: every mask cell keeps a counter of the active filters it fails, and only the
cells whose counter leaves or reaches zero change the running survivors. The survivors of all subsets are stored (32
states for five filters). What any order of the filters does at any step is a difference of two states.

Filters (failure conditions), by letter:

* A: fewer than 200 words; B: distinct words under half of the words; C: ``A-Z`` over 2 % of the code points;
* D: any of ``#$%&*|``; E: the text equals that of a smaller id, anywhere in the table, removed or not.

Defined cases: a null text is empty; a null part is the empty string; rows with a null id have no labels, never fail E and
never make another row fail it; rows with equal id and text don't fail E through each other; a document is good or toxic if
any of its label rows says so; texts are read in stretches of ``STRETCH`` bytes, so a very long one needs memory for its
distinct words only; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwright.llm.base import stretches, texts

FILTERS = "ABCDE"
LEAST_WORDS = 200
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"
#: Bytes of text split into words at once.
STRETCH = 1 << 20

_CONTINUED = bytes(range(0x80, 0xC0))
_MEASURED = pa.schema([("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("print", pa.binary())])
COUNTS = ("documents", "good", "toxic")


def word_counts(text: bytes, stretch: int = STRETCH) -> tuple[int, int]:
    """Words and distinct words, split a stretch at a time."""
    n, seen = 0, set()
    for part in stretches(text, stretch):
        words = part.split()
        n += len(words)
        seen.update(words)
    return n, len(seen)


def failed(text: bytes) -> int:
    """The bits of filters A to D that a text fails."""
    words, distinct = word_counts(text)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, _CONTINUED))
    marked = len(text.translate(None, MARKS)) < len(text)
    return (words < LEAST_WORDS) | (100 * distinct < 50 * words) << 1 | (100 * capitals > 2 * points) << 2 | marked << 3


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = [t or b"" for t in texts(batch["text"])]
        yield pa.RecordBatch.from_arrays([
            batch["id"], batch["part"], pa.array([failed(t) for t in bodies], pa.int32()),
            pa.array([hashlib.sha256(t).digest() for t in bodies], pa.binary())], schema=_MEASURED)


# ---- the walk -------------------------------------------------------------------------------------


def gray_walk(filters: int) -> Iterator[tuple[int, int, bool]]:
    """Every subset but the empty one, in Gray-code order: the filter switched, the subset now, and whether it went on."""
    subset = 0
    for step in range(1, 1 << filters):
        switched = (step & -step).bit_length() - 1
        subset ^= 1 << switched
        yield switched, subset, bool(subset >> switched & 1)


def states(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of the filters, from counts by failure mask (second axis; others are kept)."""
    filters = (cells.shape[1] - 1).bit_length()
    masks = np.arange(cells.shape[1])
    active = np.zeros(len(masks), np.int64)
    alive = cells.sum(axis=1)
    found = np.zeros_like(cells)
    found[:, 0] = alive
    for switched, subset, on in gray_walk(filters):
        touched = (masks >> switched & 1).astype(bool)
        active[touched] += 1 if on else -1
        if on:
            alive = alive - cells[:, touched & (active == 1)].sum(axis=1)
        else:
            alive = alive + cells[:, touched & (active == 0)].sum(axis=1)
        found[:, subset] = alive
    return found


def steps(cells: np.ndarray) -> dict[str, np.ndarray]:
    """What every step of every order does, as arrays by part, order and step; orders as ``permutations`` gives them."""
    kept = states(cells)
    filters = (cells.shape[1] - 1).bit_length()
    orders = np.array(list(permutations(range(filters))))
    after = np.cumsum(1 << orders, axis=1)
    before = after - (1 << orders)
    lost = kept[:, before] - kept[:, after]
    fails = kept[:, :1, 0] - kept[:, 1 << np.arange(filters), 0]
    every = cells.shape[1] - 1
    alone = kept[:, every - (1 << np.arange(filters)), 0] - kept[:, every:, 0]
    shapley = np.zeros_like(fails)
    for k in range(filters):
        shapley[:, k] = lost[..., 0][:, orders == k].sum(axis=1)
    return {"kept": kept[:, after, 0], "removed": lost[..., 0], "redundant": fails[:, orders] - lost[..., 0],
            "unique_fails": alone[:, orders], "good_lost": lost[..., 1], "toxic_lost": lost[..., 2], "shapley": shapley[:, orders]}


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    filters = len(FILTERS)
    names = ["".join(p) for p in permutations(FILTERS)]
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            counts = part["counts"].flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, len(COUNTS), 1 << filters)
            found = steps(np.ascontiguousarray(counts.transpose(0, 2, 1)).astype(np.int64))
            each = factorial(filters) * filters
            yield pa.RecordBatch.from_arrays([
                part["part"].take(pa.array(np.repeat(np.arange(part.num_rows), each))),
                pa.array(np.tile(np.repeat(np.array(names, object), filters), part.num_rows), pa.string()),
                pa.array(np.tile(np.arange(1, filters + 1, dtype=np.int32), part.num_rows * len(names))),
                *[pa.array(x.ravel()) for x in found.values()],
            ], ["part", "filter_order", "step", *found])


STEPS_DDL = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
             "good_lost bigint, toxic_lost bigint, shapley bigint")


# ---- cells ----------------------------------------------------------------------------------------


def cells(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text", id_: str = "doc_id") -> DataFrame:
    """``part, mask, good, toxic, n``: documents by the filters they fail and their labels.

    Copies of one text are added up before their fingerprint is shuffled, and rows without an id are spread by it, so
    neither a hot text nor a hot id gathers rows in one task. Which copies fail E follows from the least id of a text and
    the rows that have it.
    """
    rows = docs.select(F.col(f"`{id_}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                       F.col(f"`{text}`").alias("text")).mapInArrow(_measure, "id bigint, part string, mask int, print binary")
    spread = F.when(F.col("id").isNull(), F.xxhash64("print")).otherwise(F.lit(0).cast("bigint")).alias("spread")
    once = rows.groupBy("id", spread, "part", "mask", "print").agg(F.count(F.lit(1)).alias("n"))
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).withColumn("spread", F.lit(0).cast("bigint"))
    known = once.join(said, ["id", "spread"], "left").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    same = known.groupBy("print", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"))
    least = F.min("first.id").over(W.partitionBy("print"))
    firsts = F.col("nameless") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = same.withColumn("least", least).withColumn("firsts", firsts)
    copied = F.lit(1 << FILTERS.index("E"))
    both = F.inline(F.array(F.struct("mask", F.col("firsts").alias("n")),
                            F.struct(F.col("mask").bitwiseOR(copied).alias("mask"), (F.col("n") - F.col("firsts")).alias("n"))))
    return split.select("part", "good", "toxic", both).groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text", id_: str = "doc_id") -> DataFrame:
    """One row per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    found = cells(docs, labels, part, text, id_)
    here = lambda m, also: F.coalesce(F.sum(F.when((F.col("mask") == m) & also, F.col("n"))), F.lit(0))
    kinds = (F.lit(True), F.col("good"), F.col("toxic"))
    counts = F.array(*[here(m, kind) for kind in kinds for m in range(1 << len(FILTERS))])
    return found.groupBy("part").agg(counts.alias("counts")).mapInArrow(_walk, STEPS_DDL)
