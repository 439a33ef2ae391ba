from __future__ import annotations

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwright.llm import jaccard
from cartwright.llm.components import components
from tests.llm import brute


def text(n, seed, vocabulary=500):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(words, edits, seed):
    rng, out = random.Random(seed), list(words)
    for k in range(edits):
        out[rng.randrange(len(out))] = f"new{seed}x{k}"
    return " ".join(out)


def got(frame):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in frame.collect())


BASE = text(120, 1)
CASES = {
    "near copies": [(i, edited(BASE, i % 5, i)) for i in range(40)] + [(100 + i, " ".join(text(90, 100 + i))) for i in range(20)],
    "copies": [(i, "Some WORDS that are quite the same here") for i in range(25, 0, -1)] + [(99, "some words that are quite the same HERE")],
    "small sets": [(i, " ".join(f"t{k}" for k in range(4 + i % 14)) + " end" * (i % 2)) for i in range(40)],
    "one shingle": [(1, "a b c"), (2, "a b c"), (3, "A B C"), (4, "a b"), (5, "a b c d"), (6, "a b c d e"), (7, "a b c d e")],
    "edges": [(1, None), (2, ""), (3, "  \n"), (None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (8, None), (7, "a b c d e f")],
    "nameless": [(None, "a b c d e f"), (None, "a b c d e f")],
    "chain": [(i, " ".join(f"c{k}" for k in range(i * 3, i * 3 + 60))) for i in range(12)],
    "long": [(1, " ".join(text(9000, 5, 9000))), (2, edited(text(9000, 5, 9000), 100, 3)), (3, " ".join(text(9000, 6, 9000)))],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_like_brute_force(documents, name):
    rows = CASES[name]
    assert got(jaccard.near_duplicates(documents(rows))) == Counter(brute.components(rows))


def test_boundary_pairs_at_exactly_the_threshold(documents):
    # 8 of 10 shingles shared: exactly 80 percent; 7 of 9: below.
    a = [f"p{k}" for k in range(13)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:12] + ["q"])), (3, " ".join(a[:12])), (4, " ".join(a[1:12] + ["r", "s"]))]
    assert got(jaccard.near_duplicates(documents(rows))) == Counter(brute.components(rows))


@pytest.mark.parametrize("boundary", [0, 8, 14])
def test_any_boundary_gives_the_same_components(documents, monkeypatch, boundary):
    rng = random.Random(9)
    rows = [(i, " ".join(f"t{k}" for k in sorted(rng.sample(range(24), rng.randrange(3, 20))))) for i in range(50)]
    rows += [(200 + i, edited(text(16, i // 3), i % 3, i)) for i in range(30)]
    monkeypatch.setattr(jaccard, "boundary_of", lambda *_: boundary)
    assert got(jaccard.near_duplicates(documents(rows))) == Counter(brute.components(rows))


def test_one_row_of_each_component_stays(documents):
    rows = [(5, "a b c d e f g"), (3, "a b c d e f g"), (3, "a b c d e f g"), (8, "other"), (None, "a b c d e f g"), (9, None), (10, None)]
    done = jaccard.without_near_duplicates(documents(rows))
    assert sorted(r["doc_id"] for r in done.collect()) == [3, 8, 9, 10]
    assert done.columns == documents(rows).columns


def test_components_of_a_long_chain(spark, small_parts):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a bigint, b bigint")
    assert {r["node"]: r["label"] for r in components(links).collect()} == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def postings(spark, rows, long=10**9):
    """One list or several: (token, rid, n, place, label) with random parities of about n bits, in shares of ``long``."""
    import numpy as np

    rng = np.random.default_rng(1)
    full = [(t, r, n, place, [int(x) for x in rng.integers(-(2**63), 2**63, jaccard.PARITY_BITS // 64)], label) for t, r, n, place, label in rows]
    made = spark.createDataFrame(full, "token bigint, rid bigint, n bigint, place int, parity array<bigint>, label bigint")
    return jaccard.in_shares(made, made.groupBy("token").agg(F.count(F.lit(1)).alias("members")), long)


@pytest.mark.parametrize("percent", [60, 80, 100])
def test_cells_meet_whom_the_join_meets(spark, small_parts, percent):
    rng = random.Random(3)
    rows = [(t, 1000 * t + i, rng.choice([1, 4, 5, 20, 24, 25, 300, 360, 2000]), 0, rng.randrange(40)) for t in range(4) for i in range(60 if t else 3)]
    none = F.array_repeat(F.lit(0).cast("bigint"), jaccard.PARITY_BITS // 64)
    plain = jaccard._cross_pairs(postings(spark, rows).withColumn("parity", none), 2, percent)
    lists = postings(spark, rows, 10).withColumn("parity", none)
    cut = jaccard._cross_pairs(lists, 2, percent, block=8)
    shown = lambda df: sorted(map(tuple, df.collect()))
    assert shown(cut) == shown(plain) and plain.count() > 100
    sizes = [r["count"] for r in jaccard._cells(lists.where("token > 0"), percent, 8).groupBy("token", "class", "one", "step", "two").count().collect()]
    assert max(sizes) <= 3 * 16


def test_a_hot_list_travels_in_shares(spark, small_parts):
    rows = [(7, i, 60, 0, i) for i in range(8_000)] + [(t, 10_000 + 2 * t + i, 60, 0, i) for t in range(100, 400) for i in range(2)]
    rows += [(9_999, 5, 60, 0, 5)]
    made = postings(spark, rows, 500)
    assert made.count() == len(rows)
    lists = made.groupBy("token").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = jaccard.in_shares(made.drop("share", "shares"), lists, 500).cache()
    assert shared.count() == 8_600 and shared.where("token = 9999").isEmpty()
    sizes = {(r["token"], r["share"]): (r["count"], r["shares"]) for r in shared.groupBy("token", "share", "shares").count().collect()}
    hot = [v for (t, _), v in sizes.items() if t == 7]
    assert len(hot) == 16 and max(n for n, _ in hot) < 650 and all(shares == 16 for _, shares in hot)
    assert all(v == (2, 1) for (t, _), v in sizes.items() if t != 7)


@pytest.mark.parametrize("long", [3, 10**9])
def test_shares_change_no_component(documents, monkeypatch, long):
    monkeypatch.setattr(jaccard.in_shares, "__defaults__", (long, 4))
    rng = random.Random(2)
    rows = [(i, edited(BASE, i % 9, i)) for i in range(40)] + [(100 + i, " ".join(BASE[:5] + text(40, i))) for i in range(30)]
    rows += [(200 + i, " ".join(f"t{k}" for k in sorted(rng.sample(range(30), 24)))) for i in range(20)]
    assert got(jaccard.near_duplicates(documents(rows))) == Counter(brute.components(rows))


def test_unrelated_members_of_a_hot_shingle_are_spread(spark, small_parts, conf):
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(5)
    lists = postings(spark, [(7, i, rng.randrange(60, 70), 0, i) for i in range(16_000)], jaccard.LONG_LIST).cache()
    lists.count()
    start = time.perf_counter()
    assert jaccard._cross_pairs(lists, 10, 80).count() == 0
    assert time.perf_counter() - start < 20
    cells = jaccard._cells(lists, 80, jaccard.LIST_BLOCK)
    per_task = sorted(r["count"] for r in cells.repartition(16, "token", "class", "one", "step", "two").groupBy(F.spark_partition_id()).count().collect())
    assert len(per_task) == 16 and per_task[-1] < 2 * per_task[8]


def test_subsets_come_a_few_sets_at_a_time(monkeypatch):
    import pyarrow as pa

    rng = random.Random(1)
    rows = pa.RecordBatch.from_pylist([{"rid": i, "tokens": [rng.getrandbits(60) for _ in range(25)]} for i in range(40)])
    parts = [b.num_rows for b in jaccard._subsets(rows, 80)]
    assert sum(parts) == 40 * 68_406 and max(parts) < jaccard.SENT_SUBSETS + 68_406
