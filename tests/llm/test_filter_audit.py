from __future__ import annotations

from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwright.llm import filter_audit as audit

LONG = " ".join(f"word{i}" for i in range(230))


def fails(text, earlier):
    text = text or ""
    words = text.encode().split()
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": any(c in "#$%&*|" for c in text), "E": earlier}


def brute(rows, labels):
    """rows: (id, text, source); labels: (id, quality, toxic). One filter after the other, for every order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, t, s in rows:
        earlier = i is not None and any(j is not None and j < i and (u or "") == (t or "") for j, u, _ in rows)
        docs.append((s or "", fails(t, earlier), i in good, i in toxic))
    out = set()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        runs, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                shapley[f] += len(gone)
                runs.append(("".join(order), step, f, len(left), len(gone), sum(d[1][f] for d in mine) - len(gone),
                             sum(d[1][f] and sum(d[1].values()) == 1 for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out |= {(part, order, step, *rest, shapley[f]) for order, step, f, *rest in runs}
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, n, "x") for n, (i, t, s) in enumerate(rows)],
                                 "doc_id bigint, text string, source string, mask int, print string")


def run(spark, rows, labels):
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return [tuple(r) for r in audit.audit(table(spark, rows), known).collect()]


def test_every_order_against_one_filter_after_the_other(spark, small_parts):
    rng = np.random.default_rng(3)
    pool = [None, "", "short", LONG, LONG + " #", "SHOUT " * 250, LONG + " A B C", "a b " * 150, LONG + " & " + "Z" * 80, "SHOUT $ " * 40]
    rows = [(int(i), pool[rng.integers(len(pool))] if i % 3 else LONG + f" own{i}", [None, "", "s1", "s2"][rng.integers(4)]) for i in range(120)]
    rows += [(None, LONG, "s1"), (None, LONG, None), (7, rows[7][1], rows[7][2]), (7, LONG, "s3"), (-5, "short", "s2")]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 120, 2)] + [(4, 1, 1), (None, 1, 1), (3, None, None), (999, 1, 1)]
    got = run(spark, rows, labels)
    assert len(got) == len(set(got)) == 4 * 600 and set(got) == brute(rows, labels)


def test_copies_of_one_text_and_empty_tables(spark, small_parts):
    got = run(spark, [(i, LONG, "s") for i in range(300)], [])
    at = {(r[1], r[2]): r for r in got}
    assert at["EABCD", 1][3:5] == (1, 299) and at["ABCDE", 5][3:8] == (1, 299, 0, 299, 0) and at["EABCD", 1][-1] == 120 * 299
    assert run(spark, [], [(1, 1, 1)]) == []


@given(st.lists(st.sampled_from(["a", "bb", "ccc", " ", "\t", "\x0b", "é", " "]), max_size=60), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_words_in_stretches(parts, stretch):
    text = "".join(parts).encode()
    assert audit.word_counts(text, stretch) == (len(text.split()), len(set(text.split())))


def test_long_texts_hold_only_their_distinct_words():
    import tracemalloc

    text = b"some words again and again " * 2_000_000
    tracemalloc.start()
    assert audit.word_counts(text) == (10_000_000, 4)
    assert tracemalloc.get_traced_memory()[1] < 64 << 20
    tracemalloc.stop()


@pytest.mark.parametrize("filters", [1, 3, 5])
def test_states_and_the_walk(filters):
    cells = np.random.default_rng(0).integers(0, 9, (4, 1 << filters, 3))
    masks = np.arange(1 << filters)
    wanted = np.stack([cells[:, (masks & s) == 0].sum(axis=1) for s in masks], axis=1)
    assert (audit.states(cells) == wanted).all()
    walked = [s for _, s, _ in audit.gray_walk(filters)]
    assert sorted([0, *walked]) == masks.tolist()
    assert all((a ^ b).bit_count() == 1 for a, b in zip([0, *walked], walked))
