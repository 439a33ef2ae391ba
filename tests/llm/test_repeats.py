from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cartwright.llm import base, census, repeats
from tests.llm.brute import without_repeats


def passage(n, seed, vocabulary=40):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def got(frame):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in frame.collect())


def wanted(rows, width):
    return Counter((i, *x) for (i, _), x in zip(rows, without_repeats([t for _, t in rows], width)))


SHARED = passage(60, 1)
CASES = {
    "plain": [(1, f"{passage(20, 2)} {SHARED} {passage(9, 3)}"), (2, f"{passage(7, 4)}\n{SHARED}"), (3, passage(80, 5))],
    "in one document": [(1, f"{SHARED} between {SHARED}")],
    "overlapping repeats": [(1, " ".join(["a"] * 50)), (2, " ".join(["b"] * 34)), (3, " ".join(["c"] * 35))],
    "edges": [(1, None), (2, ""), (3, " \n\t"), (None, SHARED), (None, SHARED), (4, passage(34, 6)), (4, passage(35, 7))],
    "other spaces are word characters": [(1, SHARED.replace(" ", " ")), (2, SHARED.replace(" ", "\x1c")), (3, SHARED)],
    "copies": [(i, SHARED) for i in range(30)],
    "long": [(1, passage(30_000, 8, 5000)), (2, passage(30_000, 8, 5000)[:90_000]), (3, "x" * 200_000 + " " + SHARED)],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_like_brute_force(documents, name):
    rows = CASES[name]
    assert got(repeats.remove_repeats(documents(rows), window=35)) == wanted(rows, 35)


def test_random_texts_of_few_words(documents):
    rows = [(i, passage(random.Random(i).randrange(0, 40), i, 3)) for i in range(60)]
    assert got(repeats.remove_repeats(documents(rows), window=4)) == wanted(rows, 4)


def test_spans_are_maximal_and_columns_stay(documents):
    rows = CASES["plain"]
    done = {r["doc_id"]: r for r in repeats.remove_repeats(documents(rows)).collect()}
    assert done[1]["spans"] == [20, 80] and done[2]["spans"] == [7, 67] and done[3]["spans"] == []
    assert done[1]["kept_text"] == f"{passage(20, 2)} {passage(9, 3)}" and (done[1]["chunk"], done[1]["rest"]) == (0, "x")


def test_stage_keeps_columns_and_untouched_texts(documents):
    docs = documents([(1, "a  b\n c"), (2, None), (3, SHARED), (4, SHARED)])
    done = repeats.without_repeats(docs)
    assert done.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in done.collect()} == {1: "a  b\n c", 2: None, 3: "", 4: ""}


def test_word_hashes_do_not_depend_on_neighbours():
    alone = [base.word_hashes(w)[0][0] for w in (b"abc", b"\x00", b"\x00\x00", b"x" * 600)]
    together, starts = base.word_hashes(b" abc\t\x00\n" + b"\x00\x00 " + b"x" * 600)
    assert together.tolist() == alone and len(set(alone)) == 4 and starts.tolist() == [1, 5, 7, 10]


def test_layouts_answer_alike():
    import numpy as np

    keys = np.array([1 << 63, 5, 5, 9, (1 << 64) - 1], np.uint64)
    for lay in (census.Layout(3, 0, 8), census.Layout(3, 4, 8), census.Layout(3, 4, 4), census.Layout(3, 0, 4)):
        one, two = census.send(keys, 0, lay), census.send(keys[:1], 1, lay)
        import pyarrow as pa

        sent = pa.concat_tables([one, two]).to_pandas()
        answers = pa.concat_tables([census.answer(pa.Table.from_pandas(g, preserve_index=False), lay) for _, g in sent.groupby("bucket")])
        mine = answers.filter(pa.compute.equal(answers["chunk"], 0))
        classes = census.Repeated.of(mine, lay).classes_of(keys)
        assert (classes > 0).tolist()[0] and classes[0] == census.CLASSES and classes[1] > 0
        if lay.width == 8:
            assert (classes > 0).tolist() == [True, True, True, False, False]


def test_long_texts_in_stretches(monkeypatch):
    rng = random.Random(6)
    raw = " ".join("x" * rng.randrange(1, 40) if rng.random() < 0.1 else f"w{rng.randrange(90)}" for _ in range(4000)).encode()
    whole, = base.blocks([raw])
    monkeypatch.setattr(base, "BLOCK_BYTES", 256)
    monkeypatch.setattr(base, "stretches", lambda text, size=256, f=base.stretches: f(text, size))
    cut = list(base.blocks([b"a b c", raw, None]))
    assert [b.first for b in cut] == [0, 1, 2] and (cut[1].hashes == whole.hashes).all() and cut[1].ends.tolist() == [4000]
    assert len(list(cut[1].window_parts(5))) > 10
    for mine, theirs in zip(cut[1].windows(5), whole.windows(5)):
        assert (mine == theirs).all()
    gone = np.array([rng.random() < 0.3 for _ in range(4000)])
    assert repeats.kept_words(raw, gone) == b" ".join(w for w, g in zip(raw.split(), gone) if not g)
    assert repeats.kept_words(b" a  b\n", None) == b"a b" and repeats.kept_words(b"", None) == b""


def test_a_text_of_200_mb_within_1_gb():
    import tracemalloc

    raw = b"words of some length and then more of them again " * 4_300_000
    group = pa.table({"text": pa.array([raw], pa.large_binary()), "rest": pa.array([1])})
    tracemalloc.start()
    (block,) = base.blocks([raw])
    keys = sum(len(hashes) for hashes, _ in block.window_parts(35))
    assert keys == len(block.hashes) - 34 == 43_000_000 - 34
    assert len(repeats.kept_words(raw, None)) == len(raw) - 1
    assert tracemalloc.get_traced_memory()[1] < 1 << 30 and group.num_rows == 1
    tracemalloc.stop()


@pytest.mark.parametrize("terabytes", [0.0005, 1, 10, 100])
def test_messages_keep_their_size(terabytes):
    total = int(terabytes * 10**12)
    lay = census.layout_for(total, 200, 8)
    keys = total / census.WORD_BYTES
    assert keys / lay.chunks / lay.buckets >= 32 or terabytes < 0.01
    assert 45 * keys / lay.buckets < 3.5e9 and total / lay.chunks < 400e6


def test_equal_rows_are_dealt_apart(spark, small_parts):
    docs = spark.createDataFrame([(None, "one text " * 50)] * 3000 + [(i, f"other {i}") for i in range(300)], "doc_id bigint, text string")
    lay = census.Layout(12, 3, 8)
    sizes = [r["count"] for r in docs.select(census.chunk_of(lay, docs)).groupBy("chunk").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 3300 / 12
