from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cartwright.llm import packing
from cartwright.llm.registry import tokenizer_path

TEXTS = [None, "", " \n", "The quick brown FOX, it's 1234 times... jumping!!", "naïve Ünïcode — été ΟΔΟΣ İstanbul Å", "a b c <|endoftext|> d",
         "<|ENDOFTEXT|> x", "don't 'S he'll foo's,bar.", "日本語 текст\x00 control\x1c", "é ́x", "word " * 5000, "@@@ ### ,.,. a.b.c 3.14 x1y2"]


def whole(text):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, length int, part string")


def test_pieces_are_the_tokenizers_ids(spark, small_parts):
    got = {}
    for r in packing.pieces(docs(spark, TEXTS), tokenizer_path(), capacity=64, with_ids=True).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, text in enumerate(TEXTS):
        ids, mine = whole(text), sorted(got[i], key=lambda r: r["piece"])
        assert [p["start"] for p in mine] == list(range(0, len(ids), 64)) and [p["piece"] for p in mine] == list(range(len(mine)))
        assert np.concatenate([p["ids"] for p in mine]).tolist() == ids.tolist()
        assert [p["ids_crc32"] for p in mine] == [zlib.crc32(ids[k:k + 64].tobytes()) for k in range(0, len(ids), 64)]


def fewest(lengths, capacity):
    best = len(lengths)
    for assignment in itertools.product(range(len(lengths)), repeat=len(lengths)):
        rooms = {}
        for size, bin_ in zip(lengths, assignment):
            rooms[bin_] = rooms.get(bin_, 0) + size
        if max(rooms.values()) <= capacity:
            best = min(best, len(rooms))
    return best


def test_bounds_and_best_fit_around_the_optimum():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.choice([10, 12, 15])
        lengths = np.array([rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 6))])
        optimum = fewest(lengths.tolist(), capacity)
        bins, offsets, rooms = packing.best_fit(lengths, capacity)
        assert packing.lower_bound(lengths, capacity) <= optimum <= len(rooms)
        for b in range(len(rooms)):
            mine = sorted(zip(offsets[bins == b], lengths[bins == b]))
            assert [o for o, _ in mine] == np.cumsum([0] + [n for _, n in mine])[:-1].tolist()
            assert sum(n for _, n in mine) + rooms[b] == capacity
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3  # the plain sum says 2


def test_another_tokenizer_encodes_whole_texts(spark, small_parts):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.ids_of(tokenizer_path()).by_word and not packing.ids_of(path).by_word
    tokenizer, got = Tokenizer.from_file(path), {}
    for r in packing.pieces(docs(spark, TEXTS), path, capacity=512, with_ids=True).orderBy("doc_id", "piece").collect():
        got.setdefault(r["doc_id"], []).extend(r["ids"])
    for i, text in enumerate(TEXTS):
        assert got[i] == tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("cut", [1, 4, 8])
@pytest.mark.parametrize("most", [5, 40, 10_000])
def test_sequences_are_gapless_and_few(spark, small_parts, most, cut):
    rng = random.Random(4)
    lengths = [rng.randrange(1, 101) for _ in range(400)]
    items = spark.createDataFrame([(i, n, 1, "x") for i, n in enumerate(lengths)], "doc_id bigint, length int, offset int, part string")
    got = packing.pack(items.repartition(cut), 100, most).toPandas()
    assert sorted(got.doc_id) == list(range(400)) and got.length.tolist() == [lengths[i] for i in got.doc_id]
    ordered = got.sort_values(["sequence_id", "offset"])
    end = ordered.offset + ordered.length
    assert (ordered.offset == end.groupby(ordered.sequence_id).shift(fill_value=0)).all() and end.max() <= 100
    bound, alone = packing.lower_bound(np.array(lengths), 100), len(packing.best_fit(np.array(lengths), 100)[2])
    assert bound <= got.sequence_id.nunique() <= alone * {5: 1.25, 40: 1.1, 10_000: 1}[most]


def test_the_cut_of_the_input_does_not_matter(spark, small_parts):
    rng = random.Random(5)
    items = spark.createDataFrame([(i, rng.randrange(1, 101), {"a": i}) for i in range(300)], "doc_id bigint, length int, more map<string,int>")
    packed = [sorted(map(str, packing.pack(items.repartition(cut), 100, 60).collect())) for cut in (1, 5)]
    assert packed[0] == packed[1]


def test_equal_pieces_that_are_hot_are_spread(spark, small_parts):
    items = spark.createDataFrame([(1, 30)] * 900 + [(i, 40) for i in range(300)], "doc_id bigint, length int")
    marked = items.selectExpr("struct(doc_id) AS rest", "length", "monotonically_increasing_id() AS at")
    sizes = [r["count"] for r in packing._dealt(marked, 12).groupBy("part").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 200


def test_repeated_and_empty(spark, small_parts):
    same = spark.createDataFrame([(None, "a b c", 0, "x")] * 5, "doc_id bigint, text string, length int, part string")
    got = packing.sequences(same, tokenizer_path()).collect()
    assert len(got) == 5 and len({r["sequence_id"] for r in got}) == 1 and sorted(r["offset"] for r in got) == [0, 4, 8, 12, 16]
    assert packing.sequences(docs(spark, []), tokenizer_path()).count() == 0
