"""Held-out accuracy of the trained operators, and their defined cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from cartwright.llm import language, toxicity

SF = "/root/testdata/sf0.1"


def labelled(spark, texts_of, n, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 9 == 0
        words = [f"plain{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        if toxic:
            words[rng.randrange(len(words))] = f"Slur{rng.randrange(4)}!"
        rows.append((i, " ".join(words), 1, "x"))
        if i % 2:
            labels.append((i, int(toxic)))
    return rows, labels


DDL = "doc_id bigint, text string, score int, rest string"


def test_toxicity_of_held_out_documents(spark, small_parts):
    rows, labels = labelled(spark, None, 3000)
    extra = [(5000, None, 1, "x"), (5001, "", 1, "x"), (None, "slur1 slur2 slur0", 1, "x"), (5002, "plain1 " * 50_000 + "slur3 SLUR1", 1, "x"), (7, rows[7][1], 1, "x")]
    marks = spark.createDataFrame(labels + [(labels[0][0], None), (None, 1), (99_999, 1)], "doc_id bigint, toxic int")
    done = toxicity.toxicity(spark.createDataFrame(rows + extra, DDL), marks).collect()
    assert len(done) == len(rows) + len(extra)
    truth = {i: int("Slur" in t) for i, t, *_ in rows}
    held = [r for r in done if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in done if r["doc_id"] is not None)
    assert len(held) > 400 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.98
    by_id = {r["doc_id"]: r for r in done if r["doc_id"] is None or r["doc_id"] >= 5000}
    assert by_id[5000]["score"] == by_id[5001]["score"] < 0.5 and by_id[5000]["predicted"] == 0
    assert by_id[None]["predicted"] == 1 and by_id[5002]["predicted"] == 1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in done)


def test_toxic_stage_keeps_clean_rows_as_they_are(spark, small_parts):
    rows, labels = labelled(spark, None, 2000)
    docs = spark.createDataFrame(rows, DDL)
    kept = toxicity.without_toxic(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert kept.columns == docs.columns
    ids, clean = {r["doc_id"] for r in kept.collect()}, {i for i, t, *_ in rows if "Slur" not in t}
    assert len(ids & clean) >= 0.995 * len(clean) and len(ids - clean) <= 0.05 * (len(rows) - len(clean))


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, None)]])
def test_without_toxic_labels_nothing_is_toxic(spark, small_parts, labels):
    docs = spark.createDataFrame([(1, "a", 1, "x"), (2, None, 1, "x")], DDL)
    done = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    assert [(r["score"], r["predicted"]) for r in done] == [(0.0, 0)] * 2
    assert toxicity.toxicity(docs.limit(0), spark.createDataFrame(labels, "doc_id bigint, toxic int")).count() == 0


def test_risk_corrects_for_the_prior():
    rng = np.random.default_rng(0)
    rows = lambda n, share: [np.array([0] if rng.random() < share else [1]) for _ in range(n)]
    weights = toxicity.train(toxicity.Rows(rows(400, 1.0)), toxicity.Rows(rows(4000, 0.3)), 2, 0.3, 0)
    assert weights[0] + weights[2] > 0 > weights[1] + weights[2]


def test_languages_of_held_out_documents(spark, small_parts):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    got = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 2000 and (got.lang_pred == got.lang).mean() > 0.98
    assert got.score.between(0, 1).all()
    wrong, right = got[got.lang_pred != got.lang], got[got.lang_pred == got.lang]
    assert wrong.accepted.mean() < right.accepted.mean()


def test_languages_defined_cases(spark, small_parts):
    rng = random.Random(1)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(5))
    known = [(i, " ".join(word("abcdef" if i % 2 else "uvwxyz") for _ in range(60)), "aa" if i % 2 else "zz") for i in range(400)]
    odd = [(1000, None, "aa"), (1001, "", None), (1002, "123 --- !!", "zz"), (1003, " ".join(word("abcdef") for _ in range(99)), None),
           (None, " ".join(word("UVWXYZ") for _ in range(99)), "aa"), (1004, "é" * 3, None), (1005, " ".join(word("uvwxyz") for _ in range(40_000)), None)]
    ddl = "doc_id bigint, text string, lang string"
    done = {r["doc_id"]: r for r in language.languages(spark.createDataFrame(known + odd, ddl)).collect()}
    assert [done[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None, 1005)] == ["und", "und", "und", "aa", "zz", "zz"]
    assert done[1000]["score"] == 0 and not done[1000]["accepted"] and done[1003]["accepted"] and done[1004]["lang_pred"] in ("aa", "zz")
    assert done[None]["held_out"] and done[7]["held_out"] == (zlib.crc32(b"7") % 4 == 2)
    nothing = language.languages(spark.createDataFrame([(1, "abc", None)], ddl)).collect()
    assert (nothing[0]["lang_pred"], nothing[0]["score"]) == ("und", 0.0)
    assert language.languages(spark.createDataFrame([], ddl)).count() == 0


def test_sizes_like_one_compressor_after_the_other():
    """Every dictionary by itself on every segment, with the library's plain calls; the smallest sum wins."""
    import zstandard

    rng = random.Random(3)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(5))
    dictionaries = {name: language.folded(" ".join(word(letters) for _ in range(3000)).encode()) for name, letters in
                    (("aa", "abcdefgh"), ("mm", "ghijklmn"), ("zz", "mnopqrst"))}
    for n in (3, 60, 3000):
        for letters in ("abcdefgh", "hijklmn", "opqrst", "abst"):
            raw = language.folded(" ".join(word(letters) for _ in range(n)).encode())
            naive = {}
            for name, content in dictionaries.items():
                total = 0
                for at in range(0, len(raw), language.SEGMENT):
                    plain = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=zstandard.ZstdCompressionDict(
                        content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False)
                    total += len(plain.compress(raw[at:at + language.SEGMENT]))
                naive[name] = total
            assert language.Sizer(dictionaries).sizes(raw) == list(naive.values())


def test_language_is_learned_from_whole_texts_and_repeated_rows_once(spark, small_parts):
    """The start of every text is the same; only what follows tells the languages apart."""
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(5))
    start = "this is how every page begins " * 40
    rows = [(i, start + " ".join(word("abcdef" if i % 2 else "uvwxyz") for _ in range(900)), "aa" if i % 2 else "zz") for i in range(300)]
    rows += [(rows[4][0], rows[4][1], "zz")] * 2000
    ddl = "doc_id bigint, text string, lang string"
    dictionaries = language.learn(spark.createDataFrame(rows, ddl).withColumnRenamed("doc_id", "id"))
    assert set(dictionaries) == {"aa", "zz"} and sum(c in b"uvwxyz" for c in dictionaries["zz"]) > len(dictionaries["zz"]) / 3
    assert len(dictionaries["zz"].split()) > 0 and all(len(d) <= language.DICTIONARY for d in dictionaries.values())


def test_training_like_a_plain_descent_on_the_risk():
    """The same steps with the risk as written and its slopes by differences, on dense features."""
    rng = np.random.default_rng(5)
    width, prior = 4, 0.3
    lists = lambda n, p: [np.flatnonzero(rng.random(width) < p) for _ in range(n)]
    positive, unlabelled = lists(9, 0.6), lists(40, 0.3)
    dense = lambda rows: np.array([[float(k in set(r.tolist())) for k in range(width)] + [1.0] for r in rows])
    p_rows, u_rows = dense(positive), dense(unlabelled)
    loss = lambda rows, w, sign: np.log1p(np.exp(-sign * (rows @ w))).mean()

    def risk(w, p, u):
        return prior * loss(p, w, 1) + max(0.0, loss(u, w, -1) - prior * loss(p, w, -1))

    def slope(f, w, h=1e-5):
        return np.array([(f(w + h * e) - f(w - h * e)) / (2 * h) for e in np.eye(len(w))])

    got = toxicity.train(toxicity.Rows(positive), toxicity.Rows(unlabelled), width, prior, seed=3, epochs=3, batch=8)
    draw = np.random.default_rng(3)
    share_p, share_u = p_rows[:, :-1].mean(0), u_rows[:, :-1].mean(0)
    least = 1 / 9
    odds = np.log((share_p + least) / (np.maximum(share_u - prior * share_p, 0) / (1 - prior) + least))
    w = np.append(np.clip(odds, -toxicity.START, toxicity.START), np.log(prior / (1 - prior)))
    start, first, second, step = w.copy(), np.zeros(width + 1), np.zeros(width + 1), 0
    for _ in range(3):
        order = draw.permutation(40)
        for part in np.array_split(order, 8):
            mine = draw.integers(0, 9, 8)
            gradient = slope(lambda x: risk(x, p_rows[mine], u_rows[part]), w) + 3e-3 * (w - start)  # noqa: B023
            step += 1
            first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
            w = w - 0.03 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    assert np.allclose(got, w, atol=1e-4) and not np.allclose(got, start, atol=0.05)


def test_scores_like_a_plain_sum(spark, small_parts):
    from cartwright.llm.base import word_hashes

    known = {"bad": 1.5, "worse": 3.0, "fine": -2.0, "text": -0.5}
    hashes = {w: int(word_hashes(w.encode())[0][0]) for w in known}
    vocabulary = np.sort(np.array(list(hashes.values()), np.uint64))
    weights = np.zeros((2, len(known) + 1))
    for w, h in hashes.items():
        weights[:, np.searchsorted(vocabulary, np.uint64(h))] = known[w], known[w] / 2
    weights[:, -1] = -0.25, 0.25
    texts = [None, "", "bad", "BAD, worse! fine?", "bad bad bad", "nothing known", "text-fine", "é bad\tworse " * 3000]
    done = toxicity.score(spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], DDL), "text", vocabulary, weights).collect()
    for r in done:
        words = set((texts[r["doc_id"]] or "").lower().translate(str.maketrans(",!?-", "    ")).split())
        total = sum(known.get(w, 0) for w in words)
        plain = np.mean([1 / (1 + np.exp(-(total * scale + bias))) for scale, bias in ((1, -0.25), (0.5, 0.25))])
        assert r["score"] == pytest.approx(plain, abs=1e-12) and r["predicted"] == int(plain >= 0.5)
