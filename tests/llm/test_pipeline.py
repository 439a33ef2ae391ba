from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline as pipeline
from cartwright.llm import registry
from cartwright.llm.base import staged
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert [min(k for k in registry.QUERIES if k.startswith(f"op{n}_")) for n in range(1, 14)] and len(registry.QUERIES) == 13
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "mixing", "packing"]


@pytest.fixture(scope="module")
def stages(spark, small_parts):
    """What every stage returned on the smallest supplied tables, read again from where it was written."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        out.append((name, docs))
    return [(name, frame.toPandas()) for name, frame in out]


def test_columns_stay_until_the_last_stage(stages):
    for _, frame in stages[:-1]:
        assert list(frame.columns) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_near_duplicate_stage_like_brute_force(stages):
    before, after = stages[1][1], stages[2][1]
    wanted = {c for _, _, c in brute.components(list(zip(before.doc_id, before.text)))}
    assert sorted(after.doc_id) == sorted(wanted)


def test_substring_stage_like_brute_force(stages):
    import hashlib

    before, after = stages[2][1], stages[3][1].set_index("doc_id").text
    for id_, text, (_, removed, digest) in zip(before.doc_id, before.text, brute.without_repeats(list(before.text), 35)):
        assert hashlib.sha256(b" ".join(brute.words(after[id_]))).hexdigest() == digest
        assert removed or after[id_] == text


def test_mixing_and_packing_stages(stages):
    before, mixed, packed = stages[3][1], stages[4][1], stages[5][1]
    assert set(mixed.doc_id) <= set(before.doc_id) and mixed.groupby("doc_id").size().max() <= 3
    assert packed.groupby("doc_id").piece.apply(lambda p: (p == 0).sum()).to_dict() == mixed.groupby("doc_id").size().to_dict()
    ends = packed.sort_values(["sequence_id", "offset"])
    assert (ends.offset == (ends.offset + ends.length).groupby(ends.sequence_id).shift(fill_value=0)).all()
    assert (ends.offset + ends.length).max() <= 2048


def test_stages_on_an_empty_table_and_odd_rows(spark, small_parts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(0)
    odd = [(None, None, None, None, None), (None, "a b c", None, None, 1), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x " * 3000, "en", None, 3),
           (3, " ".join(f"w{rng.randrange(99)}" for _ in range(4000)), "en", "s", 1)]
    for rows in ([], odd):
        frame = spark.createDataFrame(rows, docs.schema)
        for name, stage in pipeline.STAGES:
            frame = staged(stage(spark, frame, SF), name)
        assert (frame.count() > 0) == bool(rows)
    assert np.isfinite(frame.toPandas().length).all()
