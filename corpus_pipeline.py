"""The corpus pipeline: toxic documents go, one of each group of near copies stays, repeated passages go, sources are
mixed to their target weights, and what is left is packed into sequences.

Defined cases, for every stage: a null text is an empty one, which is never toxic, near to nothing or repeated; a null id
stands for a document like others; repeated rows are one after the near-duplicate stage; very long texts pass whole; columns
beyond those of documents are kept by all stages but the last, whatever their names; an empty table stays empty."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwright.llm import jaccard, mixing, packing, repeats, toxicity  # noqa: E402
from cartwright.llm.base import reachable, staged, table  # noqa: E402
from cartwright.llm.registry import tokenizer_path  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; learns from the labels outside the held-out fold."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of similar shingle sets."""
    return jaccard.without_near_duplicates(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their texts less every passage of 35 words or more that occurs again."""
    return repeats.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.sequences(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learning, similarity components and packing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before wrote."""
    reachable(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
