"""Substring deduplication: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

Every window of ``window`` consecutive words is hashed by a rolling polynomial and counted over the whole corpus by
``census``. Windows found at least twice merge into maximal intervals of words, and those words go.

Windows are told apart by 64 random bits: in a corpus of n windows about n^2 / 2^65 pairs agree by chance, 4e-4 pairs at
10^8 windows. Chunks, buckets and answers are bounded by ``layout``; a passage in a third of all documents is sent once per chunk.

Defined cases: null or empty text has no words and an empty kept text; texts shorter than a window lose nothing; repeated
rows, ids included, count as separate documents; null ids are kept as they are; a very long text is hashed and cut a
stretch at a time, and takes about a dozen times its number of words in bytes besides itself; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm import census
from cartwright.llm.base import Block, blocks, rest_of, stretches, texts, unrest

#: The window of the production queries.
WINDOW = 35


def _windows(group: pa.Table, window: int) -> np.ndarray:
    found = [b.windows(window)[0] for b in blocks(texts(group["text"]))]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def covered(block: Block, repeated: np.ndarray, window: int) -> np.ndarray:
    """Which words of a block lie in a repeated window; ``repeated`` holds positions."""
    edges = np.zeros(len(block.hashes) + 1, np.int32)
    np.add.at(edges, repeated, 1)
    np.subtract.at(edges, repeated + window, 1)
    return np.cumsum(edges[:-1]) > 0


def kept_words(text: bytes, gone: np.ndarray | None) -> bytes:
    """The words of a text that are not ``gone``, joined by one space; a stretch of it is split at a time."""
    parts, at = [], 0
    for part in stretches(text):
        words = part.split()
        if gone is not None:
            words, at = [w for w, g in zip(words, gone[at:at + len(words)].tolist()) if not g], at + len(words)
        parts.append(b" ".join(words))
    return b" ".join(filter(None, parts))


def intervals(gone: np.ndarray) -> list[int]:
    """Maximal runs of removed words as start, end, start, end ..."""
    return np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).view(np.int8))).tolist()


def _cut(group: pa.Table, repeated: census.Repeated, window: int, with_text: bool) -> pa.Table:
    raw = texts(group["text"])
    n_words, n_removed, kept_text, digests, spans = [], [], [], [], []
    for block in blocks(raw):
        again = [at[repeated.classes_of(hashes) > 0] for hashes, at in block.window_parts(window)]
        gone = covered(block, np.concatenate(again), window)
        start = 0
        for i, end in enumerate(block.ends.tolist(), block.first):
            mine = gone[start:end]
            removed = int(np.count_nonzero(mine))
            joined = kept_words(raw[i] or b"", mine if removed else None)
            n_words.append(end - start)
            n_removed.append(removed)
            digests.append(hashlib.sha256(joined).hexdigest())
            spans.append(intervals(mine) if removed else [])
            if with_text:
                kept_text.append(joined if removed else raw[i])
            start = end
    columns = {"rest": group["rest"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
               "kept_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.list_(pa.int64()))}
    if with_text:
        columns["kept_text"] = pa.array(kept_text, pa.binary()).cast(pa.string())
    return pa.table(columns)


def remove_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, with_text: bool = True,
                   sizes: census.Sizes = census.Sizes()) -> DataFrame:
    """Every row of ``docs`` without its text, and: n_words, n_removed, kept_sha256 (of the kept words joined by one
    space), spans (start, end, start, end ... in words) and, ``with_text``, kept_text: the kept words joined by one
    space where any went, else the text as written. Columns of ``docs`` with one of these names give way.
    """
    found = ["n_words", "n_removed", "kept_sha256", "spans"] + (["kept_text"] if with_text else [])
    lay = census.layout(docs, text, 8, sizes)
    rest = rest_of(docs, text, *found)
    chunked = docs.select(rest.alias("rest"), F.col(f"`{text}`").alias("text"), census.chunk_of(lay, docs))
    kind = docs.select(rest.alias("rest")).schema["rest"].dataType.simpleString()
    schema = f"rest {kind}, n_words bigint, n_removed bigint, kept_sha256 string, spans array<bigint>"
    done = census.census(
        chunked, lambda g: _windows(g, window), lay, lambda g, r: _cut(g, r, window, with_text),
        schema + (", kept_text string" if with_text else ""))
    return unrest(done, [c for c in docs.columns if c != text], found)


def without_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the same columns, its texts being ``kept_text``."""
    others = [c for c in docs.columns if c != text]
    whole = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{text}`").alias("text"))
    cut = remove_repeats(whole, "text", window)
    return cut.select(*[(F.col("kept_text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
