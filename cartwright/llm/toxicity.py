"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and unlabelled texts (U) train linear classifiers in numpy on the risk
``prior * loss(P, +) + max(0, loss(U, -) - prior * loss(P, -))``: U holds the class prior's share of toxic texts, whose
loss as negatives is taken out again, never below zero. The prior is the share of toxic rows among the labels learned
from. A text's features are the words it holds (lower case, punctuation apart), of which those whose document
frequencies in P and U differ beyond chance are kept, by 64-bit hash, so rare words never share a feature.

Bounds: P and U are hash samples of the ids of at most about ``MOST_POSITIVE`` and ``MOST_UNLABELLED`` documents, near copies
once, and at most ``MOST_WORDS`` words are kept. An id is expected to name one document: rows that share an id and differ are
drawn together. Every text is scored, whole, where it lies, without a shuffle.

Defined cases: columns named like a result give way to it; null and empty texts have no features and get the bias's score; a null id counts as held out; repeated
label rows count once, as toxic if any says so; null labels are none; without a toxic label every score is 0; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.base import blocks, rest_of, staged, texts, unrest

MOST_POSITIVE = 12_000
MOST_UNLABELLED = 24_000
MOST_WORDS = 2_048
#: Standard errors by which a word's frequencies in P and U must differ.
LEAST_Z = 4.5
#: Share of P or of U that must hold a word, and the documents this is at least: words that only a few copies of one
#: text hold say nothing of others.
LEAST_SHARE, LEAST_SEEN = 0.01, 3
#: The largest weight to start from.
START = 4.0

_FOLD = bytes(0x20 if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted hashes of the distinct words of every text."""
    raw = [t and t.translate(_FOLD) for t in texts(column)]
    for block in blocks(raw):
        start = 0
        for end in block.ends.tolist():
            yield np.unique(block.hashes[start:end])
            start = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of a batch's words, by class."""
    for batch in batches:
        toxic = np.array(batch["toxic"].to_pylist(), bool)
        words = list(words_of(batch["text"]))
        every = np.concatenate(words) if words else np.zeros(0, np.uint64)
        marks = np.repeat(toxic, [len(w) for w in words])
        found, at = np.unique(every, return_inverse=True)
        seen = np.bincount(at, minlength=len(found))
        positive = np.bincount(at[marks], minlength=len(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(positive.astype(np.int64)), pa.array((seen - positive).astype(np.int64))],
            ["word", "p", "u"])


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add each text's least five-word shingle hash (of its least word's, if shorter), equal for most near copies."""
    for batch in batches:
        prints = []
        for block in blocks([t and t.translate(_FOLD) for t in texts(batch["text"])]):
            hashes, at = block.windows(5)
            start, word = 0, 0
            for end, stop in zip(np.searchsorted(at, block.ends).tolist(), block.ends.tolist()):
                found = hashes[start:end] if end > start else block.hashes[word:stop]
                prints.append(found.min() if len(found) else 0)
                start, word = end, stop
        yield pa.RecordBatch.from_arrays(
            [batch["text"], batch["toxic"], pa.array(np.array(prints, np.uint64).view(np.int64))], ["text", "toxic", "print"])


def _features(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [places(w, vocabulary).tolist() for w in words_of(batch["text"])]
        yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(rows, pa.list_(pa.int32()))], ["toxic", "at"])


def places(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Which of the sorted vocabulary a text holds."""
    if not len(vocabulary):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    return at[vocabulary[at] == words]


def sample(docs: DataFrame, labels: DataFrame, seed: int = 0) -> tuple[DataFrame, float]:
    """P and U as ``text, toxic``, and the class prior. ``docs`` and ``labels (id, toxic)`` hold rows to learn from only."""
    share = lambda c: F.pmod(F.xxhash64(c, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    marks = labels.where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    seen = marks.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.when(F.col("toxic") == 1, 1)), F.lit(0)).alias("p")).first()
    n_docs = docs.count()
    part_p, part_u = MOST_POSITIVE / max(1, seen["p"]), MOST_UNLABELLED / max(1, n_docs)
    # Both id lists hold at most about the stated number of rows, whatever the tables.
    positive = F.broadcast(marks.where((F.col("toxic") == 1) & (share("id") < part_p)).select("id"))
    labelled = F.broadcast(marks.where(share("id") < part_u).select("id"))
    p = docs.join(positive, "id", "left_semi").select("text", F.lit(True).alias("toxic"))
    u = docs.where(share("id") < part_u).join(labelled, "id", "left_anti").select("text", F.lit(False).alias("toxic"))
    # Near copies count once: a family of them would pass for a class.
    once = p.unionByName(u).mapInArrow(_printed, "text string, toxic boolean, print bigint").dropDuplicates(["toxic", "print"])
    return staged(once.select("text", "toxic"), "sample"), seen["p"] / max(1, seen["n"])


def vocabulary_of(examples: DataFrame) -> np.ndarray:
    """Hashes of the words whose document frequencies differ most between P and U, sorted."""
    sizes = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return np.zeros(0, np.uint64)
    counts = examples.mapInArrow(_counted, "word bigint, p bigint, u bigint").groupBy("word").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u"))
    rate = (F.col("p") + F.col("u") + 1) / (n_p + n_u + 2)
    z = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(rate * (1 - rate) * (1 / n_p + 1 / n_u))
    least = max(LEAST_SHARE, LEAST_SEEN / n_p)
    best = (counts.where(F.greatest(F.col("p") / n_p, F.col("u") / n_u) >= least).select("word", z.alias("z")).where(F.abs("z") >= LEAST_Z)
            .orderBy(F.abs("z").desc(), "word").limit(MOST_WORDS).collect())
    return np.sort(np.array([r["word"] for r in best], np.int64).view(np.uint64))


# ---- learning -------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Rows:
    """Texts as lists of feature places."""

    def __init__(self, lists: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.flat = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __len__(self) -> int:
        return len(self.sizes)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature places of some rows, and the row of each."""
        sizes = self.sizes[rows]
        owner = np.repeat(np.arange(len(rows)), sizes)
        return self.flat[np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.starts[rows], sizes)], owner


def train(positive: Rows, unlabelled: Rows, width: int, prior: float, seed: int, epochs: int = 12, batch: int = 1024,
          rate: float = 0.03, decay: float = 3e-3) -> np.ndarray:
    """Weights and, last, the bias: Adam on the non-negative risk with the logistic loss.

    It starts from each word's log odds, and is drawn back to them by ``decay``; a word's frequency among
    negatives is U's less the prior's share of P's.
    """
    rng = np.random.default_rng(seed)
    in_p, in_u = (np.bincount(x.flat, minlength=width) / len(x) for x in (positive, unlabelled))
    in_n = np.maximum(in_u - prior * in_p, 0) / (1 - prior)
    least = 1 / min(len(positive), len(unlabelled))
    weights = np.append(np.clip(np.log((in_p + least) / (in_n + least)), -START, START), np.log(prior / (1 - prior)))
    start = weights.copy()
    first, second, step = np.zeros_like(weights), np.zeros_like(weights), 0
    rounds = max(8, -(-len(unlabelled) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(unlabelled))
        for part in np.array_split(order, rounds):
            mine = rng.integers(0, len(positive), min(batch, 4 * len(positive)))
            at_p, row_p = positive.take(mine)
            at_u, row_u = unlabelled.take(part)
            out_p = _sigmoid(np.bincount(row_p, weights[at_p], len(mine)) + weights[-1])
            out_u = _sigmoid(np.bincount(row_u, weights[at_u], len(part)) + weights[-1])
            negative = -np.log1p(-np.minimum(out_u, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(out_p, 1 - 1e-12)).mean()
            # Slopes of the three mean losses by each row's output.
            if negative >= 0:
                slope_p, slope_u = prior * (out_p - 1) - prior * out_p, out_u
            else:  # the risk of the negatives is at its floor and has no slope
                slope_p, slope_u = prior * (out_p - 1), 0.0 * out_u
            slope_p, slope_u = slope_p / len(mine), slope_u / max(1, len(part))
            gradient = decay * (weights - start)
            gradient[:-1] += np.bincount(at_p, slope_p[row_p], width) + np.bincount(at_u, slope_u[row_u], width)
            gradient[-1] += slope_p.sum() + slope_u.sum()
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def fit(docs: DataFrame, labels: DataFrame, classifiers: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The vocabulary and the weights (one row per classifier) from ``docs (id, text)`` and ``labels (id, toxic)``."""
    examples, prior = sample(docs, labels)
    vocabulary = vocabulary_of(examples)
    if not len(vocabulary) or not 0 < prior < 1:
        return np.zeros(0, np.uint64), np.zeros((0, 1))
    rows = examples.mapInArrow(lambda b: _features(b, vocabulary), "toxic boolean, at array<int>").toArrow()
    toxic = np.array(rows["toxic"].to_pylist(), bool)
    lists = [np.array(x, np.int64) for x in rows["at"].to_pylist()]
    positive, unlabelled = Rows([x for x, t in zip(lists, toxic) if t]), Rows([x for x, t in zip(lists, toxic) if not t])
    weights = [train(positive, unlabelled, len(vocabulary), prior, seed) for seed in range(classifiers)]
    return vocabulary, np.stack(weights)


def score(docs: DataFrame, text: str, vocabulary: np.ndarray, weights: np.ndarray, keep_text: bool = False) -> DataFrame:
    """``docs``, without its text unless asked for, and score (the classifiers' mean probability) and predicted."""
    found = ["score", "predicted"]
    rest = rest_of(docs, text, *found)
    kind = docs.select(rest.alias("rest")).schema["rest"].dataType.simpleString()
    names = ["rest", *(["text"] if keep_text else []), *found]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(weights):
                sums = np.array([weights[:, places(w, vocabulary)].sum(axis=1) for w in words_of(batch["text"])]).reshape(-1, len(weights))
                scores = _sigmoid(sums + weights[:, -1]).mean(axis=1)
            else:
                scores = np.zeros(batch.num_rows)
            columns = {"rest": batch["rest"], "text": batch["text"], "score": pa.array(scores),
                       "predicted": pa.array((scores >= 0.5).astype(np.int32))}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    done = docs.select(rest.alias("rest"), F.col(f"`{text}`").alias("text")).mapInArrow(
        scored, f"rest {kind}, {'text string, ' if keep_text else ''}score double, predicted int")
    shown = [text, *found] if keep_text else found
    if keep_text:
        done = done.withColumnRenamed("text", text)
    return unrest(done, [c for c in docs.columns if c != text], shown)


def fold(id_: str, parts: int) -> Column:
    return F.pmod(F.crc32(F.col(f"`{id_}`").cast("string")), F.lit(parts))


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with held_out, score and predicted; learns from rows outside the held-out fifth only."""
    learn = (docs.select(F.col(f"`{id_}`").alias("id"), F.col(f"`{text}`").alias("text"))
             .where(F.col("id").isNotNull() & (fold("id", 5) != 0)))
    marks = labels.select(F.col(f"`{id_}`").alias("id"), "toxic").where(fold("id", 5) != 0)
    held_out = F.coalesce(fold(id_, 5) == 0, F.lit(True))
    return score(docs.withColumn("held_out", held_out), text, *fit(learn, marks))


def without_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """``docs``, columns as they are, without the rows predicted toxic."""
    learn = (docs.select(F.col(f"`{id_}`").alias("id"), F.col(f"`{text}`").alias("text"))
             .where(F.col("id").isNotNull() & (fold("id", 5) != 0)))
    marks = labels.select(F.col(f"`{id_}`").alias("id"), "toxic").where(fold("id", 5) != 0)
    whole = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"),
                        F.col(f"`{text}`").alias("text"))
    scored = score(whole, "text", *fit(learn, marks), keep_text=True).where("predicted = 0")
    return scored.select(*[F.col("text" if c == text else f"row.`{c}`").alias(c) for c in docs.columns])
