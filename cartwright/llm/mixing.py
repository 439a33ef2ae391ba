"""Mixing sources to target weights by subset-sum budget fitting.

A document's size is its number of words. Sources, in code-point order with null last, weigh 1, 2, 3 and so on again;
their targets share the size of the whole corpus by weight, none above ``MOST`` times its source, the excess going to
the others by weight. A source takes whole documents: every one ``target // size`` times, and once more a subset whose
sizes add up to the remaining budget as nearly as they can. That subset is found from the counts of documents by exact
size: first every size's even share, then bounded-knapsack dynamic programming over what is left of the budget and of
the counts. Which documents of a size are taken is the order of a seeded hash of their content.

The programme sees one row per source and size, never a document; a hot source or size is cut into ranges of the hash
before documents are ranked. Reruns agree: nothing depends on partitions.

Defined cases: null and empty texts have size 0 and are never taken; rows equal in every column share a hash and are
ranked in any order, which no result shows; null ids are kept; a source of size 0 has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwright.llm.base import WORD_BREAK, partitions, rest_of, staged, unrest

WEIGHTS = (1, 2, 3)
#: The most often a document may be taken, and the largest target in sizes of its source.
MOST = 3
#: Budgets beyond this are first brought below it by even shares and large documents; the programme's table has a bit for each.
LEAST_BUDGET = 1 << 16


def size_of(text: str):
    """Words of a text, counted without naming them: breaks between words, plus one where the text has any."""
    body = F.trim(F.regexp_replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), WORD_BREAK, " "))
    return F.when(body == "", F.lit(0)).otherwise(F.length(body) - F.length(F.translate(body, " ", "")) + 1).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """``known, name, source_size, target`` from ``sizes (known, name, source_size)``, one row per source; the null
    source has ``known`` false and an empty name.

    Raising all targets by weight until they add up, each stopping at its cap, gives the same fixed point as handing
    the excess on until none is above. With sources in the order of cap per weight, the level is found at the first
    that the level does not cap, and would only fall further on.
    """
    by_name = [F.col("known").desc(), F.encode("name", "utf-8")]
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          (F.pmod(F.row_number().over(W.orderBy(*by_name)) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    by_level = W.orderBy("full", *by_name)
    before, onward = by_level.rowsBetween(W.unboundedPreceding, -1), by_level.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy()
    ranked = (sizes.withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size").cast("double"))
              .withColumn("full", F.col("cap") / F.col("weight"))
              .withColumn("at", (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                          / F.sum("weight").over(onward))
              .withColumn("level", F.max(F.when(F.col("at") <= F.col("full"), F.col("at"))).over(whole)))
    target = F.when(F.col("level") < F.col("full"), F.col("weight") * F.col("level")).otherwise(F.col("cap"))
    return ranked.select("known", "name", "source_size", target.alias("target"))


# ---- subset sums ----------------------------------------------------------------------------------


def subset_sum(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size to take, so that their sizes add up to ``budget`` or the most below it.

    A bit per reachable sum; each size's count is split into powers of two, and the table before every part is kept to
    walk back from the best sum.
    """
    parts, tables, reachable, mask = [], [], 1, (1 << (budget + 1)) - 1
    for i, (size, count) in enumerate(zip(sizes, counts)):
        left = min(count, budget // size) if size else 0
        step = 1
        while left:
            step = min(step, left)
            parts.append((i, step))
            tables.append(reachable)
            reachable |= (reachable << (size * step)) & mask
            left -= step
            step *= 2
        if reachable >> budget & 1:
            break
    at, chosen = reachable.bit_length() - 1, [0] * len(sizes)
    for (i, step), table in zip(reversed(parts), reversed(tables)):
        if not table >> at & 1:
            at -= sizes[i] * step
            chosen[i] += step
    return chosen


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents of each size whose sizes add up to ``budget``, or as near below as whole documents allow."""
    take = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if budget >= total:
        return np.where(sizes > 0, counts, 0)
    if total:
        # Multiplied as whole numbers: a double would round the shares of very large counts.
        take = np.array([0 if not s else c * budget // total for s, c in zip(sizes.tolist(), counts.tolist())], np.int64)
    left = budget - int((sizes * take).sum())
    bound = max(LEAST_BUDGET, 2 * int(sizes.max(initial=0)))
    # Even shares leave less than one document of every size; the largest go first while the rest is too much.
    for i in np.argsort(-sizes, kind="stable").tolist():
        if left <= bound:
            break
        if take[i] < counts[i] and sizes[i]:
            take[i] += 1
            left -= int(sizes[i])
    if left > 0:
        chosen = subset_sum(sizes.tolist(), (counts - take).tolist(), left)
        take += np.array(chosen, np.int64)
    return take


def _fitted(frame: pd.DataFrame) -> pd.DataFrame:
    """One source's plan from its sizes and counts."""
    frame = frame.sort_values("size", kind="stable")
    sizes, counts = frame["size"].to_numpy(np.int64), frame["n"].to_numpy(np.int64)
    target, whole = float(frame["target"].iloc[0]), int(frame["source_size"].iloc[0])
    times = min(MOST, int(target // whole)) if whole else 0
    budget = int(round(target)) - times * whole if times < MOST else 0
    frame = frame.assign(times=times, once_more=fit(sizes, counts, max(0, budget)))
    return frame[["known", "name", "size", "source_size", "target", "times", "once_more"]]


def mix(docs: DataFrame, text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """Every row of ``docs`` without its text, and size, source_size, target and taken (words the mix takes of it)."""
    spark = docs.sparkSession
    found = ["size", "source_size", "target", "taken"]
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    share = F.xxhash64(*plain, F.lit(seed))
    name = F.col(f"`{source}`").cast("string")
    ranges = max(64, partitions(spark))
    rows = staged(docs.select(
        rest_of(docs, text, *found).alias("rest"), name.isNotNull().alias("known"), F.coalesce(name, F.lit("")).alias("name"),
        size_of(text).alias("size"), share.alias("h"),
    ).withColumn("range", F.floor(F.shiftrightunsigned("h", 32) * ranges / F.lit(1 << 32)).cast("int")), "sized")
    key = ["known", "name", "size"]
    by_range = staged(rows.groupBy(*key, "range").agg(F.count(F.lit(1)).alias("n")), "ranges")
    by_size = by_range.groupBy(*key).agg(F.sum("n").alias("n"))
    of_source = targets(by_size.groupBy("known", "name").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    plan = staged(by_size.join(of_source, ["known", "name"]).groupBy("known", "name").applyInPandas(
        _fitted, "known boolean, name string, size bigint, source_size bigint, target double, times bigint, once_more bigint"), "plan")

    before = F.coalesce(F.sum("n").over(W.partitionBy(*key).orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cells = by_range.withColumn("before", before).join(plan, key).select(
        *key, "range", "source_size", "target", "times",
        F.greatest(F.lit(0), F.least(F.col("n"), F.col("once_more") - F.col("before"))).alias("more"))
    # Documents are ranked within a cell, and cells are ranges of the hash: no size or source is too hot for a task.
    place = F.row_number().over(W.partitionBy(*key, "range").orderBy("h"))
    met = rows.withColumn("place", place).join(cells, [*key, "range"])
    times = F.col("times") + F.when(F.col("place") <= F.col("more"), 1).otherwise(0)
    done = met.select("rest", "size", "source_size", "target", (F.col("size") * times).alias("taken"))
    return unrest(done, [c for c in docs.columns if c != text], found)


def mixed(docs: DataFrame, text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """``docs`` as the mix takes them: a row for every time a document is taken, columns as they are."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"),
                        F.col(f"`{source}`").alias("source"))
    taken = mix(whole, "text", "source", seed)
    return taken.where("taken > 0").select(
        "row", F.explode(F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))).alias("time")).select("row.*")
