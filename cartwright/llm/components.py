"""Connected components of links between numbered nodes, as a loop of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.base import staged


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links (a, b)``: the smallest node of its component.

    Each round takes the least label among a node's neighbours and then that label's own label, so chains shorten by
    more than half; every round is written, and only the number of changes reaches the driver.
    """
    both = staged(links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "edges")
    labels = staged(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("other"), "label"), "other")
                .groupBy("node").agg(F.min("label").alias("near")))
        lower = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        stepped = staged(lower.join(jump, "label", "left").select(
            "node", "was", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        changed = stepped.where("label < was").limit(1).count()
        labels = stepped.select("node", "label")
        if not changed:
            return labels


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after more links: their components are found among labels, so what is joined already is not walked again."""
    of = lambda end: labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
    met = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
           .select(F.coalesce("a_label", "a").alias("x"), F.coalesce("b_label", "b").alias("y")).where("x <> y")
           .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    above = components(met).select(F.col("node").alias("label"), F.col("label").alias("top"))
    ends = [links.select(F.col(end).alias("node"), F.col(end).alias("label")) for end in ("a", "b")]
    # A label is never above its node, so the least of a node's rows is the label it has.
    nodes = labels.unionByName(ends[0]).unionByName(ends[1]).groupBy("node").agg(F.min("label").alias("label"))
    return staged(nodes.join(above, "label", "left").select("node", F.coalesce("top", "label").alias("label")), "labels")
