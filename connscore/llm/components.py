"""Connected components by iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from connscore.llm import common as C


def thinned(links: DataFrame) -> DataFrame:
    """Links (a, b) with the same components: one for each b, and the pairs of a that share a b.

    Each b stays linked to its smallest a; its other a are linked to that one,
    and equal links fall together.  For links whose number for one b is bounded
    (by the keys of a sketch), as they are gathered.
    """
    pairs = F.transform("every", lambda a: F.when(a == F.col("least"), F.struct(a.alias("a"), F.col("b").alias("b")))
                        .otherwise(F.struct(F.col("least").alias("a"), a.alias("b"))))
    return (links.groupBy("b").agg(F.collect_set("a").alias("every"), F.min("a").alias("least"))
            .select(F.inline(pairs)).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of ``links`` (a, b); label is the smallest node of its component.

    Each step takes the smallest label among a node's neighbours and then the
    label of that label, so a path of n nodes needs about log n steps.  Every
    step is a written table; the loop ends when no label moves.
    """
    both = C.written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = C.written(both.groupBy(F.col("a").alias("node"))
                       .agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        nearer = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        step = C.written(nearer.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("jump", "label")).alias("label")), "labels")
        labels = step.select("node", "label")
        if step.filter("label <> old").isEmpty():
            return labels
