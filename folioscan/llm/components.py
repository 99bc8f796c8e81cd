"""Connected components by contraction, as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.common import discard, materialise


def _jump(labels: DataFrame) -> DataFrame:
    """Labels of the labels; a label without one is a root."""
    up = labels.select(F.col("node").alias("root"), F.col("label").alias("next"))
    return labels.withColumnRenamed("label", "root").join(up, "root", "left").select("node", F.coalesce("next", "root").alias("label"))


def components(links: DataFrame) -> DataFrame:
    """node, label for every end of a link; label is the smallest node of the component.

    links: a, b as long; order, repeats, loops and nulls don't matter. Each
    round gives every node its smallest neighbour, follows such labels twice,
    and replaces the links' ends by them, so chains and stars alike shrink by
    a factor a round. Minima are taken before rows are shuffled, and each
    round is written to the shared folder.
    """
    spark = links.sparkSession
    edges = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a IS NOT NULL").distinct(), "links")
    total = None
    while True:
        near = edges.where("a < b")
        if near.isEmpty():
            break
        # a node's smallest neighbour or itself: only the larger end of a link can get a smaller label
        first = materialise(near.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")), "labels")
        labels = materialise(_jump(_jump(first)), "jumped")
        discard(first)
        if total is None:
            total = labels
        else:
            moved = total.withColumnRenamed("label", "old").join(labels.select(F.col("node").alias("old"), F.col("label").alias("new")), "old", "left").select("node", F.coalesce("new", "old").alias("label"))
            old, total = total, materialise(moved.unionByName(labels.join(total.select("node"), "node", "left_anti")), "total")
        at = labels.select(F.col("node").alias("end"), F.col("label").alias("root"))
        half = near.join(at.withColumnRenamed("end", "b"), "b").select("a", F.col("root").alias("b"))
        both = half.join(at.withColumnRenamed("end", "a"), "a", "left").select(F.coalesce("root", "a").alias("a"), "b")
        before, edges = edges, materialise(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
        discard(before)
        if total is not labels:
            discard(labels, old)
    discard(edges)
    if total is None:
        total = spark.createDataFrame([], "node long, label long")
    # roots are their own label; nodes whose only links are loops too
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).where("node IS NOT NULL").distinct()
    out = materialise(ends.join(total, "node", "left").select("node", F.coalesce("label", "node").alias("label")), "components")
    discard(total)
    return out
