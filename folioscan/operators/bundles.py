"""Bundles of sources: which records a root needs, over any number of steps, and which of its references lead nowhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.sources.scratch import written


def closure(roots: DataFrame, references: DataFrame, records: DataFrame, most: int = 1000) -> DataFrame:
    """reference, outcome ("record" or "limitation"), node, step for every reference that is reached from a root.

    roots: node. references: node, reference. records: reference, node (the
    smallest node if a reference has several). step: the least number of
    references that lead there. Every reference is followed once, so circles
    end; each round joins only what the one before found new, and is written.
    Nulls lead nowhere and aren't followed. More than `most` rounds are an error.
    """
    named = written(records.where("reference IS NOT NULL AND node IS NOT NULL").groupBy("reference").agg(F.min("node").alias("to")))
    edges = written(references.where("node IS NOT NULL AND reference IS NOT NULL").select("node", "reference").distinct().join(named, "reference", "left"))
    front = written(roots.where("node IS NOT NULL").select("node").distinct())
    seen = front
    found = None
    for step in range(1, most + 1):
        new = edges.join(front, "node", "left_semi").select("reference", "to").distinct()
        if found is not None:
            new = new.join(found.select("reference"), "reference", "left_anti")
        new = written(new.withColumn("step", F.lit(step)))
        if new.isEmpty():
            break
        found = new if found is None else found.unionByName(new)
        front = written(new.where("to IS NOT NULL").select(F.col("to").alias("node")).distinct().join(seen, "node", "left_anti"))
        seen = seen.unionByName(front)
    else:
        raise ValueError(f"references go deeper than {most} steps")
    found = new if found is None else found
    return found.select("reference", F.when(F.col("to").isNull(), "limitation").otherwise("record").alias("outcome"), F.col("to").alias("node"), "step")


def bundle_defects(found: DataFrame, required: DataFrame, recorded: DataFrame) -> DataFrame:
    """reference, "check": required references without a record, and records that differ from what was recorded.

    found: rows of closure with digest (null for limitations). required:
    reference. recorded: reference, digest as the bundle states them.
    """
    bare = found.join(required.select("reference").distinct(), "reference", "left_semi").where("outcome = 'limitation'").select("reference", F.lit("required reference without a record").alias("check"))
    r = recorded.select("reference", F.col("digest").alias("stated"), F.lit(True).alias("known"))
    both = found.where("outcome = 'record'").select("reference", "digest", F.lit(True).alias("there")).join(r, "reference", "full_outer")
    check = F.when(F.col("known").isNull(), "record not in the bundle").when(F.col("there").isNull(), "bundle has more than is reached").when(~F.col("digest").eqNullSafe(F.col("stated")), "digest differs")
    return bare.unionByName(both.select("reference", check.alias("check")).where("`check` IS NOT NULL"))
