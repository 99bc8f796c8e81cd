"""Ranks of rows within groups of any size, without gathering a group in a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscan.sources.scratch import written


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """df with each row's number (from 1) within its group by an order; the order should tell a group's rows apart.

    Rows are dealt by ranges of group and order, so one group may fill many
    tasks. A row's number is its place in its task's part of the group and the
    rows of the group in the tasks before, of which only counts are joined:
    two passes over rows that were written once. Without `by` all rows are one
    group. Null groups are a group; nulls come first in the order.
    """
    keys = [F.col(f"`{c}`") for c in by]
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = written(dealt.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    names = [f"_by{k}" for k in range(len(by))]
    counts = placed.groupBy("_part", *[k.alias(n) for k, n in zip(keys, names, strict=True)]).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    # a row for each task that has some of a group: few, however large the group is
    w = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).withColumnRenamed("_part", "_p").select("_p", *names, "_first", "_before")
    on = F.col("_part") == F.col("_p")
    for k, n in zip(keys, names, strict=True):
        on = on & k.eqNullSafe(F.col(n))
    return placed.join(starts, on).withColumn(name, F.col("_at") - F.col("_first") + F.col("_before") + 1).drop("_at", "_part", "_p", "_first", "_before", *names)
