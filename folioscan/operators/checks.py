"""Violations as rows, and the one row that decides."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violation(df: DataFrame, check: str, subject: Column, detail: Column, when: Column) -> DataFrame:
    """check, subject_id, detail of the rows that meet a condition; null conditions don't."""
    return df.where(F.coalesce(when, F.lit(False))).select(F.lit(check).alias("check"), subject.cast("string").alias("subject_id"), detail.cast("string").alias("detail"))


def union(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def defects(df: DataFrame, subject: Column, rules: dict[str, Column]) -> DataFrame:
    """One row for each rule that a row breaks, in one pass over df."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]))
    return df.select(F.explode(found).alias("check"), subject.cast("string").alias("subject_id"))


def suppressed(new: DataFrame, reported: DataFrame) -> DataFrame:
    """Violations of subjects that aren't reported already."""
    return new.join(reported.select("subject_id").distinct(), "subject_id", "left_anti").select(*new.columns)


def decision(violations: DataFrame, **counted: DataFrame) -> DataFrame:
    """One row: the rows of each named table, the violations, and whether there are none; also for empty tables."""
    parts = [violations.agg(F.count("*").alias("violations"))]
    parts += [df.agg(F.count("*").alias(name)) for name, df in counted.items()]
    one = reduce(lambda a, b: a.crossJoin(b), parts)  # one row each
    return one.select(*counted, "violations", (F.col("violations") == 0).alias("valid"))


def first_error(violations: DataFrame, order: list[str]) -> DataFrame:
    """The check that a run that stops at the first error would report, by the order of the checks and the subject."""
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("check"))
    return violations.orderBy(rank, "subject_id").limit(1)


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their counts; null is a key like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of child whose key isn't in parent, null keys included (an anti join, never NOT IN)."""
    return child.join(parent.select(F.col(parent_key).alias("_fs_key")).distinct(), F.col(key) == F.col("_fs_key"), "left_anti")


def brief(df: DataFrame, limit: int = 10_000, limit_bytes: int = 4 << 20) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows of `limit_bytes` as JSON, counted no further than that; df itself beyond."""
    n, held = df.limit(limit + 1).agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))), F.lit(0))).first()
    return F.broadcast(df) if n <= limit and held <= limit_bytes else df


def set_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, side ("left" or "right") of the keys that only one of two tables has."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return union(left.join(right, key, "left_anti").withColumn("side", F.lit("left")), right.join(left, key, "left_anti").withColumn("side", F.lit("right")))


def multiset_differences(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Keys whose numbers of rows differ between two tables, with both numbers."""
    rows = a.select(*keys, F.lit(1).alias("x"), F.lit(0).alias("y")).unionByName(b.select(*keys, F.lit(0).alias("x"), F.lit(1).alias("y")))
    return rows.groupBy(*keys).agg(F.sum("x").alias("n_left"), F.sum("y").alias("n_right")).where("n_left <> n_right")


def tree_changes(before: DataFrame, after: DataFrame, key: str, digest: str) -> DataFrame:
    """key, change ("added", "removed" or "changed") between two listings with digests."""
    b, a = before.select(key, F.col(digest).alias("_fs_before")), after.select(key, F.col(digest).alias("_fs_after"))
    both = b.withColumn("_fs_b", F.lit(True)).join(a.withColumn("_fs_a", F.lit(True)), key, "full_outer")
    change = F.when(F.col("_fs_b").isNull(), "added").when(F.col("_fs_a").isNull(), "removed").when(~F.col("_fs_before").eqNullSafe(F.col("_fs_after")), "changed")
    return both.select(key, change.alias("change")).where("change IS NOT NULL")
