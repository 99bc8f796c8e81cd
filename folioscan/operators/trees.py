"""Merkle digests of tables by ranges of hashed keys, and comparison by descent into unequal ranges.

A row's leaf is the SHA-256 of its content, its place the hexadecimal MD5 of
its key. A range is a prefix of places: at the lowest level its digest is that
of its rows' keys and leaves in order, above that of its at most 16 children.
Two versions of a table are compared from the root down; only ranges whose
digests differ are opened, and only their rows are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions.digest import sha256
from folioscan.sources.scratch import written

#: Rows of a lowest range on average at most, and prefixes' greatest length.
RANGE, DEEPEST = 256, 8


def depth_for(rows: int, rows_of_range: int = RANGE) -> int:
    """The least length of prefixes by which ranges have so many rows on average at most."""
    depth = 0
    while depth < DEEPEST and rows > rows_of_range * 16**depth:
        depth += 1
    return depth


def leaves(df: DataFrame, key: str, *content: str) -> DataFrame:
    """key, place, leaf for every row. Null values differ from empty ones; keys are taken as they are written."""
    fields = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in content]
    sized = F.concat(*[F.concat(F.length(f).cast("string"), F.lit(":"), f) for f in fields])
    return df.select(F.col(f"`{key}`").alias("key"), F.md5(F.col(f"`{key}`").cast("string").cast("binary")).alias("place"), sha256(sized).alias("leaf"))


def ranges(table: DataFrame, depth: int) -> DataFrame:
    """level, prefix, digest of every range of a table of leaves, the root (level 0, prefix '') included.

    A lowest range's rows are gathered to be digested in order: some RANGE of
    them, as depth follows the number of rows and MD5 spreads keys evenly.
    Repeated keys stand in one range each time they occur.
    """
    order = F.sort_array(F.collect_list(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(" "), "leaf")))
    level = written(table.where("place IS NOT NULL").groupBy(F.substring("place", 1, depth).alias("prefix")).agg(sha256(F.array_join(order, "\n")).alias("digest")).select(F.lit(depth).alias("level"), "prefix", "digest"))
    out = level
    for k in range(depth - 1, -1, -1):
        children = F.sort_array(F.collect_list(F.concat("prefix", F.lit(" "), "digest")))
        level = level.groupBy(F.substring("prefix", 1, k).alias("prefix")).agg(sha256(F.array_join(children, "\n")).alias("digest")).select(F.lit(k).alias("level"), "prefix", "digest")
        out = out.unionByName(level)
    return out


def unequal(before: DataFrame, after: DataFrame, depth: int) -> DataFrame:
    """prefix of the lowest ranges that differ, found level by level: a level's ranges are compared below unequal ones only."""
    open_ = None
    for k in range(depth + 1):
        sides = [x.where(F.col("level") == k).select("prefix", F.col("digest").alias(name)) for x, name in ((before, "a"), (after, "b"))]
        if open_ is not None:
            sides = [x.join(open_.select(F.col("prefix").alias("up")), F.substring("prefix", 1, k - 1) == F.col("up"), "left_semi") for x in sides]
        open_ = sides[0].join(sides[1], "prefix", "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("prefix")
    return open_


def changes(before: DataFrame, after: DataFrame, rows: int | None = None) -> DataFrame:
    """key, change ("added", "removed" or "changed") between two tables of leaves, rows without a change left out.

    rows: their number, by which the lowest ranges are sized; counted if it
    isn't given. Null keys can't be compared and are left out; of a key that
    occurs several times all leaves count, as one list.
    """
    a, b = (written(x.where("key IS NOT NULL")) for x in (before, after))
    depth = depth_for(max(a.count(), b.count()) if rows is None else rows)
    apart = written(unequal(written(ranges(a, depth)), written(ranges(b, depth)), depth))
    within = [x.join(apart, F.substring("place", 1, depth) == F.col("prefix"), "left_semi").groupBy("key").agg(F.sort_array(F.collect_list("leaf")).alias(name)) for x, name in ((a, "a"), (b, "b"))]
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return within[0].join(within[1], "key", "full_outer").select("key", change.alias("change")).where("change IS NOT NULL")


def baseline(df: DataFrame, key: str, *content: str) -> str:
    """The root digest of a table, '' of an empty one: a checkpoint stores it, and a rollback must give it again."""
    table = written(leaves(df, key, *content))
    root = ranges(table, depth_for(table.count())).where("level = 0").first()
    return root["digest"] if root else ""


def attempts(runs: DataFrame, bound: list[str], most: int = 3) -> DataFrame:
    """unit, attempt, "check": attempts that break their unit's binding.

    runs: unit, attempt and the digests of what an attempt was bound to. The
    first attempt binds the unit; a later one with another digest is a drift of
    that field, and attempts count from 1 to `most` without gaps.
    """
    first = runs.where("attempt = 1").groupBy("unit").agg(*[F.min(c).alias(f"_first_{c}") for c in bound], F.count("*").alias("_firsts"))
    joined = runs.join(first, "unit", "left")
    before = runs.select(F.col("unit").alias("u"), (F.col("attempt") + 1).alias("next")).distinct()
    gap = joined.join(before, (F.col("unit") == F.col("u")) & (F.col("attempt") == F.col("next")), "left")
    rules: list[tuple[str, Column]] = [(f"drift: {c}", ~F.col(c).eqNullSafe(F.col(f"_first_{c}")) & F.col("_firsts").isNotNull()) for c in bound]
    rules += [("attempt out of bounds", ~F.col("attempt").between(1, most)), ("no attempt before", (F.col("attempt") > 1) & F.col("u").isNull()), ("attempt repeated", (F.col("attempt") == 1) & (F.col("_firsts") > 1))]
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules]))
    return gap.select("unit", "attempt", F.explode(found).alias("check"))
