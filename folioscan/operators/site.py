"""Navigation of a site: the tree of its paths with counts, and every node's place among its siblings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions.text import natural_key
from folioscan.operators.ranks import ranked
from folioscan.sources.scratch import written


def steps(url: Column) -> Column:
    """Host and path steps of a URL, without query and fragment; empty steps don't count, and there are none without ://."""
    return F.filter(F.split(F.regexp_extract(url, r"(?s)://([^?#]*)", 1), "/"), lambda x: x != "")


def navigation(pages: DataFrame, url_col: str) -> DataFrame:
    """node, parent (null at the top), title, depth, n_pages (at the node and below), n_children, position.

    Paths are counted first, then rolled up from the deepest level, each into
    the one above, so a level's rows are its nodes and not its pages. position
    is the place among the parent's children: digit runs by value, then by
    title. Pages without a host have no node.
    """
    path = pages.select(steps(F.col(f"`{url_col}`")).alias("steps")).where(F.size("steps") > 0)
    leaves = written(path.groupBy("steps").agg(F.count("*").alias("n")).withColumn("depth", F.size("steps")))
    deepest = leaves.agg(F.max("depth").alias("d")).first()["d"] or 0
    none = leaves.limit(0).select("steps", F.col("n").alias("n_pages"), F.lit(0).cast("long").alias("n_children"))
    nodes, above = none, none
    for depth in range(deepest, 0, -1):
        own = leaves.where(F.col("depth") == depth).select("steps", F.col("n").alias("n_pages"), F.lit(0).cast("long").alias("n_children"))
        above = written(own.unionByName(above).groupBy("steps").agg(F.sum("n_pages").alias("n_pages"), F.sum("n_children").alias("n_children")))
        nodes = nodes.unionByName(above)
        above = above.select(F.slice("steps", 1, F.size("steps") - 1).alias("steps"), "n_pages", F.lit(1).cast("long").alias("n_children")).where(F.size("steps") > 0)
    named = nodes.select(F.array_join("steps", "/").alias("node"), F.when(F.size("steps") > 1, F.array_join(F.slice("steps", 1, F.size("steps") - 1), "/")).alias("parent"), F.element_at("steps", -1).alias("title"), F.size("steps").alias("depth"), "n_pages", "n_children")
    return ranked(named, ["parent"], [natural_key(F.col("title")), F.col("title")], "position")
