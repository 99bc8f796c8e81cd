"""Wiki pages: link extraction and resolution, natural order, selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from folioscan.functions.text import link_target, markdown_links, natural_key, unsafe_path, wikilinks

#: Folders and files that hold no semantic pages.
EXCLUDED = ("sources", "assets", "reports")
POLICY = "AGENTS.md"


def semantic(pages: DataFrame, path: str) -> DataFrame:
    """Pages outside the excluded folders; policies are none."""
    return pages.where(~F.split_part(F.col(path), F.lit("/"), F.lit(1)).isin(*EXCLUDED) & (F.element_at(F.split(path, "/"), -1) != POLICY))


def dead_wikilinks(pages: DataFrame, path: str, text: str, exact: bool = False) -> DataFrame:
    """path, raw of wikilinks without a page.

    A target is a path below the wiki, .md added if it's missing; a bare name
    may be the name of any page, unless exact. Unsafe targets are dead.
    """
    links = pages.select(path, F.explode(wikilinks(F.col(text))).alias("raw")).withColumn("target", link_target(F.col("raw")))
    links = links.withColumn("file", F.when(~unsafe_path(F.col("target")), F.when(F.col("target").endswith(".md"), F.col("target")).otherwise(F.concat("target", F.lit(".md")))))
    files = pages.select(F.col(path).alias("file")).distinct()
    left = links.join(files, "file", "left_anti")
    if exact:
        return left.select(path, "raw")
    names = pages.select(F.element_at(F.split(path, "/"), -1).alias("file")).distinct()
    # a target with a folder never equals a bare name
    return left.join(names, "file", "left_anti").select(path, "raw")


def resolved(path: Column, target: Column) -> Column:
    """A relative link's path below the wiki, dots resolved; null if it leaves the wiki."""
    folder = F.slice(F.split(path, "/"), 1, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    parts = F.filter(F.concat(folder, F.split(target, "/")), lambda p: (p != "") & (p != "."))
    kind = "struct<out:array<string>,ok:boolean>"

    def step(a: Column, p: Column) -> Column:
        up = p == ".."
        ok = a["ok"] & ~(up & (F.size(a["out"]) == 0))
        out = F.when(up, F.slice(a["out"], 1, F.greatest(F.size(a["out"]) - 1, F.lit(0)))).otherwise(F.concat(a["out"], F.array(p)))
        return F.struct(out.alias("out"), ok.alias("ok")).cast(kind)

    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(True).alias("ok")).cast(kind)
    return F.aggregate(parts, start, step, lambda a: F.when(a["ok"], F.array_join(a["out"], "/")))


def dead_links(pages: DataFrame, files: DataFrame, path: str, text: str) -> DataFrame:
    """path, target, check of local markdown links that leave the wiki or have no file."""
    links = pages.select(path, F.explode(markdown_links(F.col(text))).alias("target"))
    local = links.where(~F.col("target").rlike(r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:|//)")).withColumn("bare", F.regexp_replace("target", r"[?#].*\z", "")).where("bare <> ''")
    # a plus sign is a plus sign in a path; url_decode alone would make it a space
    plain = F.try_url_decode(F.replace(F.col("bare"), F.lit("+"), F.lit("%2B")))
    at = local.withColumn("file", F.when(~F.col("bare").startswith("/"), resolved(F.col(path), F.coalesce(plain, F.col("bare")))))
    outside = at.where("file IS NULL").select(path, "target", F.lit("escapes wiki").alias("check"))
    inside = at.where("file IS NOT NULL").join(files.select(F.col(path).alias("file")).distinct(), "file", "left_anti")
    return outside.unionByName(inside.select(path, "target", F.lit("missing target").alias("check")))


def foreign_citations(links: DataFrame, frozen: DataFrame) -> DataFrame:
    """path, file, fragment, check of citations that don't name a frozen section target (file, fragment)."""
    cited = frozen.select("file").distinct().withColumn("_fs_known", F.lit(True))
    exact = frozen.select("file", F.coalesce("fragment", F.lit("")).alias("_fs_part")).distinct().withColumn("_fs_exact", F.lit(True))
    joined = links.withColumn("_fs_part", F.coalesce("fragment", F.lit(""))).join(cited, "file", "left").join(exact, ["file", "_fs_part"], "left")
    original = F.col("file").contains("/original/") & F.col("file").endswith(".md")
    check = F.when(F.col("_fs_known") & F.col("_fs_exact").isNull(), "not a frozen section").when(F.col("_fs_known").isNull() & original, "not in the reading plan")
    return joined.select("path", "file", "fragment", check.alias("check")).where("check IS NOT NULL")


def sorted_bullets(lines: DataFrame, page: str, at: str, body: str) -> DataFrame:
    """page, at, body: runs of bullets with wikilinks in natural order without regard to case; other lines stay in place."""
    bullet = F.coalesce(F.col(body).rlike(r"\A\s*-\s*\[\["), F.lit(False))
    order = Window.partitionBy(page).orderBy(at)
    # bullets between two other lines share the count of other lines before them
    block = lines.withColumn("_fs_bullet", bullet).withColumn("_fs_block", F.sum(F.when(F.col("_fs_bullet"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.trim(F.regexp_extract(F.col(body), r"\[\[([^\]|]+)", 1))
    key = F.when(F.col("_fs_bullet"), natural_key(F.lower(target))).otherwise("")
    inside = Window.partitionBy(page, "_fs_block", "_fs_bullet")
    first = F.min(at).over(inside)
    rank = F.row_number().over(inside.orderBy(key, at))
    return block.select(page, (first + rank - 1).alias(at), body)


def relative_links(text: Column) -> Column:
    """Wikilinks as relative markdown links, with the alias as title."""
    out = F.regexp_replace(text, r"\[\[([^\]|#]+)(?:#[^\]|]*)?\|([^\]]+)\]\]", r"[$2]($1.md)")
    return F.regexp_replace(out, r"\[\[([^\]|#]+)(?:#[^\]|]*)?\]\]", r"[$1]($1.md)")
