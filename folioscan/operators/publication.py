"""Checks over recorded compilation, inspection and publication results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions.text import unsafe_path
from folioscan.operators.checks import brief, multiset_differences, tree_changes, union

#: Suffixes of images that may be published.
IMAGES = (".png", ".jpg", ".jpeg", ".gif", ".webp")


def visual_matches(specs: DataFrame, assets: DataFrame) -> DataFrame:
    """path, check of visual specs without exactly one asset of their path and digest, or with an unsafe path."""
    found = assets.groupBy("path").agg(F.count("*").alias("_fs_n"), F.min("sha256").alias("_fs_sha"))
    j = specs.join(found, "path", "left")
    check = F.when(unsafe_path(F.col("path")), "unsafe path").when(F.col("_fs_n").isNull(), "no asset").when(F.col("_fs_n") > 1, "several assets").when(~F.col("_fs_sha").eqNullSafe(F.col("sha256")), "digest differs")
    return j.select("path", check.alias("check")).where("check IS NOT NULL")


def unit_outcomes(units: DataFrame, outcomes: DataFrame) -> DataFrame:
    """pos, check of units whose outcome at the same position is missing, extra or of another unit or input."""
    o = outcomes.select("pos", F.col("unit_id").alias("_fs_id"), F.col("input_sha256").alias("_fs_in"), F.lit(True).alias("_fs_o"))
    j = units.select("pos", "unit_id", "input_sha256", F.lit(True).alias("_fs_u")).join(o, "pos", "full_outer")
    check = F.when(F.col("_fs_o").isNull(), "no outcome").when(F.col("_fs_u").isNull(), "extra outcome").when(~F.col("unit_id").eqNullSafe(F.col("_fs_id")), "other unit").when(~F.col("input_sha256").eqNullSafe(F.col("_fs_in")), "other input")
    return j.select("pos", check.alias("check")).where("check IS NOT NULL")


def completion(planned: DataFrame, applied: DataFrame, pages: DataFrame, summary: str) -> DataFrame:
    """check, path of a completed compilation: planned actions that weren't applied as often, pages without a link back to the summary, no summary."""
    actions = multiset_differences(planned, applied, "action", "path").select(F.lit("planned and applied differ").alias("check"), "path")
    written = planned.select("path").distinct().join(pages, "path", "left").where(F.col("path") != summary)
    back = written.where(~F.coalesce(F.col("text").contains(summary.removesuffix(".md")), F.lit(False))).select(F.lit("no backlink").alias("check"), "path")
    none = pages.agg(F.count_if(F.col("path") == summary).alias("n")).where("n = 0").select(F.lit("no summary").alias("check"), F.lit(summary).alias("path"))
    return union(actions, back, none)


def receipt_violations(receipt: DataFrame, sources: DataFrame, listed: DataFrame, tree: DataFrame, operations: list[str]) -> DataFrame:
    """check, detail of a compile receipt (one row: state, operation, target): its state, operation, sources and output tree."""
    r = receipt.select(F.explode(F.array_compact(F.array(
        F.when(~F.coalesce(F.col("state") == "COMPLETE", F.lit(False)), F.struct(F.lit("not complete").alias("check"), F.col("state").alias("detail"))),
        F.when(~F.coalesce(F.col("operation").isin(operations), F.lit(False)), F.struct(F.lit("illegal operation").alias("check"), F.col("operation").alias("detail"))),
        F.when(F.coalesce(F.trim("target") == "", F.lit(True)), F.struct(F.lit("no target").alias("check"), F.col("target").alias("detail"))),
    ))).alias("v")).select("v.check", "v.detail")
    digests = multiset_differences(sources, listed, "sha256").select(F.lit("sources differ").alias("check"), F.col("sha256").alias("detail"))
    outputs = tree_changes(tree.where("side = 'recorded'"), tree.where("side = 'actual'"), "path", "sha256").select(F.concat(F.lit("output "), F.col("change")).alias("check"), F.col("path").alias("detail"))
    return union(r, digests, outputs)


def context_violations(inspections: DataFrame, assets: DataFrame, budget: int) -> DataFrame:
    """asset, check of a derived context: records of several or other assets, wrong digests, required assets not inspected, too many tokens in all."""
    j = assets.join(inspections.withColumn("_fs_seen", F.lit(True)), "asset", "left")
    same = F.col("sha256").eqNullSafe(F.col("input_sha256")) & F.col("sha256").eqNullSafe(F.col("inspected_sha256"))
    check = F.when(F.col("required") & F.col("_fs_seen").isNull(), "required but not inspected").when(F.col("_fs_seen") & ~same, "digest differs")
    foreign = inspections.join(assets.select("asset"), "asset", "left_anti").select("asset", F.lit("unknown asset").alias("check"))
    twice = inspections.groupBy("asset").agg(F.count("*").alias("n")).where("n > 1").select("asset", F.lit("several records").alias("check"))
    over = inspections.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).where(F.col("n") > budget).select(F.lit(None).cast("string").alias("asset"), F.lit("token budget").alias("check"))
    return union(j.select("asset", check.alias("check")).where("check IS NOT NULL").distinct(), foreign, twice, over)


def inspected(calls: DataFrame, listed: DataFrame) -> DataFrame:
    """bundle_key, state: complete if all listed assets were called for with a result and a note was given."""
    done = calls.where("result IS NOT NULL").select("bundle_key", "asset").distinct().withColumn("_fs_done", F.lit(True))
    noted = calls.groupBy("bundle_key").agg(F.bool_or(F.coalesce(F.trim("note") != "", F.lit(False))).alias("_fs_note"))
    j = listed.join(done, ["bundle_key", "asset"], "left").groupBy("bundle_key").agg(F.bool_and(F.coalesce("_fs_done", F.lit(False))).alias("_fs_all"))
    state = F.when(F.col("_fs_all") & F.coalesce("_fs_note", F.lit(False)), "complete").otherwise("incomplete")
    return j.join(noted, "bundle_key", "left").select("bundle_key", state.alias("state"))


def bad_images(references: DataFrame, path: str) -> DataFrame:
    """path, check of image references that aren't local relative paths with an allowed suffix."""
    p = F.col(path)
    suffix = F.lower(F.regexp_extract(p, r"(\.[^./]+)\z", 1))
    check = F.when(p.rlike(r"\A(?:[A-Za-z][A-Za-z0-9+.-]*:|//)"), "not local").when(unsafe_path(p), "unsafe path").when(~suffix.isin(*IMAGES), "suffix not allowed")
    return references.select(path, check.alias("check")).where("check IS NOT NULL")


def snapshot_gaps(names: DataFrame, name: str, pattern: str, books: DataFrame, variants: DataFrame) -> DataFrame:
    """check, detail: files that don't match the pattern (book, variant), and books without a variant's file.

    books and variants are a project's short lists.
    """
    book, variant = F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)
    parsed = names.select(name, book.alias("_fs_book"), variant.alias("variant"))
    strange = parsed.where("_fs_book = ''").select(F.lit("unexpected file").alias("check"), F.col(name).alias("detail"))
    held = parsed.where("_fs_book <> ''").select(F.col("_fs_book").cast("int").alias("book"), "variant").distinct()
    lack = books.crossJoin(brief(variants)).join(held, ["book", "variant"], "left_anti")
    return strange.unionByName(lack.select(F.lit("missing witness file").alias("check"), F.concat_ws("/", F.col("book").cast("string"), "variant").alias("detail")))


def output_differences(reviewed: DataFrame, committed: DataFrame, tracked: DataFrame) -> DataFrame:
    """path, check of outputs that changed after review or aren't tracked."""
    changed = tree_changes(reviewed, committed, "path", "sha256").select("path", F.concat(F.lit("after review: "), F.col("change")).alias("check"))
    return changed.unionByName(reviewed.select("path").join(tracked.select("path"), "path", "left_anti").select("path", F.lit("not tracked").alias("check")))


def citation_rows(sections: DataFrame) -> DataFrame:
    """section_id, row: one JSON row for each section with its target and its heading, the first line."""
    heading = F.trim(F.split_part("body", F.lit("\n"), F.lit(1)))
    return sections.select("section_id", F.to_json(F.struct("section_id", "target", heading.alias("heading"))).alias("row"))


def citation_target(key: Column, path: Column, first: Column, last: Column) -> Column:
    """Target of a section's citation: the original's path, percent-encoded, with its inclusive lines."""
    quoted = F.replace(F.replace(F.url_encode(path), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
    return F.concat(F.lit("assets/"), key, F.lit("/original/"), quoted, F.lit("#L"), first.cast("string"), F.lit("-L"), (last - 1).cast("string"))
