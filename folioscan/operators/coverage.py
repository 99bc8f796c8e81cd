"""Coverage of plans by units and pages, trees before and after, publication closure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.operators.checks import brief, multiset_differences, orphans


def uncovered(covered: DataFrame, primary: DataFrame, section: str) -> DataFrame:
    """Sections that compiled units cover more or less often than the plan has them."""
    return multiset_differences(covered, primary, section)


def required_outputs(required: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """path, check of required outputs that are gone or whose digest differs from the attested one."""
    j = required.join(before.select("path", F.col("sha256").alias("_fs_before")), "path", "left").join(after.select("path", F.col("sha256").alias("_fs_after")), "path", "left")
    check = F.when(F.col("_fs_after").isNull(), "missing").when(~F.col("_fs_before").eqNullSafe(F.col("_fs_after")), "digest differs")
    return j.select("path", check.alias("check")).where("check IS NOT NULL")


def overlaid_notes(base: DataFrame, bundle: DataFrame, unit: DataFrame) -> DataFrame:
    """source_file, note: unit notes before bundle notes before base notes."""
    names = base.select("source_file").union(bundle.select("source_file")).union(unit.select("source_file")).distinct()
    j = names
    for k, part in enumerate((unit, bundle, base)):
        j = j.join(part.select("source_file", F.col("note").alias(f"_fs_{k}")), "source_file", "left")
    return j.select("source_file", F.coalesce("_fs_0", "_fs_1", "_fs_2").alias("note"))


def closure(declared: DataFrame, referenced: DataFrame, key: str) -> DataFrame:
    """key, check of assets that are declared but not used, or used but not declared."""
    idle = orphans(declared, key, referenced, key).select(key, F.lit("declared only").alias("check"))
    return idle.unionByName(orphans(referenced, key, declared, key).select(key, F.lit("referenced only").alias("check")))


def source_maps(books: DataFrame, variants: DataFrame, file_template: str, note_template: str) -> DataFrame:
    """source_file, note of every book and variant (both small lists of a project): {book} and {variant} are filled in."""
    each = books.crossJoin(brief(variants))

    def fill(template: str):
        return F.replace(F.replace(F.lit(template), F.lit("{book}"), F.col("book").cast("string")), F.lit("{variant}"), F.col("variant"))

    return each.select("book", "variant", fill(file_template).alias("source_file"), fill(note_template).alias("note"))


def planning_report(units: DataFrame, readings: DataFrame) -> DataFrame:
    """One row: units, tokens, bytes, unresolved units, and the least number of requests."""
    n = readings.agg(F.count("*").alias("_fs_readings"))
    total = units.agg(F.count("*").alias("units"), F.sum("tokens").alias("tokens"), F.sum("bytes").alias("bytes"), F.count_if(F.col("unresolved")).alias("unresolved"))
    return total.crossJoin(n).select("units", "tokens", "bytes", "unresolved", (F.col("_fs_readings") + 3 * F.col("units")).alias("least_requests"))  # one row each


def unresolved(units: DataFrame) -> DataFrame:
    """unit_id of the units that a plan leaves unresolved."""
    return units.where("unresolved").select("unit_id")


def reuse(specs: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reused, pending) worker specs: a stored packet without defects and with equal provenance is used again."""
    fit = stored.where("n_defects = 0").select("worker", F.col("provenance").alias("_fs_p"))
    j = specs.join(fit, "worker", "left").withColumn("_fs_ok", F.coalesce(F.col("_fs_p").eqNullSafe(F.col("provenance")) & F.col("_fs_p").isNotNull(), F.lit(False)))
    return j.where("_fs_ok").select(*specs.columns), j.where("NOT _fs_ok").select(*specs.columns)
