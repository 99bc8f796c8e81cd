"""A reading plan and what depends on it: its structure, claims projected through it, sources they are bound to, targets of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from folioscan.operators.checks import union
from folioscan.operators.reading import context_defects, coverage_gaps, overlaps, ownership
from folioscan.sources.scratch import written

#: What a section may be for, and the form of a reading's id, which is its worker's too.
DISPOSITIONS = ("primary", "context", "excluded")
READING_ID = r"\A[A-Za-z0-9][A-Za-z0-9_-]{0,127}\z"


def _rows(df: DataFrame, level: str, subject: Column, check: Column) -> DataFrame:
    return df.select(F.lit(level).alias("level"), subject.cast("string").alias("subject"), check.alias("check"))


def _each(df: DataFrame, level: str, subject: Column, rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a row of df breaks; a rule that is null is broken."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules.items()]))
    return _rows(df.withColumn("_fs_check", F.explode(found)), level, subject, F.col("_fs_check"))


def section_defects(sections: DataFrame, cuts: DataFrame, ends: DataFrame) -> DataFrame:
    """level, subject, "check" of sections, and of files that they don't cover line by line.

    sections: section_id, source_file, first, last (1-based, end-exclusive),
    disposition, reason; cuts: source_file, cut (lines before which a section
    may begin, the end included, 0-based); ends: source_file, stop (its end line).
    Nulls break the rule that they stand under.
    """
    rules = {
        "no range": ~((F.col("first") >= 1) & (F.col("first") < F.col("last"))),
        "unknown disposition": ~F.col("disposition").isin(*DISPOSITIONS),
        "no reason": (F.col("disposition") != "primary") & (F.trim(F.coalesce("reason", F.lit(""))) == ""),
    }
    own = _each(sections, "section", F.col("section_id"), rules)
    edges = sections.select("section_id", "source_file", F.explode(F.array(F.col("first") - 1, F.col("last") - 1)).alias("cut"))
    inside = edges.join(cuts.select("source_file", "cut").distinct(), ["source_file", "cut"], "left_anti").select("section_id").distinct()
    gaps = coverage_gaps(sections, "source_file", "first", "last", ends, "stop").select("source_file", "check").distinct()
    bare = ends.join(sections, "source_file", "left_anti")
    return union(
        own,
        _rows(inside, "section", F.col("section_id"), F.lit("edge inside a block")),
        _rows(gaps, "file", F.col("source_file"), F.col("check")),
        _rows(bare, "file", F.col("source_file"), F.lit("no sections")),
    )


def assignment_defects(readings: DataFrame, assigned: DataFrame, sections: DataFrame, sources: DataFrame) -> DataFrame:
    """level, subject, "check" of readings and of what they are given.

    readings: reading_id, work_id; assigned: reading_id, role (primary or
    context), section_id; sections as in section_defects; sources: source_file,
    work_id. Primary sections must be of the reading's work and, over all
    readings, be held exactly once; context may be shared.
    """
    # most checks read the same rows, which are joined once
    sections = written(sections.select("section_id", "source_file", "first", "last", "disposition"))
    held = written(assigned.join(sections, "section_id", "left"))
    several = readings.groupBy("reading_id").agg(F.count("*").alias("n"))
    names = _each(several, "reading", F.col("reading_id"), {"unsafe id": ~F.col("reading_id").rlike(READING_ID), "duplicate id": F.col("n") > 1})
    primary = assigned.where("role = 'primary'")
    empty = readings.select("reading_id").distinct().join(primary, "reading_id", "left_anti")
    lost = held.where("source_file IS NULL").select("reading_id").distinct()
    works = sources.select("source_file", F.col("work_id").alias("_fs_work")).distinct()
    of = held.where("role = 'primary' AND source_file IS NOT NULL").join(works, "source_file", "left").join(readings.distinct(), "reading_id")
    across = of.where(~F.coalesce(F.col("_fs_work") == F.col("work_id"), F.lit(False))).select("reading_id").distinct()
    twice = overlaps(held.where("source_file IS NOT NULL"), ["reading_id", "source_file"], "first", "last").select("reading_id").distinct()
    owned = ownership(primary.select("section_id"), sections.where("disposition = 'primary'").select("section_id"), "section_id")
    context = context_defects(sections.where("disposition = 'context'"), assigned.where("role = 'context'"), sections.where("disposition = 'excluded'"), "section_id")
    parts = [names]
    for df, check in ((empty, "no primary section"), (lost, "unknown section"), (across, "primary section of another work"), (twice, "sections overlap")):
        parts.append(_rows(df, "reading", F.col("reading_id"), F.lit(check)))
    parts.append(_rows(owned, "section", F.col("section_id"), F.lit("not owned exactly once")))
    return union(*parts, _rows(context, "section", F.col("section_id"), F.col("check")))


def projected(claims: DataFrame, assigned: DataFrame) -> DataFrame:
    """claim_id, "check", independence_group, byte_start, byte_end: claims seen through the assignments they name.

    claims: claim_id, reading_id, role, section_id, work_id (the binding they
    carry), source_id, excerpt; assigned: reading_id, role, section_id, work_id,
    source_id, body, byte_start (of the body in its file). The group is the
    work of primary evidence and null for context, which supports nothing. The
    check is null for a sound claim, else the first that fails: another
    assignment (the binding isn't the plan's), another source, no excerpt (null
    or empty), quote missing, quote ambiguous. Only sound claims get the rest.
    """
    key = ["reading_id", "role", "section_id", "work_id"]
    plan = assigned.select(*key, F.col("source_id").alias("_fs_source"), F.coalesce("body", F.lit("")).alias("_fs_body"), F.col("byte_start").alias("_fs_at")).dropDuplicates(key)
    j = claims.join(plan, key, "left")
    at = F.call_function("locate", F.col("excerpt"), F.col("_fs_body"))
    again = F.call_function("locate", F.col("excerpt"), F.col("_fs_body"), at + 1)
    check = (
        F.when(F.col("_fs_body").isNull(), "another assignment")
        .when(F.col("source_id").isNotNull() & ~F.col("source_id").eqNullSafe(F.col("_fs_source")), "another source")
        .when(F.coalesce(F.col("excerpt") == "", F.lit(True)), "no excerpt")
        .when(at == 0, "quote missing")
        .when(again > 0, "quote ambiguous")
    )
    j = j.withColumn("check", check)
    start = F.col("_fs_at") + F.octet_length(F.substring(F.col("_fs_body"), F.lit(1), at - 1))
    good = F.col("check").isNull()
    group = F.when(good & (F.col("role") == "primary"), F.col("work_id"))
    return j.select("claim_id", "check", group.alias("independence_group"), F.when(good, start).cast("long").alias("byte_start"), F.when(good, start + F.octet_length("excerpt")).cast("long").alias("byte_end"))


def projection_drift(claims: DataFrame, assigned: DataFrame) -> DataFrame:
    """claim_id, "check" of stored claims that the plan projects otherwise.

    claims as in projected, with the stored independence_group, byte_start and
    byte_end; beside projected's checks: another group, another place.
    """
    stored = claims.select("claim_id", *[F.col(c).alias(f"_fs_{c}") for c in ("independence_group", "byte_start", "byte_end")])
    j = projected(claims, assigned).join(stored, "claim_id")
    same = {c: F.col(c).eqNullSafe(F.col(f"_fs_{c}")) for c in ("independence_group", "byte_start", "byte_end")}
    check = F.coalesce("check", F.when(~same["independence_group"], "another group"), F.when(~(same["byte_start"] & same["byte_end"]), "another place"))
    return j.select("claim_id", check.alias("check")).where("check IS NOT NULL")


def binding_defects(claims: DataFrame, bindings: DataFrame, originals: DataFrame, aliases: DataFrame) -> DataFrame:
    """worker, claim_id, "check" of claims whose source isn't the one that was accepted.

    claims: worker, claim_id, source_file, digest (of that file now),
    source_revision (as the claim states it, or null), reading (its binding as
    canonical JSON, or null); bindings: worker, claim_id, source_file,
    source_revision, reading, as saved; originals: worker, claim_id of the
    first acceptance; aliases: worker, alias, target. A claim without a saved
    binding is new and gets one; equal bytes in another file are another source.
    """
    saved = bindings.select("worker", "claim_id", F.col("source_file").alias("_fs_file"), F.col("source_revision").alias("_fs_revision"), F.col("reading").alias("_fs_reading"), F.lit(True).alias("_fs_saved"))
    j = claims.join(saved, ["worker", "claim_id"], "left")
    moved = ~(F.col("source_file").eqNullSafe(F.col("_fs_file")) & F.col("digest").eqNullSafe(F.col("_fs_revision")) & F.col("reading").eqNullSafe(F.col("_fs_reading")))
    found = F.array_compact(F.array(F.when(F.col("_fs_saved") & moved, F.lit("binding changed")), F.when(~F.coalesce(F.col("source_revision").eqNullSafe(F.col("digest")) | F.col("source_revision").isNull(), F.lit(False)), F.lit("revision mismatch"))))
    live = j.select("worker", "claim_id", F.explode(found).alias("check"))
    unbound = originals.select("worker", "claim_id").distinct().join(bindings, ["worker", "claim_id"], "left_anti").withColumn("check", F.lit("no saved binding"))
    targets = aliases.groupBy("worker", F.col("target").alias("claim_id")).agg(F.count("*").alias("n"))
    ambiguous = targets.where("n > 1").select("worker", "claim_id", F.lit("several aliases").alias("check"))
    unknown = targets.join(originals, ["worker", "claim_id"], "left_anti").select("worker", "claim_id", F.lit("alias of an unknown claim").alias("check"))
    return union(live, unbound, ambiguous, unknown)


def report_defects(failures: DataFrame, claims: DataFrame, bindings: DataFrame, packets: DataFrame) -> DataFrame:
    """level, subject, "check" of a report of failures that may not be acted on.

    failures: worker, claim_id, has_excerpt (whether the field is there at
    all), old_excerpt (null: any), reason, applied (a replay, whose claim may
    be gone); claims: claim_id, excerpt of the claims there are; bindings:
    worker, packet_revision, incompatible, as the report states them; packets:
    worker, packet_revision.
    """
    now = claims.groupBy("claim_id").agg(F.first("excerpt").alias("_fs_now"), F.lit(True).alias("_fs_there"))
    bound = bindings.select("worker", F.lit(True).alias("_fs_bound")).distinct()
    j = failures.join(now, "claim_id", "left").join(bound, "worker", "left").withColumn("_fs_n", F.count("*").over(Window.partitionBy("claim_id")))
    open_ = ~F.coalesce(F.col("applied"), F.lit(False))
    rules = {
        "no identity fields": F.col("worker").isNull() | F.col("reason").isNull() | ~F.coalesce(F.col("has_excerpt"), F.lit(False)),
        "packet not bound": F.col("worker").isNotNull() & F.col("_fs_bound").isNull(),
        "claim repeated": F.col("_fs_n") > 1,
        "claim gone": open_ & F.col("_fs_there").isNull(),
        "excerpt stale": open_ & F.col("_fs_there").isNotNull() & F.col("old_excerpt").isNotNull() & ~F.col("_fs_now").eqNullSafe(F.col("old_excerpt")),
    }
    targets = _each(j, "claim", F.col("claim_id"), rules).distinct()
    known = packets.select("worker", F.col("packet_revision").alias("_fs_revision"), F.lit(True).alias("_fs_known")).dropDuplicates(["worker"])
    b = bindings.join(known, "worker", "left")
    check = (
        F.when(F.col("_fs_known").isNull(), "unknown packet")
        .when(F.coalesce(F.col("incompatible"), F.lit(False)), "incompatible revisions")
        .when(F.col("packet_revision").isNull(), "no revision")
        .when(~F.col("packet_revision").eqNullSafe(F.col("_fs_revision")), "stale revision")
    )
    b = b.withColumn("_fs_check", check).where("_fs_check IS NOT NULL")
    return targets.unionByName(_rows(b, "packet", F.col("worker"), F.col("_fs_check")))


def bibliography_defects(works: DataFrame) -> DataFrame:
    """level, subject, "check" of works whose title and authors are neither given nor said to be unknown.

    works: work_id, fields (map of the record's keys to variants as JSON text;
    the text null stands for an explicit null). A title is a string or null,
    authors are a list of strings that isn't empty, or null; none is blank.
    """
    title, authors = F.try_element_at("fields", F.lit("title")), F.try_element_at("fields", F.lit("authors"))
    known = F.col("fields").isNotNull()
    as_text = F.from_json(F.concat(F.lit('{"v":'), title, F.lit("}")), "v variant")["v"]
    names = F.from_json(F.concat(F.lit('{"v":'), authors, F.lit("}")), "v variant")["v"]
    kind, listed = F.schema_of_variant(as_text), F.schema_of_variant(names)
    text = F.try_variant_get(as_text, "$", "string")
    each = F.try_variant_get(names, "$", "array<string>")
    rules = {
        "no identity": F.coalesce(F.col("work_id").cast("string") == "", F.lit(True)),
        "no record": ~known,
        "title not stated": known & title.isNull(),
        "authors not stated": known & authors.isNull(),
        "title is no text": F.coalesce(title.isNotNull() & (kind != "VOID") & ((kind != "STRING") | (F.trim(text) == "")), F.lit(False)),
        "authors are no list": F.coalesce(authors.isNotNull() & (listed != "VOID") & (~listed.startswith("ARRAY") | (F.size(each) == 0)), F.lit(False)),
        "an author is no text": F.coalesce((listed.startswith("ARRAY") & (listed != "ARRAY<STRING>") & (F.size(each) > 0)) | F.exists(each, lambda x: F.coalesce(F.trim(x) == "", F.lit(True))), F.lit(False)),
    }
    return _each(works, "work", F.col("work_id"), rules)
