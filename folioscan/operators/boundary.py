"""Checks where data enter: stores of packets, sources of readings, inputs of a publication, replies of verifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions.text import squeezed, unspaced, verdict
from folioscan.operators.checks import union


def store_defects(packets: DataFrame, claims: DataFrame) -> DataFrame:
    """"check", subject of a store of packets: no revision, a worker with several packets, a claim id in several places.

    packets: worker, packet_revision; claims: worker, claim_id as first accepted.
    """
    none = packets.where(F.coalesce(F.col("packet_revision") == "", F.lit(True))).select(F.lit("no persisted identity").alias("check"), F.col("worker").cast("string").alias("subject"))
    twice = packets.groupBy("worker").count().where("count > 1").select(F.lit("duplicate worker").alias("check"), F.col("worker").cast("string").alias("subject"))
    shared = claims.groupBy("claim_id").count().where("count > 1").select(F.lit("claim id is not unique").alias("check"), F.col("claim_id").alias("subject"))
    return union(none, twice, shared)


def normalised_conflicts(conflicts: Column) -> Column:
    """Conflicts of a packet (array of struct<source_file, source_files, locator>) with line wraps undone: no white space in paths, single blanks in locators."""
    files = lambda c: F.transform(c["source_files"], lambda x: unspaced(x))
    return F.transform(conflicts, lambda c: F.struct(unspaced(c["source_file"]).alias("source_file"), files(c).alias("source_files"), squeezed(c["locator"]).alias("locator")))


def reading_bounds(bindings: DataFrame, readings: DataFrame, least_primary: int = 1, most: int | None = None) -> DataFrame:
    """reading_id, "check" of readings with too few primary claims, or too many in all.

    bindings: reading_id, role of each claim; readings: reading_id of all, so that those without claims count.
    """
    n = bindings.groupBy("reading_id").agg(F.count_if(F.col("role") == "primary").alias("primary"), F.count("*").alias("n"))
    j = readings.select("reading_id").join(n, "reading_id", "left").fillna(0, ["primary", "n"])
    check = F.when(F.col("primary") < least_primary, "too few primary claims").when(F.col("n") > F.lit(most), "too many claims")
    return j.select("reading_id", check.alias("check")).where("check IS NOT NULL")


def reading_input(assigned: DataFrame, sections: DataFrame) -> DataFrame:
    """reading_id, text: a reading's spans, primary ones before context, in their order, each after a label.

    assigned: reading_id, role, pos, section_id; sections: section_id,
    source_file, first, last (lines, the last one not included), body. A
    reading's text is one row, as it is one request.
    """
    j = assigned.join(sections, "section_id")
    label = F.concat(F.lit("\n["), F.upper("role"), F.lit(" SOURCE "), "source_file", F.lit(" L"), F.col("first").cast("string"), F.lit("-"), (F.col("last") - 1).cast("string"), F.lit("]\n"))
    parts = F.sort_array(F.collect_list(F.struct(F.when(F.col("role") == "primary", 0).otherwise(1).alias("k"), "pos", F.concat(label, F.coalesce("body", F.lit(""))).alias("part"))))
    return j.groupBy("reading_id").agg(F.array_join(F.transform(parts, lambda x: x["part"]), "").alias("text"))


def reading_source_defects(sources: DataFrame, works: DataFrame) -> DataFrame:
    """source_file, "check" of sources that a reading can't take: no Markdown, an unknown work, no source id, or one that others have too.

    sources: source_file, adapter, work_id, source_id; works: work_id.
    """
    known = works.select("work_id").distinct().withColumn("_known", F.lit(True))
    many = sources.where("source_id <> ''").groupBy("source_id").agg((F.count("*") > 1).alias("_many"))
    j = sources.join(known, "work_id", "left").join(many, "source_id", "left")
    blank = F.coalesce(F.col("source_id") == "", F.lit(True))
    checks = [(~F.coalesce(F.col("adapter") == "markdown", F.lit(False)), "not markdown"), (F.col("_known").isNull(), "unknown work"), (blank, "no source id"), (F.coalesce(F.col("_many"), F.lit(False)), "ambiguous source id")]
    return j.select("source_file", F.explode(F.array_compact(F.array(*[F.when(b, F.lit(k)) for b, k in checks]))).alias("check"))


def identity_counts(sources: DataFrame) -> DataFrame:
    """n_sources, n_ids, n_translators, ambiguous: one row; ids are ambiguous if there are fewer than sources."""
    n = sources.agg(F.count("*").alias("n_sources"), F.count_distinct("source_id").alias("n_ids"), F.count_distinct("translator").alias("n_translators"))
    return n.withColumn("ambiguous", F.col("n_ids") < F.col("n_sources"))


def publication_drift(packets: DataFrame, accepted: DataFrame, bundles: DataFrame) -> DataFrame:
    """subject, "check" of what a publication may not take.

    packets and accepted: worker, packet_revision, packet_state_revision,
    source_revision as stored and as accepted again; all three must be there
    and unchanged. bundles: name, key, stated_key, stated_name of published
    bundles, which must be what they are kept as.
    """
    names = ("packet_revision", "packet_state_revision", "source_revision")
    again = accepted.select("worker", *[F.col(c).alias(f"_{c}") for c in names])
    bare = [F.coalesce(F.col(c) == "", F.lit(True)) for c in names]
    missing = bare[0] | bare[1] | bare[2]
    drift = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(f"{c} drift")) for c in names]))
    found = packets.join(again, "worker", "left").select(F.col("worker").cast("string").alias("subject"), F.explode(F.when(missing, F.array(F.lit("no accepted metadata"))).otherwise(drift)).alias("check"))
    checks = [F.when(~F.col("key").eqNullSafe(F.col("stated_key")), "bundle identity drift"), F.when(~F.col("name").eqNullSafe(F.col("stated_name")), "source identity drift")]
    return found.unionByName(bundles.select(F.col("name").alias("subject"), F.explode(F.array_compact(F.array(*checks))).alias("check")))


def worker_outputs(shape: DataFrame, attestations: DataFrame, models: DataFrame) -> DataFrame:
    """worker, n_defects, valid: packets with the defects of their shape, of their sources' attestation and of a model restriction together.

    Each has a worker and a check; only workers with a defect have a row.
    """
    every = union(*(x.select("worker", "check") for x in (shape, attestations, models)))
    return every.groupBy("worker").agg(F.count("*").alias("n_defects"), F.lit(False).alias("valid"))


def advisory_verdicts(attempts: DataFrame, tries: int = 2) -> DataFrame:
    """step, attempt, verdict, detail: the first usable verdict among the first `tries` replies to a verifier's step.

    attempts: step, attempt (from 1), reply. Without a usable one the attempt
    is null, and so is the verdict.
    """
    said = attempts.withColumn("v", verdict(F.col("reply")))
    first = said.where((F.col("attempt") <= tries) & F.col("v.verdict").isNotNull()).groupBy("step").agg(F.min_by(F.struct("attempt", "v.verdict", "v.detail"), "attempt").alias("first"))
    none = F.struct(F.lit(None).cast("long").alias("attempt"), F.lit(None).cast("string").alias("verdict"), F.lit("no usable verdict").alias("detail"))
    return said.select("step").distinct().join(first, "step", "left").select("step", F.coalesce(F.struct(F.col("first.attempt").cast("long").alias("attempt"), "first.verdict", "first.detail"), none).alias("of"), F.col("first").isNull().alias("no")).select("step", F.when(F.col("no"), none).otherwise(F.col("of")).alias("of")).select("step", "of.*")


def field_roots(projects: DataFrame, registry: DataFrame) -> DataFrame:
    """project, field, root, description of each project by its field; a field that isn't registered gives nulls."""
    return projects.select("project", "field").join(registry.select("field", "root", "description"), "field", "left").select("project", "field", "root", "description")
