"""Claim and source ledgers: required keys, row rules, references, packets and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from folioscan.functions.text import squeezed, unspaced
from folioscan.operators.checks import defects, duplicates, union

#: Fixed values.
STANCES = ("supports", "qualifies", "contradicts")
PLACEHOLDERS = ("...", "…", "TBD")
SOURCE_KEYS = ("source_id", "url", "title", "retrieved_at", "content_type", "sha256", "snapshot")
CLAIM_KEYS = ("claim_id", "claim", "note", "locator", "excerpt", "independence_group", "verified_at", "source_ids", "stance", "confidence")
PACKET_FIELDS = ("claim", "source_file", "locator", "excerpt")


def blank(x: Column) -> Column:
    return F.coalesce(squeezed(x) == "", F.lit(True))


def missing_keys(raw: DataFrame, column: str, line: str, keys: tuple[str, ...]) -> DataFrame:
    """line, missing (sorted) of JSON rows without all keys; a null value is present, text that isn't an object lacks all."""
    have = F.coalesce(F.json_object_keys(column), F.array().cast("array<string>"))
    lack = F.sort_array(F.array_except(F.array(*map(F.lit, keys)), have))
    return raw.select(line, F.array_join(lack, ",").alias("missing")).where("missing <> ''")


def claim_defects(claims: DataFrame) -> DataFrame:
    """Rows (check, subject_id) of the claim ledger's row rules; optional columns count only where present."""
    c = F.col
    rules = {
        "missing claim_id": blank(c("claim_id")),
        "bad stance": ~F.coalesce(c("stance").isin(*STANCES), F.lit(False)),
        "no source_ids": F.coalesce(F.size("source_ids"), F.lit(0)) < 1,
        "bad confidence": ~F.coalesce(c("confidence").between(0, 1), F.lit(False)),
    }
    for name in ("packet_revision", "packet_state_revision", "accepted_attempt_id"):
        if name in claims.columns:
            rules[f"bad {name}"] = c(name).isNotNull() & blank(c(name))
    return defects(claims, c("claim_id"), rules)


def unknown_sources(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """claim_id, source_id of cited sources that the ledger lacks."""
    cited = claims.select("claim_id", F.explode("source_ids").alias("source_id"))
    return cited.join(sources.select("source_id").distinct(), "source_id", "left_anti").select("claim_id", "source_id")


def foreign_revisions(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """claim_id of claims whose source_revision is the digest of none of the sources they cite."""
    bound = claims.where("source_revision IS NOT NULL")
    cited = bound.select("claim_id", "source_revision", F.explode_outer("source_ids").alias("source_id"))
    joined = cited.join(sources.select("source_id", "sha256"), "source_id", "left")
    agree = F.bool_or(F.coalesce(F.col("sha256") == F.col("source_revision"), F.lit(False)))
    return joined.groupBy("claim_id").agg(agree.alias("ok")).where("NOT ok").select("claim_id")


def ledger_violations(claims: DataFrame, sources: DataFrame) -> DataFrame:
    """All violations of the two ledgers: check, subject_id."""
    return union(
        duplicates(sources, "source_id").select(F.lit("duplicate source_id").alias("check"), F.col("source_id").alias("subject_id")),
        duplicates(claims, "claim_id").select(F.lit("duplicate claim_id").alias("check"), F.col("claim_id").alias("subject_id")),
        claim_defects(claims),
        unknown_sources(claims, sources).select(F.lit("unknown source_id").alias("check"), F.col("claim_id").alias("subject_id")),
        foreign_revisions(claims, sources).select(F.lit("source revision mismatch").alias("check"), F.col("claim_id").alias("subject_id")),
    )


def packet_defects(claims: DataFrame, packets: DataFrame, least: int | None = None, most: int | None = None) -> DataFrame:
    """worker, check, ordinal of unusable packets.

    claims: worker, pos (0-based), the PACKET_FIELDS and stance; packets:
    worker, is_object, has_list. Each kind of defect of a whole packet hides
    those that come after it: no object, no list, no claims, too few, too
    many, then those of its claims.
    """
    n = claims.groupBy("worker").agg(F.count("*").alias("n"))
    sized = packets.join(n, "worker", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    whole = (
        F.when(~F.coalesce("is_object", F.lit(False)), "not an object")
        .when(~F.coalesce("has_list", F.lit(False)), "no claims list")
        .when(F.col("n") == 0, "zero claims")
        .when(F.col("n") < F.lit(least), "too few claims")
        .when(F.col("n") > F.lit(most), "too many claims")
    )
    sized = sized.withColumn("check", whole)
    bad = sized.where("check IS NOT NULL").select("worker", "check", F.lit(None).cast("long").alias("ordinal"))
    c = F.col
    rules = {f"missing {x}": blank(c(x)) for x in PACKET_FIELDS}
    rules["non-concrete stance"] = ~F.coalesce(c("stance").isin(*STANCES), F.lit(False))
    echo = [F.coalesce(c(x).isin(*PLACEHOLDERS), F.lit(True)) for x in PACKET_FIELDS]
    rules["placeholder echo"] = echo[0] & echo[1] & echo[2] & echo[3]
    fine = claims.join(sized.where("check IS NULL").select("worker"), "worker", "left_semi")
    found = F.array_compact(F.array(*[F.when(b, F.lit(k)) for k, b in rules.items()]))
    each = fine.select("worker", F.explode(found).alias("check"), (c("pos") + 1).cast("long").alias("ordinal"))
    return union(bad, each)


def multi_witness_defects(
    claims: DataFrame, packets: DataFrame, claim_types: list[str], variants: dict[str, str | None], template: str, canonical_required: bool, least: int | None = None, most: int | None = None
) -> DataFrame:
    """worker, check, ordinal of unusable packets of a project with several witnesses.

    claims has the columns of packet_defects and claim_type, english_witness
    (struct of translator, source_id, locator, excerpt; null if the packet has
    no object there) and consulted_is_text. variants: the witnesses'
    translators by variant, a project's short list; template: a snapshot's
    name with {n} for the book and {w} for the variant. The rules of
    packet_defects come first; only packets that pass them are looked at
    further. A claim may not cite a witness's snapshot as its source.
    """
    base = packet_defects(claims, packets, least, most)
    c = F.col
    book = F.nullif(F.regexp_extract("source_file", r"book-(\d+)", 1), F.lit("")).cast("decimal(38,0)").cast("string")
    names = [F.replace(F.replace(F.lit(template), F.lit("{n}"), book), F.lit("{w}"), F.lit(w)) for w in variants]
    rules = {}
    if claim_types:
        rules["claim_type not allowed"] = ~F.coalesce(c("claim_type").isin(*claim_types), F.lit(False))
    if variants:
        rules["source_file is a translation witness"] = F.coalesce(c("source_file").isin(*names), F.lit(False))
    if canonical_required:
        w = c("english_witness")
        rules["english_witness is not an object"] = w.isNull()
        for name in ("translator", "source_id", "locator", "excerpt"):
            rules[f"english_witness missing {name}"] = w.isNotNull() & blank(w[name])
        known = [t for t in variants.values() if t is not None]
        if known:
            rules["english_witness translator unknown"] = (w["translator"] != "") & ~w["translator"].isin(*known)
        rules["witnesses_consulted must be a list"] = w.isNotNull() & c("consulted_is_text")
    if not rules:
        return base
    found = F.array_compact(F.array(*[F.when(F.coalesce(b, F.lit(False)), F.lit(k)) for k, b in rules.items()]))
    more = claims.join(packets.select("worker").distinct(), "worker", "left_semi").select("worker", F.explode(found).alias("check"), (c("pos") + 1).cast("long").alias("ordinal"))
    both = union(base.withColumn("_fs_level", F.lit(0)), more.withColumn("_fs_level", F.lit(1)))
    first = F.min("_fs_level").over(Window.partitionBy("worker"))
    return both.withColumn("_fs_first", first).where("_fs_level = _fs_first").drop("_fs_level", "_fs_first")


def any_placeholder(claims: DataFrame) -> DataFrame:
    """The worker's own, stricter rule: rows with a placeholder in any field."""
    test = [F.coalesce(F.col(x).isin(*PLACEHOLDERS), F.lit(False)) for x in PACKET_FIELDS]
    return claims.where(test[0] | test[1] | test[2] | test[3])


def normalised(claims: DataFrame) -> DataFrame:
    """Claims with visual line wraps undone: no white space in paths, single spaces in quotations."""
    return claims.withColumns({"source_file": unspaced(F.col("source_file")), "excerpt": squeezed(F.col("excerpt"))})


def ledger_rows(claims: DataFrame, notes: DataFrame, verified_at: str) -> tuple[DataFrame, DataFrame]:
    """(ledger rows, dropped rows): claims with a note and an id, defaults filled in; the others by worker and position."""
    joined = claims.join(notes.select("source_file", "note", "source_id"), "source_file", "left")
    whole = F.col("note").isNotNull() & F.col("claim_id").isNotNull()
    ledger = joined.where(whole).select(
        "claim_id", "claim", "note", "locator", "excerpt", F.array("source_id").alias("source_ids"),
        F.coalesce("stance", F.lit("supports")).alias("stance"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce("independence_group", "worker").alias("independence_group"), F.lit(verified_at).alias("verified_at"), "worker",
    )
    return ledger, joined.where(~whole).select("worker", "pos", "source_file")


def model_violations(executions: DataFrame, allowed: list[str]) -> DataFrame:
    """Accepted packets whose recorded calls break a model restriction: worker, check."""
    ok = F.array(*map(F.lit, allowed))
    calls = F.coalesce("execution", F.array().cast("array<struct<role:string,requested:string,returned:string>>"))
    extraction = F.filter(calls, lambda x: x["role"] == "extraction")
    bad = F.exists(extraction, lambda x: ~F.coalesce(F.array_contains(ok, x["requested"]) & F.array_contains(ok, x["returned"]), F.lit(False)))
    check = F.when(F.size(calls) == 0, "no execution lineage").when(F.size(extraction) == 0, "no extraction call").when(bad, "model not allowed")
    return executions.select("worker", check.alias("check")).where("check IS NOT NULL")


def advisory(reply: Column) -> Column:
    """State of an advisory record: unavailable, available (with scope and uncertainty) or malformed."""
    return F.when(blank(reply), "unavailable").when(reply.contains("Scope:") & reply.contains("Uncertainty:"), "available").otherwise("malformed")


def visual_disposition(records: DataFrame) -> DataFrame:
    """bundle_key, disposition: no records, all with a derivative, or incomplete."""
    full = F.bool_and(F.col("derivative").isNotNull())
    state = F.when(F.count("asset") == 0, "no-visuals").when(full, "available").otherwise("incomplete-optional")
    return records.groupBy("bundle_key").agg(state.alias("disposition"))
