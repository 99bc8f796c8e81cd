"""Aligned translation witnesses of canonical claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.functions.text import canonical_book, elided_udf, fold, grounded, trim_quotes, visible, witness_book


def aligned(alignment: DataFrame, work: str = "Aen") -> DataFrame:
    """book, variant, aligned_to of an alignment with a map of witnesses; an empty range means the whole book."""
    each = alignment.select("book", F.explode("witnesses").alias("variant", "meta"))
    whole = F.concat(F.lit(f"{work}."), F.col("book").cast("string"), F.lit(".1-"))
    return each.select("book", "variant", F.coalesce(F.nullif(F.col("meta.aligned_to"), F.lit("")), whole).alias("aligned_to"))


def witness_violations(claims: DataFrame, sources: DataFrame, alignment: DataFrame, work: str = "Aen") -> DataFrame:
    """claim_id, check of claims whose translation witness doesn't hold.

    claims: claim_id, locator, witness (struct of source_id, locator, excerpt,
    translator); sources: source_id, role, translator, text; alignment: book,
    variant. A missing witness, source or text ends a claim's checks, and so
    does a locator without a book; a source without a translator is reported
    and its alignment isn't looked up.
    """
    w = claims.select("claim_id", "locator", F.col("witness").isNull().alias("absent"), "witness.source_id", F.col("witness.locator").alias("at"), F.col("witness.translator").alias("by"), fold(F.coalesce("witness.excerpt", F.lit(""))).alias("needle"))
    s = sources.select("source_id", "role", F.col("translator").alias("variant"), fold(F.coalesce("text", F.lit(""))).alias("hay"), F.lit(True).alias("known"))
    a = alignment.select(F.col("book").alias("a_book"), F.lower("variant").alias("a_variant")).distinct().withColumn("has", F.lit(True))
    j = w.join(s, "source_id", "left").withColumns({"book": canonical_book(F.col("locator"), work), "w_book": witness_book(F.col("at"))})
    j = j.join(a, (F.col("book") == F.col("a_book")) & (F.lower("variant") == F.col("a_variant")), "left")
    found = grounded(F.col("needle"), F.col("hay")) | elided_udf(trim_quotes(F.col("needle")), F.col("hay"))
    known = sources.where("role = 'translation'").select(F.col("translator").alias("by"), F.lit(True).alias("by_known")).distinct()
    j = j.join(known, "by", "left").withColumns({"found": found, "known": F.coalesce("known", F.lit(False))})
    c, text, book = F.col, F.coalesce(F.col("hay") != "", F.lit(False)), F.col("w_book").isNotNull()
    live = ~c("absent") & c("known")
    checks = [
        (c("absent"), "no witness"),
        (~c("absent") & ~c("known"), "witness source not in ledger"),
        (live & ~F.coalesce(c("role") == "translation", F.lit(False)), "not a translation witness"),
        (live & F.coalesce(c("variant") == "", F.lit(True)), "no translator metadata"),
        (live & ~text, "witness snapshot missing"),
        (live & text & ~F.coalesce(c("found"), F.lit(False)), "excerpt not verbatim"),
        (live & text & ~book, "locator unparseable"),
        (live & text & book & F.coalesce(c("variant") != "", F.lit(False)) & c("has").isNull(), "no alignment"),
        (live & text & book & c("has").isNotNull() & (c("w_book") != c("book")), "locator book differs"),
        (live & text & book & c("has").isNotNull() & c("by").isNotNull() & (c("by") != "") & c("by_known").isNull(), "translator not in sources"),
    ]
    return j.select("claim_id", F.explode(F.array_compact(F.array(*[F.when(b, F.lit(k)) for b, k in checks]))).alias("check"))


def verbatim_pairs(candidates: DataFrame, claim: str, text: str, excerpt: str) -> DataFrame:
    """Candidates whose visible excerpt is part of the visible text."""
    needle = visible(F.col(excerpt))
    return candidates.where((needle != "") & visible(F.col(text)).contains(needle))


def assembled(claims: DataFrame, candidates: DataFrame, choices: DataFrame) -> DataFrame:
    """claim_id, witness candidate: the chosen one if it is among the verbatim ones, else the first; claims without any are dropped.

    candidates: claim_id, pos, excerpt; choices: claim_id, seq, pos (a later
    choice replaces an earlier one).
    """
    choice = choices.groupBy("claim_id").agg(F.max_by("pos", "seq").alias("_fs_pos"))
    ranked = candidates.join(choice, "claim_id", "left").withColumn("_fs_rank", F.struct(F.when(F.col("pos") == F.col("_fs_pos"), 0).otherwise(1).alias("other"), F.col("pos").alias("at")))
    picked = ranked.groupBy("claim_id").agg(F.min_by("excerpt", "_fs_rank").alias("witness_excerpt"))
    return claims.join(picked, "claim_id")
