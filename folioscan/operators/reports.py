"""Repair reports: their rows, what is read back from their text, and the claims they mean, found in ordered rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.functions.digest import multiset_revision, sha256

#: How the line begins that holds a report's metadata, and how lines of older reports look.
META, LINE, ABOUT = "REPORT-META:", r"(?m)^[ \t]*(c-[^:\s]+):[ \t]*(\S.*)$", r"excerpt|snapshot"


def packet_bindings(claims: DataFrame) -> DataFrame:
    """worker, packet_revision, packet_state_revision, incompatible for every packet that has both revisions.

    A packet whose claims state several pairs is incompatible, with the least of each.
    """
    bound = claims.where("worker <> '' AND packet_revision <> '' AND packet_state_revision <> ''")
    each = bound.groupBy("worker").agg(F.min("packet_revision").alias("packet_revision"), F.min("packet_state_revision").alias("packet_state_revision"), (F.count_distinct("packet_revision", "packet_state_revision") > 1).alias("incompatible"))
    return each


def report_rows(failures: DataFrame, claims: DataFrame) -> DataFrame:
    """claim_id, worker, reason, old_excerpt, source_ids for each failure; a claim that isn't there gives nulls and no sources.

    Of several claims with one id the least by worker, excerpt and sources counts.
    """
    known = claims.groupBy("claim_id").agg(F.min(F.struct("worker", F.col("excerpt").alias("old_excerpt"), "source_ids")).alias("of")).select("claim_id", "of.*")
    out = failures.select("claim_id", "reason").join(known, "claim_id", "left")
    return out.select("claim_id", "worker", "reason", "old_excerpt", F.coalesce("source_ids", F.array().cast("array<string>")).alias("source_ids"))


def report_id(rows: DataFrame, source_revision: DataFrame) -> DataFrame:
    """source_revision, report_id: the digest over a report's rows, in whatever order they are, and its sources' revision.

    rows have claim_id and reason; only digests of them meet in one row.
    """
    each = sha256(F.to_json(F.struct("claim_id", "reason"), {"ignoreNullFields": "false"}))
    whole = rows.agg(multiset_revision(each).alias("rows"))
    return source_revision.crossJoin(whole).select("source_revision", sha256(F.concat_ws(" ", "source_revision", "rows")).alias("report_id"))  # one row each


def read_back(reports: DataFrame, current: DataFrame) -> DataFrame:
    """report, version, source_revision, report_id, "check" of texts of reports; check is null for a sound one.

    reports: report, text, expected_id (the digest of the rows as they are
    read). current: source_revision, one row. A text has exactly one line of
    metadata, of version 1, bound to the current sources; a text without one
    is an older report ("legacy"), which report_lines reads.
    """
    lines = F.filter(F.split("text", r"\r?\n"), lambda x: F.startswith(x, F.lit(META)))
    meta = F.from_json(F.substring(F.element_at(lines, 1), F.lit(len(META) + 1), F.lit(2**31 - 1)), "version int, source_revision string, report_id string")
    read = reports.select("report", "expected_id", F.when(F.size(lines) > 0, meta).alias("meta"), F.size(lines).alias("n")).crossJoin(F.broadcast(current.select(F.col("source_revision").alias("now"))))  # current is one row
    check = F.when(F.col("n") == 0, "legacy").when(F.col("n") > 1, "several lines of metadata").when(F.coalesce(F.col("meta.version"), F.col("meta.source_revision"), F.col("meta.report_id")).isNull(), "metadata is no object")
    check = check.when(~F.col("meta.version").eqNullSafe(F.lit(1)), "unsupported version").when(~F.col("meta.source_revision").eqNullSafe(F.col("now")), "source revision is stale").when(~F.col("meta.report_id").eqNullSafe(F.col("expected_id")), "report identity is invalid")
    return read.select("report", "meta.version", "meta.source_revision", "meta.report_id", check.alias("check"))


def report_lines(reports: DataFrame) -> DataFrame:
    """report, alias, reason of each line of an older report that speaks of an excerpt or a snapshot."""
    found = F.arrays_zip(F.regexp_extract_all("text", F.lit(LINE), F.lit(1)).alias("alias"), F.regexp_extract_all("text", F.lit(LINE), F.lit(2)).alias("reason"))
    return reports.select("report", F.explode(found).alias("x")).select("report", "x.alias", "x.reason").where(F.col("reason").rlike(ABOUT))


def linked(failures: DataFrame, current: DataFrame, legacy: DataFrame, prose: DataFrame) -> DataFrame:
    """failure, claim_id, round for every failure: the claim it means, found in rounds, each over what is left.

    failures: failure, alias, worker (null if the report doesn't say), text.
    Round 1: alias is a current claim_id. Round 2: legacy (worker, alias,
    claim_id) has it. Round 3: the first id that its text speaks of, over
    prose (alias, worker, claim_id). A round links a failure only if just one
    claim of its worker fits; several make it "ambiguous", which no later round
    mends; a failure that none links is "unknown", both without a claim_id.
    """
    named = F.coalesce(F.regexp_extract("text", LINE, 1), F.lit(""))
    rounds = [
        ("current", "alias", current.select("worker", F.col("claim_id").alias("key"), "claim_id")),
        ("legacy", "alias", legacy.select("worker", F.col("alias").alias("key"), "claim_id")),
        ("prose", "named", prose.select("worker", F.col("alias").alias("key"), "claim_id")),
    ]
    # a failure without a worker may mean a claim of any; both kinds are met by equality
    j = failures.select("failure", "alias", named.alias("named"), F.col("worker").isNull().alias("any"), F.coalesce(F.col("worker").cast("string"), F.lit("")).alias("of"))
    for name, key, names in rounds:
        own = names.select(F.lit(False).alias("any"), F.col("worker").cast("string").alias("of"), F.col("key").alias(key), F.col("claim_id").alias("target")).distinct().where(F.col("of").isNotNull())
        every = names.select(F.lit(True).alias("any"), F.lit("").alias("of"), F.col("key").alias(key), F.struct("worker", F.col("claim_id").alias("target")).alias("t")).distinct()
        # claims are counted before they are joined, so that a common alias makes no pairs
        met = own.groupBy("any", "of", key).agg(F.count("*").alias(f"{name}_n"), F.min("target").alias(f"{name}_target"))
        met = met.unionByName(every.groupBy("any", "of", key).agg(F.count("*").alias(f"{name}_n"), F.min("t.target").alias(f"{name}_target")))
        j = j.join(met, ["any", "of", key], "left")
    each = j.groupBy("failure").agg(*[f(f"{name}_{c}").alias(f"{name}_{c}") for name, _, _ in rounds for f, c in ((F.sum, "n"), (F.min, "target"))])
    claim, found = F.lit(None).cast("string"), F.lit("unknown")
    for name, _, _ in reversed(rounds):
        n = F.col(f"{name}_n")
        claim = F.when(n == 1, F.col(f"{name}_target")).when(n > 1, F.lit(None)).otherwise(claim)
        found = F.when(n == 1, name).when(n > 1, "ambiguous").otherwise(found)
    return each.select("failure", claim.alias("claim_id"), found.alias("round"))
