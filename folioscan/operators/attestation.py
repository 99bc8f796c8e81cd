"""Attestations of packets' and ledgers' sources against recomputed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The fields that say how a source was turned into text, and the endings of files that must have them.
REPRESENTATION = ("adapter", "adapter_version", "representation_encoding", "representation_sha256")
MARKDOWN = (".md", ".markdown")


def packet_attestations(packets: DataFrame, envelopes: DataFrame, cited: DataFrame, recomputed: DataFrame, fields: list[str]) -> DataFrame:
    """worker, source_file, "check": what is wrong with the source envelopes of packets.

    packets: worker, has_envelope (absent ones are allowed, as older packets
    have none). envelopes: worker, source_file and fields, a row an entry.
    cited: worker, source_file of live claims and of those bound at first.
    recomputed: source_file and fields as they are now. Entries have unique
    names, cover all that is cited, and equal what is recomputed; null fields
    are equal to each other.
    """
    present = packets.where("has_envelope").select("worker").distinct()
    rows = envelopes.join(present, "worker", "left_semi")
    # entries and what is cited are counted side by side, so each pair of names is shuffled once
    name = F.coalesce("source_file", F.lit("")).alias("source_file")
    both = envelopes.select("worker", name, F.lit(1).alias("_entry")).unionByName(cited.select("worker", name, F.lit(0).alias("_entry")))
    seen = both.groupBy("worker", "source_file").agg(F.sum("_entry").alias("_entries")).where("_entries <> 1").join(present, "worker", "left_semi")
    names = seen.select("worker", "source_file", F.when(F.col("_entries") > 1, "duplicate source").otherwise("missing source").alias("check"))
    now = recomputed.select("source_file", *[F.col(f).alias(f"_now_{f}") for f in fields], F.lit(True).alias("_there"))
    stated = rows.join(now, "source_file", "left")
    checks = [F.when(F.col("_there").isNull(), "unknown source"), *[F.when(F.col("_there") & ~F.col(f).eqNullSafe(F.col(f"_now_{f}")), f"drift: {f}") for f in fields]]
    differ = stated.select("worker", F.coalesce("source_file", F.lit("")).alias("source_file"), F.explode(F.array_compact(F.array(*checks))).alias("check"))
    return names.unionByName(differ)


def representation_defects(ledger: DataFrame, recomputed: DataFrame, id_col: str = "source_id") -> DataFrame:
    """id, "check": ledger rows whose representation fields aren't what they must be.

    A row without any of the four fields passes, unless its snapshot is
    Markdown; otherwise it must have all four, equal to the recomputed ones. A
    source that can't be recomputed is invalid.
    """
    now = recomputed.select(id_col, *[F.col(f).alias(f"_now_{f}") for f in REPRESENTATION], F.lit(True).alias("_there"))
    present = sum((F.col(f).isNotNull().cast("int") for f in REPRESENTATION[1:]), F.col(REPRESENTATION[0]).isNotNull().cast("int"))
    markdown = F.lower(F.col("snapshot")).rlike(r"\.(md|markdown)\z")
    bound = ledger.join(now, id_col, "left").withColumn("_n", present).where((F.col("_n") > 0) | F.coalesce(markdown, F.lit(False)))
    whole = F.col("_n") == len(REPRESENTATION)
    checks = [F.when(F.col(f).isNull(), f"missing: {f}") for f in REPRESENTATION]
    checks += [F.when(whole & F.col("_there").isNull(), "representation invalid")]
    checks += [F.when(whole & F.col("_there") & ~F.col(f).eqNullSafe(F.col(f"_now_{f}")), f"mismatch: {f}") for f in REPRESENTATION]
    return bound.select(id_col, F.explode(F.array_compact(F.array(*checks))).alias("check"))
