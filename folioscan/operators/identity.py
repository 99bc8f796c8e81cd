"""Stable identities, append-only histories and their replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from folioscan.functions.digest import sha256
from folioscan.operators.checks import set_differences, union
from folioscan.operators.ranks import ranked


def ordinal_ids(claims: DataFrame, worker: str, pos: str) -> DataFrame:
    """claims with claim_id = c-{worker}-{1-based ordinal by position}; to be stored once, never taken again."""
    n = F.row_number().over(Window.partitionBy(worker).orderBy(pos))
    return claims.withColumn("claim_id", F.concat_ws("-", F.lit("c"), F.col(worker).cast("string"), n.cast("string")))


def ordered_digest(rows: DataFrame, group: str, pos: str, part: Column, name: str) -> DataFrame:
    """group, name: the digest of a group's parts in order, as a JSON list of canonical values."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(pos).alias("at"), part.alias("part"))))
    body = F.array_join(F.transform(parts, lambda x: x["part"]), ",")
    return rows.groupBy(group).agg(sha256(F.concat(F.lit('{"claims":['), body, F.lit("]}"))).alias(name))


def chain_breaks(events: DataFrame, group: str, seq: str, before: str, after: str) -> DataFrame:
    """Events whose state before isn't the state after the event that precedes it in their group."""
    last = F.lag(after).over(Window.partitionBy(group).orderBy(seq))
    first = F.row_number().over(Window.partitionBy(group).orderBy(seq)) == 1
    return events.withColumns({"_fs_last": last, "_fs_first": first}).where(~F.col("_fs_first") & ~F.col(before).eqNullSafe(F.col("_fs_last"))).drop("_fs_last", "_fs_first")


def final_states(events: DataFrame, group: str, seq: str, after: str) -> DataFrame:
    """group, state after its last event."""
    return events.groupBy(group).agg(F.max_by(after, seq).alias("state"))


def replay(claims: DataFrame, events: DataFrame) -> DataFrame:
    """Claims after their last repair or drop: dropped ones are gone, repaired excerpts replaced.

    events: claim_id, seq, event, new_excerpt. One aggregate in place of a
    loop: the last event of a claim wins.
    """
    own = events.where(F.col("event").isin("repair", "drop")).groupBy("claim_id")
    last = own.agg(F.max_by("event", "seq").alias("_fs_event"), F.max_by("new_excerpt", "seq").alias("_fs_excerpt"))
    joined = claims.join(last, "claim_id", "left").where("_fs_event IS NULL OR _fs_event <> 'drop'")
    return joined.withColumn("excerpt", F.when(F.col("_fs_event") == "repair", F.col("_fs_excerpt")).otherwise(F.col("excerpt"))).select(*claims.columns)


def replayed_once(events: DataFrame, seq: str, *keys: str) -> DataFrame:
    """Events without repeats of a key; the first by sequence stays."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(seq))
    return events.withColumn("_fs_n", n).where("_fs_n = 1").drop("_fs_n")


def drop_violations(events: DataFrame, bindings: DataFrame) -> DataFrame:
    """check, claim_id of drop events that don't hold: unbound, with an excerpt, without reason, attempt or a change of state."""
    joined = events.where("event = 'drop'").join(bindings.select("claim_id", F.col("source_file").alias("_fs_file"), F.col("source_revision").alias("_fs_revision")), "claim_id", "left")
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    rules = {
        "binding differs": ~(F.col("source_file").eqNullSafe(F.col("_fs_file")) & F.col("source_revision").eqNullSafe(F.col("_fs_revision"))),
        "drop has an excerpt": F.col("new_excerpt").isNotNull(),
        "no reason": blank("reason"),
        "no attempt": blank("attempt_id"),
        "state unchanged": F.col("state_before").eqNullSafe(F.col("state_after")),
    }
    found = F.array_compact(F.array(*[F.when(b, F.lit(k)) for k, b in rules.items()]))
    return joined.select(F.explode(found).alias("check"), "claim_id")


def unaccounted(original: DataFrame, current: DataFrame, drops: DataFrame) -> DataFrame:
    """claim_id, side of claims that are lost without a drop, or dropped and still there, or new."""
    lost = original.select("claim_id").join(current.select("claim_id"), "claim_id", "left_anti")
    differing = set_differences(lost, drops.select("claim_id"), "claim_id")
    fresh = current.select("claim_id").join(original.select("claim_id"), "claim_id", "left_anti")
    return union(differing, fresh.withColumn("side", F.lit("new")))


def packet_bindings(failures: DataFrame) -> DataFrame:
    """worker, binding (the first by position), incompatible (whether others differ)."""
    return failures.groupBy("worker").agg(F.min_by("binding", "pos").alias("binding"), (F.count_distinct("binding") > 1).alias("incompatible"))


def synchronised(ledger: DataFrame, live: DataFrame, drops: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ledger rows with live excerpts and revisions, violations) after repairs.

    ledger: pos, claim_id, claim, stance, source_file, excerpt,
    packet_state_revision; live has the same but pos. A live claim must have
    its row; a row without a claim must be a drop; claim, stance and file
    can't change.
    """
    now = live.select("claim_id", *[F.col(c).alias(f"_fs_{c}") for c in ("claim", "stance", "source_file", "excerpt", "packet_state_revision")], F.lit(True).alias("_fs_live"))
    both = ledger.withColumn("_fs_row", F.lit(True)).join(now, "claim_id", "full_outer").join(drops.select("claim_id", F.lit(True).alias("_fs_drop")).distinct(), "claim_id", "left")
    same = F.col("claim").eqNullSafe(F.col("_fs_claim")) & F.col("stance").eqNullSafe(F.col("_fs_stance")) & F.col("source_file").eqNullSafe(F.col("_fs_source_file"))
    check = (
        F.when(F.col("_fs_row").isNull(), "live claim has no ledger row")
        .when(F.col("_fs_live").isNull() & F.col("_fs_drop").isNull(), "ledger row is neither live nor dropped")
        .when(F.col("_fs_live").isNotNull() & ~same, "immutable field differs")
    )
    marked = both.withColumn("check", check)
    kept = marked.where("_fs_row AND _fs_live")
    rows = kept.withColumns({"excerpt": F.col("_fs_excerpt"), "packet_state_revision": F.col("_fs_packet_state_revision")}).select(*ledger.columns)
    return rows, marked.where("check IS NOT NULL").select("check", "claim_id")


def positional_differences(a: DataFrame, b: DataFrame, order: str, value: str) -> DataFrame:
    """at, left, right of two tables compared row by row in the order of a column; a missing row differs.

    Ranks are taken over ranges of the order, so no task holds a whole table.
    """
    left = ranked(a.select(order, F.col(value).alias("left")), [], [F.col(order)], "at").select(F.col("at").cast("int").alias("at"), "left", F.lit(True).alias("_fs_l"))
    right = ranked(b.select(order, F.col(value).alias("right")), [], [F.col(order)], "at").select(F.col("at").cast("int").alias("at"), "right", F.lit(True).alias("_fs_r"))
    both = left.join(right, "at", "full_outer")
    return both.where(F.col("_fs_l").isNull() | F.col("_fs_r").isNull() | ~F.col("left").eqNullSafe(F.col("right"))).select("at", "left", "right")


def positional_by(a: DataFrame, b: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """As positional_differences, within every group, so that no task holds more than a group."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(order))
    left = a.select(group, rank.alias("at"), F.col(value).alias("left"), F.lit(True).alias("_fs_l"))
    right = b.select(group, rank.alias("at"), F.col(value).alias("right"), F.lit(True).alias("_fs_r"))
    both = left.join(right, [group, "at"], "full_outer")
    return both.where(F.col("_fs_l").isNull() | F.col("_fs_r").isNull() | ~F.col("left").eqNullSafe(F.col("right"))).select(group, "at", "left", "right")


def report_targets(failures: DataFrame, live: DataFrame, aliases: DataFrame) -> DataFrame:
    """worker, alias, claim_id, n: each reported alias with the one live claim it names, through current ids and legacy aliases.

    n other than 1 (no claim, or several) is an error of the report.
    """
    names = live.select("worker", F.col("claim_id").alias("alias"), "claim_id").unionByName(aliases.select("worker", "alias", "claim_id")).distinct()
    joined = failures.join(names, ["worker", "alias"], "left")
    return joined.groupBy("worker", "alias").agg(F.min("claim_id").alias("claim_id"), F.count_distinct("claim_id").alias("n"))


def legacy_differences(packets: DataFrame, rows: DataFrame) -> DataFrame:
    """at, check where a packet's claims in order aren't the original ledger's rows: five fields, then the digest.

    Both have at (the place in order), claim, stance, source_file, locator,
    excerpt and sha256; places are joined, so no task holds a whole history.
    """
    fields = ("claim", "stance", "source_file", "locator", "excerpt")
    old = rows.select("at", *[F.col(c).alias(f"_fs_{c}") for c in (*fields, "sha256")], F.lit(True).alias("_fs_row"))
    both = packets.withColumn("_fs_claimed", F.lit(True)).join(old, "at", "full_outer")
    same = F.col("claim").eqNullSafe(F.col("_fs_claim"))
    for c in fields[1:]:
        same = same & F.col(c).eqNullSafe(F.col(f"_fs_{c}"))
    check = F.when(F.col("_fs_row").isNull(), "no row").when(F.col("_fs_claimed").isNull(), "no claim").when(~same, "fields differ").when(~F.col("sha256").eqNullSafe(F.col("_fs_sha256")), "digest differs")
    return both.select("at", check.alias("check")).where("check IS NOT NULL")


def repair_counts(decisions: DataFrame) -> DataFrame:
    """decision, n of recorded repair decisions."""
    return decisions.groupBy("decision").agg(F.count("*").alias("n"))


def repair_decisions(responses: DataFrame) -> DataFrame:
    """claim_id, decision from recorded proposals: found nothing or not grounded means drop."""
    good = F.coalesce(F.col("found"), F.lit(False)) & F.coalesce(F.col("is_grounded"), F.lit(False))
    return responses.select("claim_id", F.when(good, "repair").otherwise("drop").alias("decision"))
