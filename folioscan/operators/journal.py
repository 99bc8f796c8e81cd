"""Attempts journals: budgets, limits, outcomes, states and retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: The run's states in order.
STATES = ("PLANNING", "RESEARCHING", "VERIFYING_SOURCES", "COMPILING", "MATERIALIZING_LEDGER", "VERIFYING_DIFF", "READY_FOR_REVIEW")


def usage(prompt: Column, completion: Column, total: Column) -> Column:
    """Known tokens: the total, or the sum if both parts are known; negative numbers count as unknown."""
    known = lambda c: F.when(c >= 0, c)
    return F.coalesce(known(total), known(prompt) + known(completion))


def totals(attempts: DataFrame, group: str, tokens: str, elapsed: str, timeout: str) -> DataFrame:
    """group, requests, tokens (unknown counts as 0), unknown, seconds (the timeout while an attempt is pending)."""
    return attempts.groupBy(group).agg(
        F.count("*").alias("requests"),
        F.sum(F.coalesce(F.col(tokens), F.lit(0))).alias("tokens"),
        F.count_if(F.col(tokens).isNull()).alias("unknown"),
        F.sum(F.coalesce(F.col(elapsed), F.col(timeout))).alias("seconds"),
    )


def remaining(attempts: DataFrame, group: str, seq: list[str], spent: str, budget: float, name: str) -> DataFrame:
    """attempts with what was left of the budget before each."""
    before = Window.partitionBy(group).orderBy(*seq).rowsBetween(Window.unboundedPreceding, -1)
    return attempts.withColumn(name, F.lit(budget) - F.coalesce(F.sum(spent).over(before), F.lit(0)))


def latest(rows: DataFrame, group: str, seq: str, value: str) -> DataFrame:
    """group, value of its last row."""
    return rows.groupBy(group).agg(F.max_by(value, seq).alias(value))


def reserved(attempts: DataFrame, group: str, seq: list[str], cost: str, budget: float) -> DataFrame:
    """attempts with outcome: budget_exhausted once the sum with an attempt passes the budget, else its own."""
    upto = Window.partitionBy(group).orderBy(*seq).rowsBetween(Window.unboundedPreceding, 0)
    return attempts.withColumn("outcome", F.when(F.sum(cost).over(upto) > budget, "budget_exhausted").otherwise(F.col("outcome")))


def blocked(attempts: DataFrame, group: str, seq: str, checkpoint: int, terminal: list[str]) -> DataFrame:
    """group, n, blocked: attempts after a checkpoint, and whether a terminal outcome forbids another."""
    return attempts.where(F.col(seq) > checkpoint).groupBy(group).agg(F.count("*").alias("n"), F.bool_or(F.coalesce(F.col("outcome").isin(*terminal), F.lit(False))).alias("blocked"))


def fallback(profiles: Column, index: Column) -> Column:
    """The profile for an attempt's 0-based index; the last serves all later ones."""
    return F.element_at(profiles, F.least(index + 1, F.size(profiles)).cast("int"))


def error_class(status: Column, kind: Column) -> Column:
    """Class of a failed call by its HTTP status, then by the error's type."""
    return (
        F.when(status.isin(401, 403), "authentication")
        .when(status == 429, "rate_limited")
        .when(status.isin(408, 504), "timeout")
        .when(status >= 500, "unavailable")
        .when(status >= 400, "invalid_request")
        .when(F.lower(kind).contains("timeout"), "timeout")
        .when(F.lower(kind).contains("connect"), "unavailable")
        .otherwise("failed")
    )


def illegal_transitions(states: DataFrame, run: str, seq: str, state: str) -> DataFrame:
    """Rows whose state doesn't follow the one before: the next in order, or FAILED from any but the last."""
    order = Window.partitionBy(run).orderBy(seq)
    rank = F.array_position(F.array(*map(F.lit, STATES)), F.col(state))
    marked = states.withColumns({"_fs_rank": rank, "_fs_last": F.lag(state).over(order)}).withColumn("_fs_before", F.array_position(F.array(*map(F.lit, STATES)), F.col("_fs_last")))
    first = F.col("_fs_last").isNull() & (F.col("_fs_rank") == 1)
    onward = (F.col("_fs_rank") > 0) & (F.col("_fs_before") > 0) & (F.col("_fs_rank") == F.col("_fs_before") + 1)
    failed = (F.col(state) == "FAILED") & F.col("_fs_before").between(1, len(STATES) - 1)
    return marked.where(~F.coalesce(first | onward | failed, F.lit(False))).drop("_fs_rank", "_fs_last", "_fs_before")


def reconciliation(state: DataFrame, records: DataFrame, run: str) -> DataFrame:
    """run, check of counters that aren't the sums of the request records."""
    sums = records.groupBy(run).agg(F.count("*").alias("_fs_n"), F.sum(F.coalesce("tokens", F.lit(0))).alias("_fs_tokens"))
    joined = state.join(sums, run, "left").withColumns({"_fs_n": F.coalesce("_fs_n", F.lit(0)), "_fs_tokens": F.coalesce("_fs_tokens", F.lit(0))})
    found = F.array_compact(F.array(F.when(F.col("requests") != F.col("_fs_n"), F.lit("requests differ")), F.when(F.col("tokens") != F.col("_fs_tokens"), F.lit("tokens differ"))))
    return joined.select(run, F.explode(found).alias("check"))


def envelope_bytes(text: Column, messages: Column, reserve: Column) -> Column:
    """Size of a request: UTF-8 bytes, 1024 for the frame, 256 a message, and the reserve for output."""
    return F.octet_length(text) + 1024 + 256 * messages + reserve


def accepted(finish: Column, content: Column) -> Column:
    """Whether a response can be used: it stopped by itself and isn't blank."""
    return F.coalesce((finish == "stop") & (F.trim(content) != ""), F.lit(False))


def resumable(done: DataFrame, units: DataFrame) -> DataFrame:
    """units with skip: the longest prefix by position whose recorded id, input and output digests all agree."""
    joined = units.join(done.select("pos", *[F.col(c).alias(f"_fs_{c}") for c in ("unit_id", "input_sha256", "output_sha256")]), "pos", "left")
    same = F.col("unit_id").eqNullSafe(F.col("_fs_unit_id")) & F.col("input_sha256").eqNullSafe(F.col("_fs_input_sha256")) & F.col("output_sha256").eqNullSafe(F.col("_fs_output_sha256"))
    broken = joined.where(~same).agg(F.min("pos").alias("_fs_first"))
    return joined.crossJoin(broken).withColumn("skip", F.col("_fs_first").isNull() | (F.col("pos") < F.col("_fs_first"))).select(*units.columns, "skip")  # broken is one row
