"""One decision over many gates, taken while the violations are written.

Each gate reads its table once: what it counts is observed beside the rows
that break it, so totals and the decision need no second pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from folioscan.operators.checks import union
from folioscan.sources.scratch import written


@dataclass(frozen=True)
class Gate:
    """A named check of each row of a table: subject identifies the row, rules say what is wrong with it."""

    name: str
    rows: DataFrame
    subject: Column
    rules: dict[str, Column]


def judged(gates: list[Gate]) -> tuple[DataFrame, DataFrame]:
    """(violations, decision) of all gates.

    violations: gate, check, subject_id, written once. decision: gate, n_rows,
    n_invalid (rows that break a rule), valid; one row a gate, also for empty
    tables, which are valid. A null rule isn't broken. The numbers come with
    the write of the violations.
    """
    parts, counts = [], []
    for gate in gates:
        broken = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in gate.rules.items()]))
        rows = gate.rows.select(gate.subject.cast("string").alias("subject_id"), broken.alias("broken"))
        seen = Observation(f"gate {gate.name}")
        watched = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.size("broken") > 0).alias("invalid"))
        parts.append(watched.select(F.lit(gate.name).alias("gate"), F.explode("broken").alias("check"), "subject_id"))
        counts.append((gate.name, seen))
    violations = written(union(*parts))
    numbers = [(name, seen.get["n"], seen.get["invalid"], seen.get["invalid"] == 0) for name, seen in counts]
    return violations, violations.sparkSession.createDataFrame(numbers, "gate string, n_rows long, n_invalid long, valid boolean")


def published(decision: DataFrame, receipt: dict[str, int]) -> DataFrame:
    """decision with a row for the whole ("publication"): valid if every gate is and the receipt states their numbers of rows.

    receipt: rows by gate, as a finished run has stated them. Gates that it
    doesn't name, or that it names and aren't there, make it invalid.
    """
    stated = F.create_map(*[x for name, n in sorted(receipt.items()) for x in (F.lit(name), F.lit(n))]) if receipt else F.lit(None).cast("map<string,int>")
    agrees = F.bool_and(F.coalesce(stated[F.col("gate")] == F.col("n_rows"), F.lit(False)))
    whole = decision.agg(F.lit("publication").alias("gate"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("n_invalid"), F.lit(0)).alias("n_invalid"), (F.coalesce(F.bool_and("valid"), F.lit(True)) & F.coalesce(agrees, F.lit(True)) & (F.count(F.lit(1)) == len(receipt))).alias("valid"))
    return decision.unionByName(whole)
