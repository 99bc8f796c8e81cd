"""Attempts journals as streams: reservations against a budget, kept as state by task."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "task long, attempt long, spent double, outcome string"


def reservations(events: DataFrame, budget: float) -> DataFrame:
    """Every attempt with what its task spent so far and its outcome, budget_exhausted once the budget is passed.

    events: a stream of task, attempt, cost, outcome; attempts are taken in
    order within a batch, and an attempt seen before is not counted again. The
    state of a task is its sum and its last attempt.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spent, last = state.get if state.exists else (0.0, -1)
        rows = pd.concat(list(parts)).sort_values("attempt").drop_duplicates("attempt")
        out = []
        for r in rows.itertuples():
            if r.attempt > last:
                spent, last = spent + (0.0 if pd.isna(r.cost) else float(r.cost)), int(r.attempt)
                out.append((key[0], last, spent, "budget_exhausted" if spent > budget else r.outcome))
        state.update((spent, last))
        yield pd.DataFrame(out, columns=["task", "attempt", "spent", "outcome"])

    return events.groupBy("task").applyInPandasWithState(step, SCHEMA, "spent double, last long", "append", GroupStateTimeout.NoTimeout)
