"""Named queries over the tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with its oracle SQL if there is any."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


from folioscan.plans import boundary_queries, corpus_queries, derived_queries, gate_queries, ledger_queries, page_queries, plan_queries, report_queries, tree_queries  # noqa: E402, F401
