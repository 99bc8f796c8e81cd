"""The operators' queries against their oracle SQL on small tables, and that the rows decide something."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from folioscan.llm import queries

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query(spark, name):
    db = duckdb.connect()
    for file in os.listdir(DATA):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    df = (queries.QUERIES | queries.MORE)[name](spark, DATA)
    columns = sorted(df.columns)
    want = db.sql(queries.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)


def test_cutoffs_and_shards_bite(spark):
    kept = queries.MORE["quality_one_stratum"](spark, DATA)
    assert kept.where("NOT base_failed AND NOT kept").count() > 20 and kept.where("kept").count() > 500
    assert queries.MORE["shards_of_64k"](spark, DATA).agg(F.count_distinct("shard")).first()[0] > 20


def test_every_limit_of_conversations_binds(spark):
    """All tokens are placed once and gapless, no limit is passed, and each limit closes some sequences."""
    rows = queries.MORE["packed_conversations"](spark, DATA)
    each = rows.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.count("*").alias("segments"), F.sum("loss_tokens").alias("loss"), F.max(F.col("offset") + F.col("length")).alias("end"))
    each = each.collect()
    assert all(r.tokens <= 4096 and r.segments <= 5 and r.loss <= 3200 and r.end == r.tokens for r in each)
    assert sum(r.loss > 2900 for r in each) > 3 and sum(r.tokens > 3700 for r in each) > 3 and sum(r.segments == 5 for r in each) > 3
    assert rows.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).where("n % doc_tokens <> 0").isEmpty()
