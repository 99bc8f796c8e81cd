"""Faults that the review of round 3 found in the operators."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from folioscan.llm import queries
from folioscan.llm.sharding import shards


def test_one_large_row_has_no_parts(spark):
    docs = spark.createDataFrame([(1, "x" * 300), (2, "y" * 20), (3, "z" * 20), (4, "a" * 90), (4, "b" * 90)], "doc_id long, text string")
    got = {(r.doc_id, r.part == 0) for r in shards(docs, 100).collect()}
    assert got == {(1, True), (2, True), (3, True), (4, False)}


def edited(n_pairs: int) -> list[tuple[int, str]]:
    """Pairs of lines that are as far apart as the threshold lets them be: a quarter of the words replaced, left out or put in."""
    rng = random.Random(5)
    words, rows = [f"w{i}" for i in range(300)], []
    for k in range(n_pairs):
        n = rng.randint(16, 90)
        a = [rng.choice(words) for _ in range(n)]
        b, kind = list(a), k % 3
        if kind == 0:
            for i in rng.sample(range(n), n // 4):
                b[i] = f"x{k}z{i}"
        elif kind == 1:
            for i in sorted(rng.sample(range(n), n // 4), reverse=True):
                del b[i]
        else:
            for j in range(n // 3):
                b.insert(rng.randint(0, len(b)), f"y{k}z{j}")
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
    return rows


def test_lines_at_the_threshold_are_found(spark, tmp_path):
    docs = spark.createDataFrame(edited(90), "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op4_line_dedup(spark, str(tmp_path)).where("n_removed = 1 AND doc_id % 2 = 1").count() == 90
    assert corpus_pipeline.lines(spark, docs, str(tmp_path)).where("text = '' AND doc_id % 2 = 1").count() == 90
