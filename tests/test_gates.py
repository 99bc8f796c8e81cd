"""The acceptance stream and its sink, bundles, and the decision over gates."""

import random

import pytest
from pyspark.sql import functions as F

from folioscan.operators import bundles, gates
from folioscan.streaming import acceptance


def test_acceptance_over_restarts(spark, tmp_path):
    schema = "worker string, seq long, claim string, digest string"
    src, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    parts = [[("a", 2, "y", "d2"), ("a", 1, "x", "d1"), ("b", 3, "x", "d3")], [], [("a", 4, "x", "d1"), ("a", 5, "y", "other"), ("a", 6, "z", "d6"), ("b", 7, "x", "d3"), ("a", 8, "y", "d2")]]
    for part in parts:
        if part:
            spark.createDataFrame(part, schema).write.mode("append").parquet(src)
        acceptance.run(spark.readStream.schema(schema).parquet(src), out, checkpoint)
    got = {r.seq: (r.worker, r.claim, r.digest, r.claim_id, r.status) for r in spark.read.parquet(out).collect()}
    assert got == {
        1: ("a", "x", "d1", "c-a-1", "accepted"), 2: ("a", "y", "d2", "c-a-2", "accepted"), 3: ("b", "x", "d3", "c-b-1", "accepted"),
        4: ("a", "x", "d1", "c-a-1", "unchanged"), 5: ("a", "y", "d2", "c-a-2", "drift"), 6: ("a", "z", "d6", "c-a-3", "accepted"), 7: ("b", "x", "d3", "c-b-1", "unchanged"), 8: ("a", "y", "d2", "c-a-2", "unchanged"),
    }


def test_batches_are_created_once(spark, tmp_path):
    write = acceptance.frozen_batches(str(tmp_path / "t"))
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, s string")
    write(rows, 0)
    write(rows.repartition(3), 0)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    with pytest.raises(ValueError, match="other rows"):
        write(rows.distinct(), 0)
    write(rows.limit(0), 1)
    assert spark.read.parquet(str(tmp_path / "t")).where("batch = 0").count() == 3


def test_closure(spark):
    r = random.Random(2)
    edges = [(r.randrange(60), f"n{r.randrange(90)}") for _ in range(150)] + [(5, "n5"), (None, "n1"), (3, None), (3, "n3"), (3, "n3")]
    records = [(f"n{i}", i) for i in range(60)] + [("n4", 44), ("n7", None), (None, 3)]
    roots = [(1,), (2,), (2,), (None,)]
    to = {}
    for name, node in records:
        if name and node is not None:
            to[name] = min(node, to.get(name, node))
    front, want, seen = {1, 2}, {}, {1, 2}
    for step in range(1, 100):
        new = {x for n, x in edges if n in front and x is not None and x not in want}
        want |= {x: ("record" if x in to else "limitation", to.get(x), step) for x in new}
        front = {to[x] for x in new if x in to} - seen
        seen |= front
    args = [spark.createDataFrame(rows, s) for rows, s in ((roots, "node long"), (edges, "node long, reference string"), (records, "reference string, node long"))]
    found = bundles.closure(*args)
    assert {x.reference: (x.outcome, x.node, x.step) for x in found.collect()} == want and max(s for *_, s in want.values()) > 3
    assert bundles.closure(args[0].limit(0), args[1], args[2]).count() == 0
    with pytest.raises(ValueError, match="deeper"):
        bundles.closure(*args, most=2)


def test_bundle_defects(spark):
    found = spark.createDataFrame([("a", "record", 1, 1, "x"), ("b", "record", 2, 1, "y"), ("c", "limitation", None, 1, None), ("d", "limitation", None, 2, None), ("e", "record", 3, 2, "z")], "reference string, outcome string, node long, step int, digest string")
    required, recorded = spark.createDataFrame([("a",), ("c",)], "reference string"), spark.createDataFrame([("a", "x"), ("b", "other"), ("f", "q")], "reference string, digest string")
    assert sorted(map(tuple, bundles.bundle_defects(found, required, recorded).collect())) == [("b", "digest differs"), ("c", "required reference without a record"), ("e", "record not in the bundle"), ("f", "bundle has more than is reached")]


def test_gates(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (3, -1), (4, -20)], "id int, v int")
    rules = {"negative": F.col("v") < 0, "far": F.abs("v") > 10}
    violations, decision = gates.judged([gates.Gate("one", rows, F.col("id"), rules), gates.Gate("none", rows.limit(0), F.col("id"), rules), gates.Gate("good", rows.where("id = 1"), F.col("id"), rules)])
    assert sorted(map(tuple, violations.collect())) == [("one", "far", "4"), ("one", "negative", "3"), ("one", "negative", "4")]
    assert sorted(map(tuple, decision.collect())) == [("good", 1, 0, True), ("none", 0, 0, True), ("one", 4, 2, False)]
    whole = lambda d, receipt: {r.gate: r for r in gates.published(d, receipt).collect()}["publication"]
    good = decision.where("valid")
    assert whole(decision, {"one": 4, "none": 0, "good": 1}).valid is False
    assert whole(good, {"none": 0, "good": 1}).valid is True and whole(good, {"none": 0, "good": 2}).valid is False
    assert whole(good, {"good": 1}).valid is False and whole(good, {"none": 0, "good": 1, "more": 1}).valid is False


def test_each_gate_scans_once(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    read = spark.sparkContext.accumulator(0)
    rows = spark.read.parquet(str(tmp_path / "t")).select(F.udf(lambda x: read.add(1) or x, "long")("id").alias("id"))
    violations, decision = gates.judged([gates.Gate("a", rows, F.col("id"), {"odd": F.col("id") % 2 == 1})])
    assert violations.count() == 50 and decision.first().n_rows == 100 and read.value == 100
