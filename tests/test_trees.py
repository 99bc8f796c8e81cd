"""Range digests and the anchors' index against brute force."""

import hashlib
import random

import pytest

from folioscan.operators import anchors, trees

SCHEMA = "key long, t string, n int"


@pytest.mark.parametrize("rows", [1, 5000, 400_000])
def test_changes_at_every_depth(spark, rows):
    r = random.Random(1)
    before = [(i, f"text {i}" if i % 7 else None, i % 3) for i in range(300)] + [(7, "again", 1), (None, "no key", 1)]
    after = [(i, t + "x" if t and i % 13 == 0 else t, n) for i, t, n in before if i and i % 17] + [(1000, "new", 0), (1001, "", None)]
    r.shuffle(after)
    a, b = (trees.leaves(spark.createDataFrame(x, SCHEMA), "key", "t", "n") for x in (before, after))
    got = {(x.key, x.change) for x in trees.changes(a, b, rows).collect()}
    of = lambda rows: {k: sorted(repr(x[1:]) for x in rows if x[0] == k) for k in {x[0] for x in rows} - {None}}
    old, new = of(before), of(after)
    assert got == {(k, "removed") for k in old.keys() - new.keys()} | {(k, "added") for k in new.keys() - old.keys()} | {(k, "changed") for k in old.keys() & new.keys() if old[k] != new[k]}
    assert trees.changes(a, a, rows).count() == 0 and trees.changes(a.limit(0), a.limit(0)).count() == 0


def test_only_unequal_ranges_are_opened(spark):
    a = spark.createDataFrame([(i, "x", 0) for i in range(2000)], SCHEMA)
    b = spark.createDataFrame([(i, "y" if i == 77 else "x", 0) for i in range(2000)], SCHEMA)
    tables = [trees.ranges(trees.leaves(x, "key", "t", "n"), 2) for x in (a, b)]
    assert [x.prefix for x in trees.unequal(*tables, 2).collect()] == [hashlib.md5(b"77").hexdigest()[:2]]
    assert trees.baseline(a, "key", "t") == trees.baseline(a.repartition(7), "key", "t") != trees.baseline(b, "key", "t")
    assert trees.baseline(a.limit(0), "key", "t") == ""
    # null and empty, and values that run into each other, are told apart
    one, other = ([(1, "a", None), (2, None, 1)], [(1, "a", None), (2, "", 1)])
    assert trees.baseline(spark.createDataFrame(one, SCHEMA), "key", "t", "n") != trees.baseline(spark.createDataFrame(other, SCHEMA), "key", "t", "n")


def test_attempts(spark):
    runs = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("a", 4, "x"), ("b", 2, "x"), ("c", 1, None), ("c", 2, None), ("d", 1, "x"), ("d", 1, "x")], "unit string, attempt long, base string")
    got = sorted(tuple(r) for r in trees.attempts(runs, ["base"]).collect())
    assert got == [("a", 3, "drift: base"), ("a", 4, "attempt out of bounds"), ("b", 2, "no attempt before"), ("d", 1, "attempt repeated"), ("d", 1, "attempt repeated")]


def test_held_by_brute_force(spark):
    r = random.Random(5)
    word = lambda: "the" if r.random() < 0.4 else f"w{r.randrange(60)}"
    bodies = [(i, " ".join(word() for _ in range(120))) for i in range(60)] + [(100, None), (101, ""), (102, "one"), (0, "a body with the same id")]
    targets = []
    for k in range(80):
        text = bodies[k % 60][1]
        at = r.randrange(len(text) - 60)
        targets.append((k, text[at : at + r.randrange(5, 60)]))  # cut within words too
    targets += [(200, "never in there at all"), (201, ""), (202, None), (203, "two words"), (204, "the the the"), (205, targets[0][1]), (206, "a  body with"), (207, " the w1 the ")]
    t, b = spark.createDataFrame(targets, "id long, text string"), spark.createDataFrame(bodies, "id long, text string")
    got = {tuple(x) for x in anchors.held(t.withColumnRenamed("id", "tid"), b.withColumnRenamed("id", "bid"), "tid", "text", "bid", "text").collect()}
    import re

    want = {(i, j) for i, x in targets if x and len(re.split(r"\s+", x)) > 2 for j, y in bodies if y and x in y}
    assert got == want and len(want) > 50
    plan = anchors.held(t.withColumnRenamed("id", "tid"), b.withColumnRenamed("id", "bid"), "tid", "text", "bid", "text")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_held_of_nothing(spark):
    t = spark.createDataFrame([], "a long, x string")
    b = spark.createDataFrame([(1, "some text here")], "b long, y string")
    assert anchors.held(t, b, "a", "x", "b", "y").count() == 0
    assert anchors.held(b, t, "b", "y", "a", "x").count() == 0


def test_section_report(spark):
    s = spark.createDataFrame([(1, "primary", None), (2, "excluded", "index"), (3, "primary", None)], "section long, disposition string, reason string")
    covered, cites = spark.createDataFrame([(1,), (1,)], "section long"), spark.createDataFrame([(1, "b"), (1, "a"), (1, "b")], "section long, page string")
    got = sorted(tuple(r) for r in anchors.section_report(s, covered, cites, "section", "page").collect())
    assert got == [(1, "compiled", None, ["a", "b"]), (2, "excluded", "index", []), (3, "primary", None, [])]
