"""Nested JSON, attestations, reports, ranks and navigation against plain Python."""

import json
import random

from pyspark.sql import functions as F

from folioscan.operators import attestation, ranks, reports, site, variants

TEXTS = ['{"b":[1,2.50,{"x":null,"é":"a\\"b\\n\\u0001\\u001f/"}],"a":{},"c":[],"d":true,"j":"","k":[null,[[]]]}', "7", '"s"', "null", "[]", "{}", '{"z":1e-7,"y":1.0,"x":123456789.25,"w":1e16,"v":0.0001,"u":1e22,"t":12345678901234567890123,"s":-2.5e-10,"r":100000.0,"q":1234567890123456.7}',
         '{"a/b":{"~":1},"a":{"b":2},"日本":"語","😀":1,"ﬀ":2}', '[{"a":[{"b":[1]}]}]', "true", '{"0":[1],"1":{"0":2}}']


def test_canonical_json(spark):
    df = spark.createDataFrame([*enumerate(TEXTS), (90, None), (91, "no json"), (0, "[1]")], "id long, j string").withColumn("row", F.lit(1)).repartition(3)
    got = sorted((r.id, r.canonical) for r in variants.canonical(df, "id", "j").collect())
    assert got == sorted([(i, json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"), ensure_ascii=False)) for i, t in [*enumerate(TEXTS), (0, "[1]")]])
    assert variants.canonical(df.limit(0), "id", "j").count() == 0


def paths(value, at=""):
    if isinstance(value, dict) and value:
        return {k: v for key, x in value.items() for k, v in paths(x, f"{at}/{key.replace('~', '~0').replace('/', '~1')}").items()}
    if isinstance(value, list) and value:
        return {k: v for i, x in enumerate(value) for k, v in paths(x, f"{at}/{i}").items()}
    return {at: repr(value)}


def test_drift(spark):
    r = random.Random(4)

    def made(depth=0):
        kind = r.randrange(7 if depth < 4 else 5)
        if kind > 4:
            return {f"k{r.randrange(4)}": made(depth + 1) for _ in range(3)} if kind == 5 else [made(depth + 1) for _ in range(r.randrange(3))]
        return [r.randrange(3), None, "t", r.random() < 0.5, 2.5][kind]

    a, b = {i: made() for i in range(60)}, {i: made() for i in range(20, 80)}
    b |= {i: a[i] for i in range(20, 40)}
    frames = [spark.createDataFrame([(i, json.dumps(x)) for i, x in of.items()], "id long, j string") for of in (a, b)]
    want = set()
    for i in a.keys() | b.keys():
        x, y = (paths(of[i]) if i in of else {} for of in (a, b))
        want |= {(i, p, "added" if p not in x else "removed" if p not in y else "changed") for p in x.keys() | y.keys() if x.get(p) != y.get(p)}
    assert {tuple(x) for x in variants.drift(*frames, "id", "j").collect()} == want and len(want) > 60


def test_packet_attestations(spark):
    packets = spark.createDataFrame([("a", True), ("b", False), ("c", True)], "worker string, has_envelope boolean")
    rows = spark.createDataFrame([("a", "x", "1"), ("a", "x", "1"), ("a", "y", None), ("a", "gone", "1"), ("b", "x", "9"), ("a", None, "1")], "worker string, source_file string, v string")
    cited = spark.createDataFrame([("a", "x"), ("a", "z"), ("b", "z"), ("c", "x"), ("c", None)], "worker string, source_file string")
    now = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "1")], "source_file string, v string")
    got = sorted(map(tuple, attestation.packet_attestations(packets, rows, cited, now, ["v"]).collect()))
    assert got == [("a", "", "unknown source"), ("a", "gone", "unknown source"), ("a", "x", "duplicate source"), ("a", "y", "drift: v"), ("a", "z", "missing source"), ("c", "", "missing source"), ("c", "x", "missing source")]


def test_representation_defects(spark):
    schema = "source_id string, snapshot string, adapter string, adapter_version string, representation_encoding string, representation_sha256 string"
    rows = spark.createDataFrame([("old", "a.txt", None, None, None, None), ("md", "a.Markdown", None, None, None, None), ("half", "a.txt", "x", None, None, "s"), ("good", "a.md", "x", "1", "u", "s"), ("bad", "a.txt", "x", "2", "u", "t"), ("gone", "a.txt", "x", "1", "u", "s"), ("null", None, None, None, None, None)], schema)
    now = spark.createDataFrame([(i, None, "x", "1", "u", "s") for i in ("old", "md", "half", "good", "bad", "null")], schema)
    got = sorted(map(tuple, attestation.representation_defects(rows, now).collect()))
    assert got == [("bad", "mismatch: adapter_version"), ("bad", "mismatch: representation_sha256"), ("gone", "representation invalid"), ("half", "missing: adapter_version"), ("half", "missing: representation_encoding"), *[("md", f"missing: {f}") for f in attestation.REPRESENTATION]]


def test_reports(spark):
    failures = spark.createDataFrame([("c-1", "r"), ("c-9", "r")], "claim_id string, reason string")
    claims = spark.createDataFrame([("c-1", "w", "q", ["s"], "p", "t"), ("c-2", "w", "q", [], "p", "u"), ("c-3", "v", "q", [], "p", "u"), ("c-4", "x", "q", [], None, "u")], "claim_id string, worker string, excerpt string, source_ids array<string>, packet_revision string, packet_state_revision string")
    assert sorted(map(tuple, reports.report_rows(failures, claims).collect())) == [("c-1", "w", "r", "q", ["s"]), ("c-9", None, "r", None, [])]
    assert sorted(map(tuple, reports.packet_bindings(claims).collect())) == [("v", "p", "u", False), ("w", "p", "t", True)]
    revision = spark.createDataFrame([("r1",)], "source_revision string")
    one, other = (reports.report_id(x, revision).first().report_id for x in (failures, failures.orderBy("claim_id", ascending=False).repartition(2)))
    assert one == other != reports.report_id(failures.limit(1), revision).first().report_id
    texts = spark.createDataFrame([("a", 'REPORT-META:{"version":1,"source_revision":"r1","report_id":"i"}', "i"), ("b", "REPORT-META: nonsense", "i"), ("c", "c-1: no excerpt\r\nc-2: fine\n  c-3:  bad snapshot x ", "i"), ("d", 'REPORT-META:{"version":1,"source_revision":"r1"}', "i"), ("e", "REPORT-META:1\nREPORT-META:2", "i")], "report string, text string, expected_id string")
    assert {r.report: r.check for r in reports.read_back(texts, revision).collect()} == {"a": None, "b": "metadata is no object", "c": "legacy", "d": "report identity is invalid", "e": "several lines of metadata"}
    assert sorted((r.alias, r.reason.strip()) for r in reports.report_lines(texts).collect()) == [("c-1", "no excerpt"), ("c-3", "bad snapshot x")]


def test_links_go_by_rounds(spark):
    failures = spark.createDataFrame([("f1", "c-1", "w", None), ("f2", "old", "w", None), ("f3", "old2", None, None), ("f4", "none", "w", "see\n c-2: excerpt"), ("f5", "none", "w", "nothing"), ("f6", "c-1", "other", None), ("f7", None, None, None), ("f8", "old2", "v", None)], "failure string, alias string, worker string, text string")
    current = spark.createDataFrame([("w", "c-1"), ("w", "c-2"), ("v", "c-3")], "worker string, claim_id string")
    legacy = spark.createDataFrame([("w", "old", "c-2"), ("w", "old2", "c-1"), ("v", "old2", "c-3"), ("w", "c-1", "c-2")], "worker string, alias string, claim_id string")
    prose = current.select("worker", F.col("claim_id").alias("alias"), "claim_id")
    got = {r.failure: (r.claim_id, r.round) for r in reports.linked(failures, current, legacy, prose).collect()}
    assert got == {"f1": ("c-1", "current"), "f2": ("c-2", "legacy"), "f3": (None, "ambiguous"), "f4": ("c-2", "prose"), "f5": (None, "unknown"), "f6": (None, "unknown"), "f7": (None, "unknown"), "f8": ("c-3", "legacy")}


def test_ranks(spark):
    r = random.Random(6)
    rows = [(r.choice(["hot", "hot", "hot", "a", None]), r.random(), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, x double, i int").repartition(5)
    got = {x.i: x.rank for x in ranks.ranked(df, ["g"], [F.col("x")]).collect()}
    want = {}
    for g in {g for g, *_ in rows}:
        want |= {i: k + 1 for k, (_, i) in enumerate(sorted((x, i) for h, x, i in rows if h == g))}
    assert got == want
    alone = ranks.ranked(df, [], [F.col("x")])
    assert [x.i for x in alone.orderBy("rank").collect()] == [i for _, i in sorted((x, i) for _, x, i in rows)]
    assert ranks.ranked(df.limit(0), ["g"], [F.col("x")]).count() == 0


def test_navigation(spark):
    urls = ["http://h/a/b10", "http://h/a/b9?x", "http://h/a", "http://h/a/", "https://g//x#f", "none", None, "http://h/a/b9/c"]
    got = {r.node: (r.parent, r.title, r.depth, r.n_pages, r.n_children, r.position) for r in site.navigation(spark.createDataFrame([(u,) for u in urls], "u string"), "u").collect()}
    assert got == {"h": (None, "h", 1, 5, 1, 2), "g": (None, "g", 1, 1, 1, 1), "h/a": ("h", "a", 2, 5, 2, 1), "h/a/b9": ("h/a", "b9", 3, 2, 1, 1), "h/a/b10": ("h/a", "b10", 3, 1, 0, 2), "h/a/b9/c": ("h/a/b9", "c", 4, 1, 0, 1), "g/x": ("g", "x", 2, 1, 0, 1)}
    assert site.navigation(spark.createDataFrame([], "u string"), "u").count() == 0
