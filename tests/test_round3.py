"""Faults that the review of round 3 found."""

import random

from pyspark.sql import functions as F

from folioscan.functions import text as T
from folioscan.operators import reading, reports
from folioscan.sources import scan


def test_open_references_stay(spark):
    pages = spark.createDataFrame([("<p>a &amp;&amp;&amp</p>b &copy; &quot &#65; &#66 &x</p>",)], "html string")
    got = pages.select(T.html_text(F.col("html"), closed=True), scan.html_by_parser(F.col("html"), closed=True), T.html_text(F.col("html")), scan.html_by_parser(F.col("html"))).first()
    assert got[0] == got[1] == "a &&&ampb © &quot A &#66 &x"
    assert got[2] == got[3] == 'a &&&b © " A B &x'


def test_a_common_alias_makes_no_pairs(spark):
    names = [(str(w), "p", f"c{w}") for w in range(50)] + [("0", "q", "c0"), ("1", "q", "c0"), ("2", "s", "c2")]
    legacy = spark.createDataFrame(names, "worker string, alias string, claim_id string")
    failures = spark.createDataFrame([(f"f{w}", "p", str(w), None) for w in range(50)] + [("p", "p", None, None), ("q", "q", None, None), ("s", "s", None, None), ("t", "s", "1", None)], "failure string, alias string, worker string, text string")
    none = legacy.where("false")
    got = reports.linked(failures, none.select("worker", "claim_id"), legacy, none.select("alias", "worker", "claim_id"))
    want = {(f"f{w}", f"c{w}", "legacy") for w in range(50)} | {("p", None, "ambiguous"), ("q", None, "ambiguous"), ("s", "c2", "legacy"), ("t", None, "unknown")}
    assert set(map(tuple, got.collect())) == want
    # workers meet by equality, not among all pairs with one alias
    assert " OR " not in got._jdf.queryExecution().optimizedPlan().toString()


def test_bindings_of_a_hot_reading(spark):
    """Bodies are scanned for all excerpts at once; before, each claim of a reading met each of its bodies in a join."""
    rng = random.Random(3)
    claims = [(k % 90, rng.choice(["r", "s", None]), rng.choice(["f", "g"]), rng.choice([None, "", "a", "A", "ab", "ba b", "b\n", "é", "zz"])) for k in range(120)]
    bodies = [(rng.choice(["r", "s", None]), rng.choice(["f", "g"]), rng.choice([None, "", "abab", "xba b\n", "éa", "AB", "abab"])) for _ in range(60)]
    frames = spark.createDataFrame(claims, "claim_id long, reading_id string, source_file string, excerpt string"), spark.createDataFrame(bodies, "reading_id string, source_file string, body string")
    want = {c[0]: 0 for c in claims}
    for i, r, f, x in claims:
        want[i] += sum(r is not None and (r, f) == b[:2] and x is not None and b[2] is not None and x in b[2] for b in bodies)
    found = reading.bindings(*frames)
    assert {r.claim_id: r.n_spans for r in found.collect()} == want and max(want.values()) > 5
    assert "Contains(" not in found._jdf.queryExecution().toString()
    empty = reading.bindings(frames[0].where("excerpt = ''"), frames[1]).collect()
    assert empty and all(r.n_spans >= 0 for r in empty)


def test_bodies_places_are_mostly_dropped_where_they_are_read(spark, monkeypatch):
    """F4, F16: every run of a body's words was shuffled for each width; results are the same with and without broadcasts."""
    import random

    from folioscan.operators import anchors

    r = random.Random(7)
    word = lambda: f"w{r.randrange(300)}"
    bodies = [(i, "\n".join(" ".join(word() for _ in range(r.randrange(3, 40))) for _ in range(8))) for i in range(40)]
    lines = sorted({x for _, text in bodies for x in text.split("\n")})
    t, b = spark.createDataFrame(list(enumerate(lines)), "tid long, text string"), spark.createDataFrame(bodies, "bid long, text string")
    want = {(k, i) for k, x in enumerate(lines) for i, text in bodies if x in text}
    kept = []
    plain = anchors.written
    monkeypatch.setattr(anchors, "discard", lambda *_: None, raising=False)
    monkeypatch.setattr(anchors, "written", lambda df: kept.append(plain(df)) or kept[-1])
    n_words = sum(len(text.split()) for _, text in bodies)
    for few in (getattr(anchors, "FEW", 0), 400, 0):
        monkeypatch.setattr(anchors, "FEW", few, raising=False)
        kept.clear()
        assert {tuple(x) for x in anchors.held(t, b, "tid", "text", "bid", "text").collect()} == want
        places = next(x for x in kept if x.columns == ["bid", "anchor"])
        assert places.count() < n_words / 3


def test_packet_attestations_shuffle_each_pair_of_names_once(spark):
    """entries were shuffled by worker and source for repeats and again for what is missing."""
    from folioscan.operators import attestation

    packets = spark.createDataFrame([("p", True), ("q", False), ("r", True)], "worker string, has_envelope boolean")
    entries = spark.createDataFrame([("p", "a", "1"), ("p", "a", "1"), ("p", None, "1"), ("q", "a", "2"), ("r", "b", "1")], "worker string, source_file string, v string")
    cited = spark.createDataFrame([("p", "a"), ("p", "c"), ("p", "c"), ("p", None), ("q", "z"), ("r", None)], "worker string, source_file string")
    now = spark.createDataFrame([("a", "1"), ("b", "1")], "source_file string, v string")
    out = attestation.packet_attestations(packets, entries, cited, now, ["v"])
    assert sorted(map(tuple, out.collect())) == [("p", "", "unknown source"), ("p", "a", "duplicate source"), ("p", "c", "missing source"), ("r", "", "missing source")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [worker#") <= 3


def test_assignment_defects_read_their_sections_once(spark):
    """the sections were derived again for every check that reads them; repeated ones count as before."""
    from folioscan.operators import plan

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    schema = "section_id string, source_file string, first int, last int, disposition string"
    sections = spark.createDataFrame([("a", "f", 1, 3, "primary"), ("a", "f", 5, 6, "primary"), ("b", "f", 2, 4, "context"), ("x", "g", 1, 2, "excluded")], schema).withColumn("disposition", counted("disposition"))
    readings = spark.createDataFrame([("r1", "w")], "reading_id string, work_id string")
    assigned = spark.createDataFrame([("r1", "primary", "a"), ("r1", "context", "x")], "reading_id string, role string, section_id string")
    sources = spark.createDataFrame([("f", "w"), ("g", "w")], "source_file string, work_id string")
    got = sorted(map(tuple, plan.assignment_defects(readings, assigned, sections, sources).collect()))
    assert got == [("section", "a", "not owned exactly once"), ("section", "b", "unused context"), ("section", "x", "excluded but used")]
    assert seen.value == 4


def test_json_is_opened_in_as_many_tasks_as_a_shuffle_has(spark):
    """a table in one file was opened by one task; empty containers keep their texts, others have none."""
    from folioscan.operators import variants

    texts = ["{}", "[]", "[null]", '{"a": [], "b": {}, "c": [null, []], "d": [{}]}', "[[null], {}]"] * 8
    df = spark.createDataFrame(list(enumerate(texts)), "id long, j string").coalesce(1)
    got = variants.flattened(df, "id", "j")
    assert got.select(F.input_file_name()).distinct().count() >= 4
    empty = sorted({(r["id"] % 5, r["path"], r["text"]) for r in got.where("kind IN ('object', 'array') AND text IS NOT NULL").collect()})
    assert empty == [(0, "", "{}"), (1, "", "[]"), (3, "/a", "[]"), (3, "/b", "{}"), (3, "/c/1", "[]"), (3, "/d/0", "{}"), (4, "/1", "{}")]
    whole = {r["id"] % 5: r["canonical"] for r in variants.canonical(df, "id", "j").collect()}
    assert whole == {0: "{}", 1: "[]", 2: "[null]", 3: '{"a":[],"b":{},"c":[null,[]],"d":[{}]}', 4: "[[null],{}]"}
