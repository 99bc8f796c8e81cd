"""Operators on small tables."""

from pyspark.sql import functions as F

from folioscan.functions import text as T
from folioscan.operators import checks, coverage, grounding, identity, journal, ledger, reading, wiki, witness


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_grounding_of_claims(spark):
    sources = spark.createDataFrame([("s1", ""), ("s2", "Arms and the man I sing, who first"), ("s3", "other")], "source_id string, text string")
    claims = spark.createDataFrame([("ok", ["s1", "s2"], "ARMS and"), ("first only", ["s3", "s2"], "arms and"), ("none", ["s1", "s9"], "x"), ("empty", ["s2"], "..."), ("null", ["s2"], None)], "claim_id string, source_ids array<string>, excerpt string")
    assert {r[0]: r[1] for r in rows(grounding.grounding_failures(claims, sources))} == {"first only": "excerpt not found in snapshot", "none": "no snapshot for source_ids", "empty": "excerpt not found in snapshot", "null": "excerpt not found in snapshot"}
    assert "empty" not in {r[0] for r in rows(grounding.grounding_failures(claims, sources, strict=False))}


def test_containment_in_blocks(spark):
    sources = spark.createDataFrame([(i, f"Text — number {i} of “many”") for i in range(30)] + [(99, None)], "id long, text string")
    quotes = spark.createDataFrame([("a", "number 1"), ("b", 'of "many"'), ("c", ""), ("d", None), ("e", "absent")], "q string, quote string")
    whole = rows(grounding.containment_pairs(sources, quotes, "id", "text", "q", "quote"))
    assert whole == sorted([(i, "b") for i in range(30)] + [(i, "a") for i in (1, *range(10, 20))], key=repr)
    assert rows(grounding.containment_pairs(sources, quotes, "id", "text", "q", "quote", block_bytes=4)) == whole


def test_occurrences(spark):
    df = spark.createDataFrame([("aXbXc", "X"), ("aaa", "aa"), ("abc", "z"), ("abc", "b")], "t string, q string")
    assert [(r.at, r.unique) for r in grounding.occurrences(df, "t", "q").collect()] == [(2, False), (1, False), (0, False), (2, True)]


def test_ledger(spark):
    claims = spark.createDataFrame([("c1", ["s1"], "supports", 0.5, "d1"), ("c1", ["s9"], "says", 2.0, "d2"), (" ", [], "qualifies", None, None)], "claim_id string, source_ids array<string>, stance string, confidence double, source_revision string")
    sources = spark.createDataFrame([("s1", "d1"), ("s1", "d1")], "source_id string, sha256 string")
    found = rows(ledger.ledger_violations(claims, sources))
    assert ("duplicate claim_id", "c1") in found and ("duplicate source_id", "s1") in found and ("bad stance", "c1") in found
    assert ("unknown source_id", "c1") in found and ("bad confidence", " ") in found and ("no source_ids", " ") in found and ("missing claim_id", " ") in found
    assert checks.decision(spark.createDataFrame([], "check string, subject_id string"), claims=claims).collect()[0].valid


def test_identity(spark):
    claims = spark.createDataFrame([("w", 2, "b"), ("w", 1, "a")], "worker string, pos int, excerpt string")
    assert {r.pos: r.claim_id for r in identity.ordinal_ids(claims, "worker", "pos").collect()} == {1: "c-w-1", 2: "c-w-2"}
    events = spark.createDataFrame([("c1", 1, "repair", "x"), ("c1", 2, "repair", "y"), ("c2", 1, "drop", None), ("c3", 1, "accepted", None)], "claim_id string, seq int, event string, new_excerpt string")
    live = spark.createDataFrame([("c1", "o"), ("c2", "o"), ("c3", "o")], "claim_id string, excerpt string")
    assert rows(identity.replay(live, events)) == [("c1", "y"), ("c3", "o")]
    drops = spark.createDataFrame([("c2",)], "claim_id string")
    assert rows(identity.unaccounted(live, live.where("claim_id = 'c1'"), drops)) == [("c3", "left")]
    ledger_rows = spark.createDataFrame([(1, "c1", "t", "s", "f", "old", "r0"), (2, "c2", "t", "s", "f", "old", "r0"), (3, "c3", "t", "s", "f", "old", "r0")], "pos int, claim_id string, claim string, stance string, source_file string, excerpt string, packet_state_revision string")
    now = spark.createDataFrame([("c1", "t", "s", "f", "new", "r1"), ("c3", "changed", "s", "f", "new", "r1"), ("c4", "t", "s", "f", "new", "r1")], "claim_id string, claim string, stance string, source_file string, excerpt string, packet_state_revision string")
    kept, bad = identity.synchronised(ledger_rows, now, drops)
    assert {r.claim_id: r.excerpt for r in kept.collect()} == {"c1": "new", "c3": "new"}
    assert rows(bad) == [("immutable field differs", "c3"), ("live claim has no ledger row", "c4")]
    failures = spark.createDataFrame([("w", 1, "x"), ("w", 2, "y"), ("v", 1, "z")], "worker string, pos int, binding string")
    assert rows(identity.packet_bindings(failures)) == [("v", "z", False), ("w", "x", True)]
    a, b = spark.createDataFrame([(1, "p"), (2, "q")], "o int, v string"), spark.createDataFrame([(5, "p")], "o int, v string")
    assert rows(identity.positional_differences(a, b, "o", "v")) == [(2, "q", None)]
    reported = spark.createDataFrame([("w", "old-1"), ("w", "zz")], "worker string, alias string")
    aliases = spark.createDataFrame([("w", "old-1", "c-w-1")], "worker string, alias string, claim_id string")
    named = spark.createDataFrame([("w", "c-w-1")], "worker string, claim_id string")
    assert rows(identity.report_targets(reported, named, aliases)) == [("w", "old-1", "c-w-1", 1), ("w", "zz", None, 0)]


def test_drop_events(spark):
    schema = "claim_id string, event string, source_file string, source_revision string, new_excerpt string, reason string, attempt_id string, state_before string, state_after string"
    events = spark.createDataFrame([("a", "drop", "f", "r", None, "why", "1", "x", "y"), ("b", "drop", "g", "r", "t", " ", None, "x", "x")], schema)
    bound = spark.createDataFrame([("a", "f", "r"), ("b", "f", "r")], "claim_id string, source_file string, source_revision string")
    assert {r.check for r in identity.drop_violations(events, bound).collect()} == {"binding differs", "drop has an excerpt", "no reason", "no attempt", "state unchanged"}


def test_reading(spark):
    spans = spark.createDataFrame([("d", 1, 4), ("d", 4, 6), ("e", 2, 5), ("e", 4, 9)], "doc string, first long, last long")
    ends = spark.createDataFrame([("d", 6), ("e", 8)], "doc string, end long")
    assert rows(reading.coverage_gaps(spans, "doc", "first", "last", ends, "end")) == [("e", "ends elsewhere", 9), ("e", "gap or overlap", 4), ("e", "starts late", 2)]
    assert [r.first for r in reading.overlaps(spans, ["doc"], "first", "last").collect()] == [4]
    parts = spark.createDataFrame([("d", i, t) for i, t in enumerate([5, 5, 30, 2, 0, 9, 1])], "doc string, pos long, tokens long")
    packed = sorted((r.pos, r.reading) for r in reading.packed(parts, "doc", "pos", "tokens", 12).collect())
    assert [g for _, g in packed] == [0, 0, 1, 2, 2, 2, 2]
    claims = spark.createDataFrame([("c1", "r", "f", "xy"), ("c2", "r", "f", "a"), ("c3", "r", "g", "xy")], "claim_id string, reading_id string, source_file string, excerpt string")
    held = spark.createDataFrame([("r", "f", "axyb"), ("r", "f", "a")], "reading_id string, source_file string, body string")
    assert rows(reading.bindings(claims, held)) == [("c1", 1), ("c2", 2), ("c3", 0)]
    quote = spark.createDataFrame([("αβγ ok", 5, "ok")], "t string, at int, q string").select(*[c.alias(k) for k, c in reading.quote_bytes(F.col("t"), F.col("at"), F.col("q")).items()])
    assert rows(quote) == [(7, 9)]
    works = spark.createDataFrame([("w", ["Title", "None"])], "work_id string, values array<string>")
    evidence = spark.createDataFrame([("w", 2, "tle"), ("w", 1, "a Ti")], "work_id string, pos int, body string")
    assert rows(reading.missing_bibliography(works, evidence)) == [("w", "None")]


def test_wiki(spark):
    lines = spark.createDataFrame([("p", i, x) for i, x in enumerate(["# T", "- [[b10]]", "- [[B2|x]]", "text", "- [[z]]", "- [[a]]", "end"])], "page string, at int, body string")
    out = [r.body for r in wiki.sorted_bullets(lines, "page", "at", "body").orderBy("at").collect()]
    assert out == ["# T", "- [[B2|x]]", "- [[b10]]", "text", "- [[a]]", "- [[z]]", "end"]
    links = spark.createDataFrame([("p", "a/original/x.md", "L1-L2"), ("p", "a/original/x.md", "L9"), ("p", "b/original/y.md", None), ("p", "c.md", None)], "path string, file string, fragment string")
    frozen = spark.createDataFrame([("a/original/x.md", "L1-L2")], "file string, fragment string")
    assert [(r.fragment, r.check) for r in wiki.foreign_citations(links, frozen).collect()] == [("L9", "not a frozen section"), (None, "not in the reading plan")]
    df = spark.createDataFrame([("see [[a/b|t]] and [[c#d]]",)], "t string").select(wiki.relative_links(F.col("t")).alias("x"))
    assert df.first().x == "see [t](a/b.md) and [c](c.md)"


def test_journal(spark):
    df = spark.createDataFrame([(401, "x"), (429, "x"), (500, "x"), (404, "x"), (None, "ReadTimeout"), (None, "ConnectError"), (None, None)], "s int, k string")
    assert [r.c for r in df.select(journal.error_class(F.col("s"), F.col("k")).alias("c")).collect()] == ["authentication", "rate_limited", "unavailable", "invalid_request", "timeout", "unavailable", "failed"]
    u = spark.createDataFrame([(1, 2, None), (1, None, None), (1, 2, 9), (-1, 2, None)], "p int, c int, t int").select(journal.usage(F.col("p"), F.col("c"), F.col("t")).alias("u"))
    assert [r.u for r in u.collect()] == [3, None, 9, None]
    units = spark.createDataFrame([(i, f"u{i}", "i", "o") for i in range(4)], "pos int, unit_id string, input_sha256 string, output_sha256 string")
    done = units.where("pos < 3").withColumn("output_sha256", F.when(F.col("pos") == 2, "z").otherwise("o"))
    assert [r.skip for r in journal.resumable(done, units).orderBy("pos").collect()] == [True, True, False, False]
    profiles = spark.createDataFrame([(["a", "b"], i) for i in range(4)], "p array<string>, i int").select(journal.fallback(F.col("p"), F.col("i")).alias("f"))
    assert [r.f for r in profiles.collect()] == ["a", "b", "b", "b"]


def test_coverage_and_witness(spark):
    listing = lambda *x: spark.createDataFrame(list(x), "path string, sha256 string")
    assert rows(checks.tree_changes(listing(("a", "1"), ("b", "1")), listing(("b", "2"), ("c", "1")), "path", "sha256")) == [("a", "removed"), ("b", "changed"), ("c", "added")]
    required = spark.createDataFrame([("a",), ("b",), ("z",)], "path string")
    assert rows(coverage.required_outputs(required, listing(("a", "1"), ("b", "1")), listing(("a", "1"), ("b", "2")))) == [("b", "digest differs"), ("z", "missing")]
    note = lambda *x: spark.createDataFrame(list(x), "source_file string, note string")
    assert rows(coverage.overlaid_notes(note(("a", "1"), ("b", "1")), note(("b", "2"), ("c", "2")), note(("c", "3")))) == [("a", "1"), ("b", "2"), ("c", "3")]
    claims = spark.createDataFrame([("c1",), ("c2",), ("c3",)], "claim_id string")
    candidates = spark.createDataFrame([("c1", 0, "x"), ("c1", 1, "y"), ("c2", 0, "z")], "claim_id string, pos int, excerpt string")
    choices = spark.createDataFrame([("c1", 1, 0), ("c1", 2, 1), ("c2", 1, 7)], "claim_id string, seq int, pos int")
    assert rows(witness.assembled(claims, candidates, choices)) == [("c1", "y"), ("c2", "z")]
    assert T is not None
