"""Reading plans and what is projected through them, on odd rows and by brute force."""

import random

from folioscan.operators import plan, reading


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_sections(spark):
    schema = "section_id string, source_file string, first int, last int, disposition string, reason string"
    sections = spark.createDataFrame([("a", "f", 1, 3, "primary", None), ("b", "f", 3, 5, "context", " "), ("c", "g", 2, 2, None, "r"), ("d", "g", None, 4, "excluded", "r")], schema)
    cuts = spark.createDataFrame([("f", 0), ("f", 2)], "source_file string, cut int")
    ends = spark.createDataFrame([("f", 5), ("g", 4), ("h", 2)], "source_file string, stop int")
    got = collected(plan.section_defects(sections, cuts, ends))
    assert [x for x in got if x[1] in "abfh"] == [("file", "h", "no sections"), ("section", "b", "edge inside a block"), ("section", "b", "no reason")]
    assert {x[2] for x in got if x[1] == "c"} == {"no range", "unknown disposition", "edge inside a block"}
    assert ("section", "d", "no range") in got
    assert collected(plan.section_defects(sections.limit(0), cuts, ends.limit(0))) == []


def test_assignments(spark):
    readings = spark.createDataFrame([("r1", 1), ("-x", 1), ("r2", 2), ("r2", 2)], "reading_id string, work_id int")
    assigned = spark.createDataFrame([("r1", "primary", "a"), ("r1", "context", "b"), ("r2", "primary", "a"), ("r2", "primary", "gone"), ("r1", "context", "x")], "reading_id string, role string, section_id string")
    sections = spark.createDataFrame([("a", "f", 1, 3, "primary"), ("b", "f", 2, 4, "context"), ("c", "f", 4, 5, "context"), ("x", "g", 1, 2, "excluded")], "section_id string, source_file string, first int, last int, disposition string")
    sources = spark.createDataFrame([("f", 1), ("g", 1)], "source_file string, work_id int")
    assert collected(plan.assignment_defects(readings, assigned, sections, sources)) == sorted([
        ("reading", "-x", "no primary section"), ("reading", "-x", "unsafe id"), ("reading", "r1", "sections overlap"), ("reading", "r2", "duplicate id"), ("reading", "r2", "primary section of another work"),
        ("reading", "r2", "unknown section"), ("section", "a", "not owned exactly once"), ("section", "c", "unused context"), ("section", "gone", "not owned exactly once"), ("section", "x", "excluded but used"),
    ], key=repr)


def test_projection(spark):
    assigned = spark.createDataFrame([("r", "primary", "s", 7, "id", "é arma aaa", 10), ("r", "context", "t", 7, "id", None, 50)], "reading_id string, role string, section_id string, work_id int, source_id string, body string, byte_start int")
    key = [("r", "primary", "s", 7), ("r", "context", "t", 7), ("r", "primary", "s", 8)]
    rows = [(1, *key[0], "id", "arma"), (2, *key[0], None, "aa"), (3, *key[0], "no", "arma"), (4, *key[0], "id", ""), (5, *key[0], "id", None), (6, *key[1], "id", "arma"), (7, *key[2], "id", "arma")]
    claims = spark.createDataFrame(rows, "claim_id int, reading_id string, role string, section_id string, work_id int, source_id string, excerpt string")
    bad = [(2, "quote ambiguous"), (3, "another source"), (4, "no excerpt"), (5, "no excerpt"), (6, "quote missing"), (7, "another assignment")]
    assert collected(plan.projected(claims, assigned)) == [(1, None, 7, 13, 17), *((k, check, None, None, None) for k, check in bad)]
    stored = claims.selectExpr("*", "CAST(7 AS int) AS independence_group", "CAST(13 AS bigint) AS byte_start", "CAST(17 AS bigint) AS byte_end")
    assert collected(plan.projection_drift(stored, assigned)) == bad
    assert collected(plan.projection_drift(stored.selectExpr("* EXCEPT (byte_end)", "CAST(18 AS bigint) AS byte_end").where("claim_id = 1"), assigned)) == [(1, "another place")]
    assert collected(plan.projection_drift(stored.selectExpr("* EXCEPT (independence_group)", "CAST(NULL AS int) AS independence_group").where("claim_id = 1"), assigned)) == [(1, "another group")]


def test_bindings(spark):
    live = [("w", "1", "f", "d", "d", None), ("w", "2", "g", "d", None, None), ("w", "3", "f", "d", "old", "[1]"), ("w", "4", "f", None, "d", None), ("w", "9", "f", "d", None, None)]
    claims = spark.createDataFrame(live, "worker string, claim_id string, source_file string, digest string, source_revision string, reading string")
    bindings = spark.createDataFrame([("w", "1", "f", "d", None), ("w", "2", "f", "d", None), ("w", "3", "f", "d", "[2]"), ("w", "4", "f", None, None)], "worker string, claim_id string, source_file string, source_revision string, reading string")
    originals = spark.createDataFrame([("w", "1"), ("w", "2"), ("w", "5")], "worker string, claim_id string")
    aliases = spark.createDataFrame([("w", "a", "1"), ("w", "b", "1"), ("w", "c", "8")], "worker string, alias string, target string")
    assert collected(plan.binding_defects(claims, bindings, originals, aliases)) == sorted([
        ("w", "2", "binding changed"), ("w", "3", "binding changed"), ("w", "3", "revision mismatch"), ("w", "4", "revision mismatch"), ("w", "5", "no saved binding"), ("w", "1", "several aliases"), ("w", "8", "alias of an unknown claim"),
    ], key=repr)


def test_reports(spark):
    failures = [("w", "1", True, "e", "r", None), ("w", "2", True, "was", "r", False), ("w", "3", True, None, "r", False), ("w", "3", True, None, "r", False), (None, "4", None, None, None, True), ("v", "5", True, None, "r", True), ("w", "6", True, None, "r", False)]
    f = spark.createDataFrame(failures, "worker string, claim_id string, has_excerpt boolean, old_excerpt string, reason string, applied boolean")
    claims = spark.createDataFrame([("1", "e"), ("2", "e"), ("3", None)], "claim_id string, excerpt string")
    bindings = spark.createDataFrame([("w", "x", False), ("p", None, None), ("q", "x", True), ("s", "old", None), ("u", "x", None)], "worker string, packet_revision string, incompatible boolean")
    packets = spark.createDataFrame([("w", "x"), ("p", "x"), ("q", "x"), ("s", "x")], "worker string, packet_revision string")
    assert collected(plan.report_defects(f, claims, bindings, packets)) == sorted([
        ("claim", "2", "excerpt stale"), ("claim", "3", "claim repeated"), ("claim", "4", "no identity fields"), ("claim", "5", "packet not bound"), ("claim", "6", "claim gone"),
        ("packet", "p", "no revision"), ("packet", "q", "incompatible revisions"), ("packet", "s", "stale revision"), ("packet", "u", "unknown packet"),
    ], key=repr)


def test_spans_by_brute_force(spark):
    draw = random.Random(5)

    def spans(n):
        return [(draw.randrange(2), x := draw.randrange(300), x + draw.choice((0, 1, 2, 3, 8, 9, 70, 250))) for _ in range(n)]

    a, b, points = spans(120), spans(120), [(draw.randrange(2), draw.randrange(320)) for _ in range(150)]
    left, right = (spark.createDataFrame(x, "doc int, first int, last int") for x in (a, b))
    want = sorted((d, f, x, g, y) for d, f, x in a for e, g, y in b if d == e and max(f, g) < min(x, y))
    assert sorted(map(tuple, reading.span_intersections(left, right, "doc").collect())) == want
    got = reading.point_in_span(spark.createDataFrame(points, "doc int, line int"), left, "doc", "line", "first", "last")
    assert sorted((r.doc, r.line, r.first, r["last"]) for r in got.collect()) == sorted((d, p, f, x) for d, p in points for e, f, x in a if d == e and f <= p < x)
    assert reading.span_intersections(left.limit(0), right, "doc").count() == 0


def test_readings_by_brute_force(spark):
    draw = random.Random(6)
    rows = [(d, k, draw.choice((0, 0, 1, 5, 9, 30, None))) for d in ("x", "y", None) for k in range(400)]
    want = []
    for d in ("x", "y", None):
        total, number = None, -1
        for _, k, n in (r for r in rows if r[0] == d):
            n = n or 0
            if total is None or (total > 0 and total + n > 20):
                total, number = n, number + 1
            else:
                total += n
            want.append((d, k, n, number))
    df = spark.createDataFrame(rows, "doc string, pos int, tokens int").repartition(3)
    assert collected(reading.packed(df, "doc", "pos", "tokens", 20)) == sorted(want, key=repr)
    assert reading.packed(df.limit(0), "doc", "pos", "tokens", 20).count() == 0
    # a group for each section of one long document
    long = spark.range(64_000).selectExpr("1 AS doc", "id AS pos", "500 AS tokens")
    assert reading.packed(long, "doc", "pos", "tokens", 600).agg({"reading": "max"}).first()[0] == 63_999


def test_bibliography(spark):
    rows = [("a", {"title": '"T"', "authors": '["x"]'}), ("b", {"title": "null", "authors": "null"}), ("", {"title": '" "', "authors": "[]"}), (None, None), ("e", {"title": "[1]", "authors": '"x"'}), ("f", {"authors": '["x", null]'}), ("g", {"title": '"T"', "authors": '[" "]'}), ("h", {"title": '"T"'})]
    got = collected(plan.bibliography_defects(spark.createDataFrame(rows, "work_id string, fields map<string,string>")))
    assert [x[1:] for x in got] == sorted([
        ("", "no identity"), ("", "title is no text"), ("", "authors are no list"), (None, "no identity"), (None, "no record"), ("e", "title is no text"), ("e", "authors are no list"), ("f", "title not stated"),
        ("f", "an author is no text"), ("g", "an author is no text"), ("h", "authors not stated"),
    ], key=lambda x: repr(("work", *x)))
