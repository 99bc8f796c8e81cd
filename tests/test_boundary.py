"""Checks where data enter, on odd rows."""

from pyspark.sql import functions as F

from folioscan.operators import boundary


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_store(spark):
    packets = spark.createDataFrame([("a", "r"), ("a", "r"), ("b", None), ("c", "")], "worker string, packet_revision string")
    claims = spark.createDataFrame([("a", "c-1"), ("b", "c-1"), ("b", "c-2")], "worker string, claim_id string")
    assert collected(boundary.store_defects(packets, claims)) == [("claim id is not unique", "c-1"), ("duplicate worker", "a"), ("no persisted identity", "b"), ("no persisted identity", "c")]


def test_conflicts(spark):
    df = spark.createDataFrame([([("a\n b", ["c \t d", None], " 1 \n 2 ")],), ([(None, None, None)],), (None,)], "c array<struct<source_file:string,source_files:array<string>,locator:string>>")
    got = [None if r[0] is None else [tuple(x) for x in r[0]] for r in df.select(boundary.normalised_conflicts(F.col("c"))).collect()]
    assert got == [[("ab", ["cd", None], "1 2")], [(None, None, None)], None]


def test_readings(spark):
    bindings = spark.createDataFrame([("r", "primary"), ("r", "context"), ("s", "context"), ("t", "primary"), ("t", "primary"), ("t", None)], "reading_id string, role string")
    readings = spark.createDataFrame([(x,) for x in "rstu"], "reading_id string")
    assert collected(boundary.reading_bounds(bindings, readings, 1, 2)) == [("s", "too few primary claims"), ("t", "too many claims"), ("u", "too few primary claims")]
    assert collected(boundary.reading_bounds(bindings, readings)) == [("s", "too few primary claims"), ("u", "too few primary claims")]
    assigned = spark.createDataFrame([("r", "context", 0, "x"), ("r", "primary", 1, "y"), ("r", "primary", 0, "z"), ("r", "primary", 2, "gone")], "reading_id string, role string, pos int, section_id string")
    sections = spark.createDataFrame([("x", "a.md", 1, 3, "X\n"), ("y", "b.md", 5, 6, None), ("z", "a.md", 3, 5, "Z\n")], "section_id string, source_file string, first int, last int, body string")
    assert boundary.reading_input(assigned, sections).first().text == "\n[PRIMARY SOURCE a.md L3-4]\nZ\n\n[PRIMARY SOURCE b.md L5-5]\n\n[CONTEXT SOURCE a.md L1-2]\nX\n"


def test_sources(spark):
    sources = spark.createDataFrame([("a", "markdown", 1, "s1"), ("b", "html", 2, "s2"), ("c", "markdown", 9, "s2"), ("d", None, None, None)], "source_file string, adapter string, work_id int, source_id string")
    works = spark.createDataFrame([(1,), (2,), (1,)], "work_id int")
    assert collected(boundary.reading_source_defects(sources, works)) == [("b", "ambiguous source id"), ("b", "not markdown"), ("c", "ambiguous source id"), ("c", "unknown work"), ("d", "no source id"), ("d", "not markdown"), ("d", "unknown work")]
    counts = sources.withColumn("translator", F.lit("x"))
    assert collected(boundary.identity_counts(counts)) == [(4, 2, 1, True)] and collected(boundary.identity_counts(counts.limit(0))) == [(0, 0, 0, False)]


def test_publication(spark):
    kind = "worker string, packet_revision string, packet_state_revision string, source_revision string"
    packets = spark.createDataFrame([("a", "1", "2", "3"), ("b", "1", None, "3"), ("c", "1", "2", "3"), ("d", "1", "2", "3")], kind)
    accepted = spark.createDataFrame([("a", "1", "2", "3"), ("b", "1", "2", "3"), ("c", "9", "2", "4")], kind)
    bundles = spark.createDataFrame([("x", "k", "k", "x"), ("y", "k", "j", None)], "name string, key string, stated_key string, stated_name string")
    got = collected(boundary.publication_drift(packets, accepted, bundles))
    assert got == [("b", "no accepted metadata"), ("c", "packet_revision drift"), ("c", "source_revision drift"), *[("d", f"{x} drift") for x in ("packet_revision", "packet_state_revision", "source_revision")], ("y", "bundle identity drift"), ("y", "source identity drift")]


def test_verdicts(spark):
    attempts = spark.createDataFrame([("a", 1, "nothing"), ("a", 2, "VERDICT: FAIL - x"), ("b", 3, "VERDICT: PASS"), ("b", 1, None), ("c", 2, "VERDICT: PASS late"), ("c", 1, "verified sound")], "step string, attempt int, reply string")
    assert collected(boundary.advisory_verdicts(attempts)) == [("a", 2, "FAIL", "x"), ("b", None, None, "no usable verdict"), ("c", 1, "PASS", "implicit positive attestation")]


def test_worker_outputs_and_fields(spark):
    one = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "worker string, check string")
    assert collected(boundary.worker_outputs(one, one.limit(0), one.where("worker = 'b'"))) == [("a", 2, False), ("b", 2, False)]
    projects = spark.createDataFrame([("p", "f"), ("q", "g")], "project string, field string")
    registry = spark.createDataFrame([("f", "/r", "d")], "field string, root string, description string")
    assert collected(boundary.field_roots(projects, registry)) == [("p", "f", "/r", "d"), ("q", "g", None, None)]
