"""Checks over recorded compilation, inspection and publication results."""

from pyspark.sql import functions as F

from folioscan.operators import publication as P


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_assets(spark):
    assets = spark.createDataFrame([("a.png", "1"), ("b.png", "1"), ("b.png", "1"), ("c.png", "2")], "path string, sha256 string")
    specs = spark.createDataFrame([("a.png", "1"), ("b.png", "1"), ("c.png", "9"), ("d.png", "1"), ("../e.png", "1")], "path string, sha256 string")
    assert rows(P.visual_matches(specs, assets)) == [("../e.png", "unsafe path"), ("b.png", "several assets"), ("c.png", "digest differs"), ("d.png", "no asset")]
    refs = spark.createDataFrame([("a/b.PNG",), ("http://x/y.png",), ("/a.png",), ("a.svg",)], "p string")
    assert rows(P.bad_images(refs, "p")) == [("/a.png", "unsafe path"), ("a.svg", "suffix not allowed"), ("http://x/y.png", "not local")]


def test_units(spark):
    units = spark.createDataFrame([(0, "u0", "i"), (1, "u1", "i"), (2, "u2", "i"), (3, "u3", "i")], "pos int, unit_id string, input_sha256 string")
    done = spark.createDataFrame([(0, "u0", "i"), (1, "x", "i"), (2, "u2", "z"), (9, "u9", "i")], "pos int, unit_id string, input_sha256 string")
    assert rows(P.unit_outcomes(units, done)) == [(1, "other unit"), (2, "other input"), (3, "no outcome"), (9, "extra outcome")]
    planned = spark.createDataFrame([("create", "a.md"), ("update", "b.md"), ("create", "sum.md")], "action string, path string")
    pages = spark.createDataFrame([("a.md", "see [[sum]]"), ("b.md", "no"), ("sum.md", "")], "path string, text string")
    assert rows(P.completion(planned, planned.where("path <> 'b.md'"), pages, "sum.md")) == [("no backlink", "b.md"), ("planned and applied differ", "b.md")]
    assert ("no summary", "sum.md") in rows(P.completion(planned, planned, pages.where("path <> 'sum.md'"), "sum.md"))


def test_receipt(spark):
    receipt = spark.createDataFrame([("FAILED", "compile", " ")], "state string, operation string, target string")
    sources = spark.createDataFrame([("1",), ("2",)], "sha256 string")
    tree = spark.createDataFrame([("recorded", "a", "1"), ("actual", "a", "2")], "side string, path string, sha256 string")
    assert rows(P.receipt_violations(receipt, sources, sources.where("sha256 = '1'"), tree, ["compile"])) == [("no target", " "), ("not complete", "FAILED"), ("output changed", "a"), ("sources differ", "2")]


def test_inspections(spark):
    assets = spark.createDataFrame([("a", "1", True), ("b", "1", True), ("c", "1", False)], "asset string, sha256 string, required boolean")
    seen = spark.createDataFrame([("a", "1", "9", 5), ("z", "1", "1", 5)], "asset string, input_sha256 string, inspected_sha256 string, tokens int")
    assert rows(P.context_violations(seen, assets, 9)) == [("a", "digest differs"), ("b", "required but not inspected"), ("z", "unknown asset"), (None, "token budget")]
    listed = spark.createDataFrame([("k", "a"), ("k", "b"), ("m", "a")], "bundle_key string, asset string")
    calls = spark.createDataFrame([("k", "a", "r", ""), ("m", "a", "r", "note")], "bundle_key string, asset string, result string, note string")
    assert rows(P.inspected(calls, listed)) == [("k", "incomplete"), ("m", "complete")]


def test_files_and_citations(spark):
    names = spark.createDataFrame([("book1-ann.html",), ("book2-ann.html",), ("x.html",)], "name string")
    books, variants = spark.createDataFrame([(1,), (2,)], "book int"), spark.createDataFrame([("ann",), ("bob",)], "variant string")
    assert rows(P.snapshot_gaps(names, "name", r"\Abook(\d+)-(\w+)\.html\z", books, variants)) == [("missing witness file", "1/bob"), ("missing witness file", "2/bob"), ("unexpected file", "x.html")]
    reviewed = spark.createDataFrame([("a", "1"), ("b", "1")], "path string, sha256 string")
    assert rows(P.output_differences(reviewed, reviewed.withColumn("sha256", F.when(F.col("path") == "a", "2").otherwise("1")), reviewed.where("path = 'a'"))) == [("a", "after review: changed"), ("b", "not tracked")]
    sections = spark.createDataFrame([("s", "t", "# Head \nbody")], "section_id string, target string, body string")
    assert rows(P.citation_rows(sections)) == [("s", '{"section_id":"s","target":"t","heading":"# Head"}')]
    target = spark.range(1).select(P.citation_target(F.lit("k"), F.lit("a b/c+d.md"), F.lit(3), F.lit(9)).alias("t")).first().t
    assert target == "assets/k/original/a%20b/c%2Bd.md#L3-L8"
