"""Scans, books, sinks and streams."""

import hashlib
import io
import json
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from folioscan.sources import epub, scan, sinks
from folioscan.streaming.journal import reservations

CONTAINER = '<container><rootfiles><rootfile full-path="OEBPS/book.opf"/></rootfiles></container>'
PACKAGE = """<package version="3.0" xmlns:dc="d"><metadata><dc:title>T<i>bar</i></dc:title><dc:title>U</dc:title><dc:language>en</dc:language></metadata>
<manifest><item id="a" href="ch1.xhtml" media-type="application/xhtml+xml"/><item id="b" href="ch2.xhtml" media-type="application/xhtml+xml"/><item id="i" href="images/chart.png" media-type="image/png"/></manifest>
<spine><itemref idref="a"/><itemref idref="b"/></spine></package>"""
ONE = '<html><head><title>no</title></head><body><h1 id="intro">Introduction</h1><p>Alpha <math>x=1</math> omega.</p><img src="images/chart.png"/><script>no</script></body></html>'
TWO = "<html><body><h2>Second</h2><p>Beta &lt;!--@@x--> text.</p></body></html>"
TEXT = """<!--@@chapter OEBPS/ch1.xhtml-->
<!--@@section OEBPS/ch1.xhtml#intro-->
# Introduction

Alpha <!--@@formula--> x=1 omega.

<!--@@asset OEBPS/images/chart.png-->

<!--@@chapter OEBPS/ch2.xhtml-->
<!--@@section OEBPS/ch2.xhtml#h1-->
## Second

Beta &lt;!--@@x--> text."""


def book(**change) -> bytes:
    parts = {"mimetype": "application/epub+zip", "META-INF/container.xml": CONTAINER, "OEBPS/book.opf": PACKAGE, "OEBPS/ch1.xhtml": ONE, "OEBPS/ch2.xhtml": TWO, "OEBPS/images/chart.png": "png"} | change
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in parts.items():
            if data is not None:
                z.writestr(zipfile.ZipInfo(name), data, zipfile.ZIP_STORED if name == "mimetype" else zipfile.ZIP_DEFLATED)
    return out.getvalue()


def test_book():
    text, found = epub.book_text(book())
    assert text == TEXT
    assert found.metadata == {"package_path": "OEBPS/book.opf", "spine_items": "2", "version": "3.0", "title": "T bar | U", "language": "en"} and found.assets == ["OEBPS/images/chart.png"]


@pytest.mark.parametrize(
    ("change", "error"),
    [
        ({"mimetype": "text"}, "mimetype"),
        ({"OEBPS/ch2.xhtml": ONE}, "duplicate spine content"),
        ({"OEBPS/ch2.xhtml": '<!DOCTYPE html [<!ENTITY e "x">]><html/>'}, "not allowed"),
        ({"OEBPS/ch2.xhtml": "<a>" * 200 + "</a>" * 200}, "deeply"),
        ({"OEBPS/images/chart.png": None}, "missing resource"),
        ({"OEBPS/ch1.xhtml": ONE.replace("images/", "../../")}, "unsafe resource"),
        ({"OEBPS/book.opf": PACKAGE.replace('idref="b"', 'idref="a"')}, "idref"),
        ({"OEBPS/ch2.xhtml": '<html><h1 id="x">a</h1><h2 id="x">b</h2></html>'}, "heading id"),
        ({"META-INF/container.xml": "<container/>"}, "exactly one package"),
    ],
)
def test_bad_books(change, error):
    with pytest.raises(epub.Invalid, match=error):
        epub.book_text(book(**change))


def test_all_faults_of_an_archive():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("bomb", b"0" * 5_000_000)
        with pytest.warns(UserWarning):
            z.writestr("bomb", b"0" * 5_000_000)
    with zipfile.ZipFile(io.BytesIO(out.getvalue())) as z:
        assert epub.archive_faults(z) == [("compression ratio too high", "bomb")] * 2 + [("duplicate member", "bomb"), ("the mimetype must come first, stored", "")]


@pytest.mark.parametrize(("href", "path"), [("a.png", "b/a.png"), ("./x/../a%20b.png#f", "b/a b.png"), ("../a", "a"), ("../../a", None), ("..", None), ("", None), ("/a", None), ("%2Fa", None), ("a?b", None), ("http://h/a", None), ("//h/a", None), ("a\\b", None), ("...", "b/...")])
def test_members(href, path):
    if path is None:
        with pytest.raises(epub.Invalid):
            epub.member("b/c.xhtml", href)
    else:
        assert epub.member("b/c.xhtml", href) == path


def test_folder(spark, tmp_path):
    files = {"a.html": b"<p>x &amp;lt; y", "b.MD": b"l1\r\nl2", "c.txt": "é".encode(), "d.epub": book(), "e.md": b"\xff", "f.pdf": b"no", "A.md": b"twin", "g.epub": b"no zip"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    found = scan.files(spark, str(tmp_path))
    assert {r.stem for r in scan.stem_clashes(found).collect()} == {"a"}
    got = {r.name: r for r in scan.representations(found).collect()}
    assert set(got) == set(files) - {"f.pdf"}
    assert (got["a.html"].text, got["b.MD"].text, got["c.txt"].text, got["d.epub"].text) == ("x < y", "l1\nl2", "é", TEXT)
    assert got["e.md"].error == "invalid UTF-8" and got["g.epub"].error == "not a zip archive"
    assert got["b.MD"].original_sha256 == hashlib.sha256(files["b.MD"]).hexdigest() and got["b.MD"].representation_sha256 == hashlib.sha256(b"l1\nl2").hexdigest()
    assert {r.path for r in scan.tree(spark, str(tmp_path)).collect()} == set(files)


def test_json_scans(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{bad\n[2]\n')
    assert [(r.line, r.valid) for r in scan.jsonl(spark, str(tmp_path / "x.jsonl")).orderBy("line").collect()] == [(1, True), (3, False), (4, True)]
    for w in ("worker-1", "worker-2"):
        (tmp_path / f"{w}.json").write_text(json.dumps({"worker": "named" if w[-1] == "2" else None, "n": 1}))
    assert {r.worker for r in scan.packets(spark, str(tmp_path), "worker string, n int").collect()} == {"worker-1", "named"}
    with sqlite3.connect(tmp_path / "j.db") as db:
        db.execute("CREATE TABLE attempts (id INTEGER, outcome TEXT)")
        db.executemany("INSERT INTO attempts VALUES (?, ?)", [(2, "b"), (1, "a")])
    assert [r.outcome for r in scan.journal(spark, str(tmp_path / "j.db"), "attempts").collect()] == ["a", "b"]


def test_evaluation(spark):
    lines = spark.createDataFrame([("f", i, f"line {i}") for i in range(1, 5)], "source_file string, line int, body string")
    items = spark.createDataFrame([("ok", "f", 2, 4, "line 3"), ("bad", "f", 1, 2, "line 3"), ("out", "f", 3, 9, "line 3"), ("two", "f", 1, 2, "line 1"), ("two", "f", 1, 2, "line 1")], "id string, source_file string, first int, last int, expected string")
    assert sorted(map(tuple, scan.evaluation_defects(items, lines).collect())) == [("bad", "expected text not in span"), ("out", "span outside file"), ("two", "duplicate id")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"c{i}") for i in range(5)], "pos int, claim_id string")
    none = rows.limit(0)
    sinks.write_ledger(rows, none, str(tmp_path / "claims"), "pos")
    assert spark.read.json(str(tmp_path / "claims")).count() == 5
    with pytest.raises(ValueError, match="without a note"):
        sinks.write_ledger(rows, rows, str(tmp_path / "x"), "pos")
    with pytest.raises(ValueError, match="survive"):
        sinks.write_ledger(none, none, str(tmp_path / "x"), "pos")
    for n in (5, 3):
        sinks.replace_table(rows.limit(n), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    found = spark.createDataFrame([("k", "a", "1"), ("k", "b", "2"), ("k", "c", "3")], "bundle_key string, name string, sha256 string")
    new, clash = sinks.new_snapshots(found, found.where("name <> 'c'").withColumn("sha256", F.when(F.col("name") == "b", "9").otherwise("1")))
    assert [r.name for r in new.collect()] == ["c"] and [r.name for r in clash.collect()] == ["b"]


def test_stream(spark, tmp_path):
    schema = "task long, attempt long, cost double, outcome string"
    src = tmp_path / "in"
    spark.createDataFrame([(1, 1, 5.0, "ok"), (1, 2, 6.0, "ok"), (2, 1, None, "ok")], schema).write.parquet(str(src))
    events = spark.readStream.schema(schema).parquet(str(src))
    q = reservations(events, 10.0).writeStream.format("memory").queryName("reserved").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    spark.createDataFrame([(1, 2, 6.0, "ok"), (2, 2, 20.0, "ok")], schema).write.mode("append").parquet(str(src))
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("reserved").collect())) == [(1, 1, 5.0, "ok"), (1, 2, 11.0, "budget_exhausted"), (2, 1, 0.0, "ok"), (2, 2, 20.0, "budget_exhausted")]


def test_journals_in_ranges(spark, tmp_path):
    from folioscan.sources import journal

    rows = [(i, f"r{i % 3}", None if i % 4 else 0.5 * i, '{"total_tokens": 3}' if i % 2 else None) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "id long, run string, cost double, usage string").repartition(3)
    folder = str(tmp_path / "j")
    journal.write_journals(df, folder, "attempts")
    back = journal.journals(spark, f"file://{folder}", "attempts", 10)
    assert back.schema.simpleString() == "struct<id:bigint,run:string,cost:double,usage:string>"
    assert sorted(map(tuple, back.collect())) == rows and back.rdd.getNumPartitions() > 8
    some = journal.journals(spark, folder, "attempts", 10, 41, 60)
    assert sorted(r.id for r in some.where("run = 'r1'").collect()) == [i for i in range(41, 61) if i % 3 == 1]
    assert 0 < some.rdd.getNumPartitions() < 12 and back.where("id > 1000").count() == 0
    assert journal.journals(spark, folder, "attempts", 10, 1000).count() == 0
    known = journal.history(back)
    assert known.where("unknown").count() == 50 and known.columns == ["id", "run", "cost", "prompt_tokens", "completion_tokens", "total_tokens", "unknown"]


def test_adapters(spark):
    from folioscan.sources import journal

    names = spark.createDataFrame([("a.HTML",), ("b.md",), ("c",), ("d.x.txt",)], "name string")
    registry = spark.createDataFrame([("html", ".html"), ("m", ".md"), ("n", ".md"), ("t", ".txt"), ("t", ".txt")], "adapter string, suffix string")
    assert sorted(map(tuple, journal.adapter_faults(names, registry).collect())) == [("b.md", "ambiguous"), ("c", "unsupported")]
