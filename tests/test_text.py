"""Text functions: truth tables and fixtures."""

import pytest
from pyspark.sql import functions as F

from folioscan.functions import digest as D
from folioscan.functions import text as T

PARTED = 'he told them all that the ship was sound and ready. \' \n\n[302] "So I spoke; and they swore that they would all return before the spring. Then a long while afterward the wind blew, and my men began to plot among themselves."'


@pytest.mark.parametrize(
    ("quote", "want"),
    [
        ("he told them all that the ship was sound and ready. So I spoke; and they swore that they would", True),
        ("So I spoke; and they swore that they would all return before the spring. my men began to plot among themselves", False),
        ("he told them all that the ship was sound and ready. my men began to plot among themselves", False),
    ],
)
def test_elision(quote, want):
    hay = T.fold_text(PARTED)
    needle = T.fold_text(quote)
    assert (needle in hay or T.elided(needle, hay)) is want


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_fold_native_equals_python(spark):
    texts = ["a — b… “X” &amp;amp; ﬁ", "Ｆull　width", "x -\n- y", "“‘’‚‛„‟”", "‐‑‒–—―−", "     ", "&#39;q&quot;", "İSTANBUL ΣΑΣ", "", "tab\there"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.f for r in rows.select("i", T.fold(F.col("t")).alias("f")).collect()}
    assert got == {i: T.fold_text(t) for i, t in enumerate(texts)}


def test_scalars(spark):
    r = one(
        spark,
        book=T.canonical_book(F.lit("Aen.12.4")), none=T.canonical_book(F.lit("see Aen.1.1")), two=T.witness_book(F.lit(" 2 . 7")), four=T.witness_book(F.lit("book iv")), thirteen=T.witness_book(F.lit("BOOK XIII")),
        trim=T.trim_quotes(F.lit("'-ab-.\"")), fence=T.fence_length(F.lit("a ```` b `")), plain=T.fence_length(F.lit("x")),
        labels=T.labels(F.lit("[a] [B] [A]")), links=T.markdown_links(F.lit("[t](<x y>) ![q](z) [e]()")), wiki=F.transform(T.wikilinks(F.lit("[[a|b]] [[c#d]]")), lambda x: T.link_target(x)),
        lines=T.lines(F.lit("a\n\nb")), md=T.markdown_text(F.lit("a\r\nb\rc")), page=T.html_text(F.lit("<title>T</title><script>x</p></script><p>a &amp;amp; b<!-- c --><br/>d  e<b>f</b>")),
        marks=T.without_markers(F.lit("a<!--@@section c#d-->b")), unsafe=T.unsafe_path(F.lit("a/../b")), safe=T.unsafe_path(F.lit("a/b")), key=T.natural_key(F.lit("b10a02")), title=T.display_name(F.lit("the-book-07")),
    )
    assert (r.book, r.none, r.two, r.four, r.thirteen) == (12, None, 2, 4, None)
    assert (r.trim, r.fence, r.plain) == ("ab", 5, 3)
    assert r.labels == ["A", "B"] and r.links == ["x y", "z"] and r.wiki == ["a", "c"]
    assert r.lines == ["a\n", "\n", "b"] and r.md == "a\nb\nc" and r.page == "T\na & b\nd ef"
    assert (r.marks, r.unsafe, r.safe, r.title) == ("ab", True, False, "Book 7")
    assert r.key.startswith("b") and r.key.endswith("2")


@pytest.mark.parametrize(
    ("reply", "want"),
    [
        ("VERDICT: PASS - fine\nverdict: fail — two", ("FAIL", "two")),
        ("x\n  VERDICT: FAIL -", (None, "FAIL with no enumerated defect")),
        ("all verified clean", ("PASS", "implicit positive attestation")),
        ("verified clean but a defect", (None, "no usable VERDICT line or unambiguous positive attestation")),
        (None, (None, "no usable VERDICT line or unambiguous positive attestation")),
    ],
)
def test_verdict(spark, reply, want):
    assert tuple(one(spark, v=T.verdict(F.lit(reply).cast("string"))).v) == want


def test_digests(spark):
    import hashlib
    import json

    value = {"b": [1, None], "a": "é\"\n"}
    r = one(spark, j=D.canonical_json(F.lit(json.dumps(value))), bad=D.canonical_json(F.lit("{")), s=D.sha256(F.lit("é")), q=D.quoted(F.lit('a"b\n')))
    assert r.j == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) and r.bad is None
    assert r.s == hashlib.sha256("é".encode()).hexdigest() and r.q == '"a\\"b\\n"'
    rows = spark.createDataFrame([("b", "2" * 64, 0), ("a", "1" * 64, 1)], "p string, d string, o int")
    want = hashlib.sha256(b"b\0" + bytes.fromhex("2" * 64) + b"a\0" + bytes.fromhex("1" * 64)).hexdigest()
    assert rows.agg(D.bundle_digest(F.col("p"), F.col("d"), F.col("o")).alias("x")).first().x == want


def test_white_space_is_one_class(spark):
    """The native and the Python form of folding agree on every control and space character."""
    spaces = [chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
    texts = [f"a{x}{x} b{x}-{x}c" for x in spaces]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", T.fold(F.col("t")).alias("f"))
    assert {r.id: r.f for r in df.collect()} == {i: T.fold_text(t) for i, t in enumerate(texts)}
