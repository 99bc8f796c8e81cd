"""Visual references against a parser that follows the rules tag by tag."""

import random
from html.parser import HTMLParser
from urllib.parse import unquote, urlsplit

import pytest
from pyspark.sql import functions as F

from folioscan.operators import visuals


class Brute(HTMLParser):
    """Depth by a counter, edits by places."""

    def __init__(self, text):
        super().__init__()
        self.depth, self.refs, self.edits, self.objects, self.source = 0, [], [], [], text
        self.starts = [0, *(i + 1 for i, c in enumerate(text) if c == "\n")]
        self.feed(text)

    def place(self):
        line, column = self.getpos()
        return self.starts[line - 1] + column

    def handle_starttag(self, tag, attrs):
        found = []
        if tag in ("pre", "code"):
            self.depth += 1
        if not self.depth and tag in ("img", "embed", "object", "source"):
            of = dict(attrs)
            required = of.get("data-optional") != "true"
            target = of.get("data" if tag == "object" else "src") if tag != "source" else None
            if target:
                found.append((tag, target, of.get("alt", of.get("title", "")), required))
            if of.get("srcset") is not None:
                found.append(("srcset", of["srcset"], "", required))
        at = self.place()
        self.refs += [(at, self.getpos()[0], *x) for x in found]
        if found:
            self.edits.append((at, at + len(self.get_starttag_text()), "[Figure]"))
        if tag == "object":
            self.objects.append(bool(found))

    def handle_endtag(self, tag):
        if tag in ("pre", "code"):
            self.depth = max(0, self.depth - 1)
        if tag == "object" and self.objects and self.objects.pop():
            at = self.place()
            self.edits.append((at, self.source.index(">", at) + 1, ""))

    def text(self):
        out, last = [], 0
        for a, b, value in self.edits:
            out += [self.source[last:a], value]
            last = b
        return "".join([*out, self.source[last:]])


PIECES = ["<pre>", "</pre>", "<code>", "</code >", "<PRE class='x>y'>", '<img src="a.png" alt="A &amp; B">', "<img src='b.png'/>", "<img alt='none'>", '<object data="o.svg">', "</object>", "<embed src=e.svg>", '<source srcset="s.png 2x">', '<img srcset="t.png" src="u.png" data-optional="true">',
          "<!-- <img src=c.png> -->", "<script>var a = '<img src=\"d.png\">';</script>", "<style>img{}</style>", "text é 日本", "\n", "a < b", "<p>", "</p>"]


@pytest.fixture(scope="module")
def pages():
    r = random.Random(3)
    return [(i, "".join(r.choices(PIECES, k=r.randrange(1, 30)))) for i in range(150)] + [(500, ""), (501, "no tags"), (502, "<pre><img src=x>"), (503, "</pre></code><img src=x>"), (504, "x" * 50_000 + "<img src=far.png>" * 300)]


def test_references(spark, pages):
    df = spark.createDataFrame([*pages, (600, None), (None, pages[0][1]), (0, pages[1][1])], "id long, html string").withColumn("row", F.lit("clash")).repartition(3)
    got = sorted(((r.id, r.at, r.line, r.syntax, r.target, r.caption, r.required) for r in visuals.page_visuals(df, "id", "html").collect()), key=repr)
    want = sorted(((i, *x) for i, html in [*pages, (None, pages[0][1]), (0, pages[1][1])] for x in Brute(html).refs), key=repr)
    assert got == want and len(want) > 300
    assert visuals.page_visuals(df.limit(0), "id", "html").count() == 0


def test_texts_without_references(spark, pages):
    got = {r.id: (r.text, r.n_edits) for r in visuals.without_visuals(spark.createDataFrame(pages, "id long, html string"), "id", "html").collect()}
    assert got == {i: ((b := Brute(html)).text(), len(b.edits)) for i, html in pages}


def brute_local(target):
    import re

    target = re.sub(r"\\([\\() ])", r"\1", target)
    url = urlsplit(target)
    return None if url.scheme or url.netloc else unquote(url.path) or None


TARGETS = ["a.png", "a%20b+c.png", "a\\ b\\(1\\).png", "http://x/y", "//host/p", "///p", "?q", "#f", "", "a?b#c", "mailto:x", "C:\\x", "1:b", "%zz%4", "%C3%A9", "../up", "a\\\\b", "x y"]


def test_local_assets(spark):
    df = spark.createDataFrame([(t,) for t in [*TARGETS, None]], "t string")
    got = {r.t: r.local for r in df.withColumn("local", visuals.local_asset(F.col("t"))).collect()}
    assert got == {t: brute_local(t) for t in TARGETS} | {None: None}


def test_stitched(spark):
    df = spark.createDataFrame([("añb日c", [(0, 1, "<"), (1, 1, "+"), (3, 5, "")]), ("x", []), ("x", None)], "t string, e array<struct<start:long,end:long,value:string>>")
    assert [r[0] for r in df.select(visuals.stitched(F.col("t"), F.col("e"))).collect()] == ["<+ñb", "x", None]
