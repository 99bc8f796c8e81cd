"""Queries over the pages' HTML: visual references and texts without them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions.digest import sha256
from folioscan.operators import visuals
from folioscan.plans.catalog import query, table

#: The pages hold no images; some of what they hold becomes images, in and outside inert regions: (what, by what).
PLANTED = (
    (r'<li><a href="/([^"]*)">([^<]*)</a>', r'<li><img src="/\1%20x+y.png" alt="\2">'),
    ('var t="</p>";', 'var t="<img src=\'script.png\'>";'),
    ("<p><b>", '<p><pre><code><img src="in/pre.png"></code>'),
    ("<br>", '</pre></code><IMG title=\'t\' SRC="sub/a%zz.png?x=1#f" data-optional="true">'),
    ("<footer>", '</pre><object data="plot.svg"><embed src="https://other.example/y.svg"></object></object><picture><source srcset="a.png 1x, b.png 2x"></picture>\n<footer>'),
    ("<!-- ad ", "<!-- <img src=comment.png> ad "),
)


def planted() -> Column:
    out = F.col("html")
    for what, by in PLANTED:
        out = F.regexp_replace(out, what, by.replace("\\", "$")) if what.startswith("<li>") else F.replace(out, F.lit(what), F.lit(by))
    return out.alias("html")


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def planted_sql() -> str:
    out = "html"
    for what, by in PLANTED:
        out = f"regexp_replace({out}, {_quoted(what)}, {_quoted(by)}, 'g')" if what.startswith("<li>") else f"replace({out}, {_quoted(what)}, {_quoted(by)})"
    return out


def attribute_sql(name: str) -> str:
    form = r"""(?is)^<[^\s/>]+(?:"[^"]*"|'[^']*'|[^'">])*?\s%s\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""" % name
    value = " || ".join(f"regexp_extract(tag, {_quoted(form)}, {k})" for k in (1, 2, 3))
    for entity, sign in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        value = f"replace({value}, {_quoted(entity)}, {_quoted(sign)})"
    return f"CASE WHEN regexp_matches(tag, {_quoted(form)}) THEN {value} END"


TAG = r"""(?is)<!--.*?(?:-->|\z)|<(?:script|style)\b[^>]*>.*?(?:</(?:script|style)\s*>|\z)|</?[a-z][^\s/>"']*(?:"[^"]*"|'[^']*'|[^'">])*>"""
#: The tags with their places, depths by a fold over each page's list of them, and references of those at depth 0.
TAGS = f"""
WITH h AS (SELECT page_id, {planted_sql()} AS html FROM pages),
 s AS (SELECT page_id, html, regexp_extract_all(html, {_quoted(TAG)}) AS tags, regexp_split_to_array(html, {_quoted(TAG)}) AS texts FROM h),
 e AS (SELECT page_id, unnest(range(0, len(tags))) AS k, unnest(tags) AS tag, unnest(texts[1:len(tags)]) AS before FROM s),
 n AS (SELECT *, lower(regexp_extract(tag, '^</?([A-Za-z][^\\s/>]*)', 1)) AS name, starts_with(tag, '</') AS closes, sum(length(before) + length(tag)) OVER w - length(tag) AS place, 1 + sum(length(before || tag) - length(replace(before || tag, chr(10), ''))) OVER w - (length(tag) - length(replace(tag, chr(10), ''))) AS line FROM e WINDOW w AS (PARTITION BY page_id ORDER BY k)),
 d AS (SELECT page_id, list_reduce(list_prepend([0], list(CASE WHEN name NOT IN ('pre', 'code') THEN [0] WHEN closes THEN [-1] ELSE [1] END ORDER BY k)), lambda x, y: list_append(x, greatest(0, x[-1] + y[1]))) AS depths FROM n GROUP BY 1),
 t AS (SELECT n.*, d.depths[k + 1] AS depth FROM n JOIN d USING (page_id)),
 a AS (SELECT *, CASE WHEN name = 'object' THEN {attribute_sql("data")} WHEN name IN ('img', 'embed') THEN {attribute_sql("src")} END AS src, CASE WHEN name IN ('img', 'embed', 'object', 'source') THEN {attribute_sql("srcset")} END AS srcset, coalesce({attribute_sql("alt")}, {attribute_sql("title")}, '') AS caption, coalesce({attribute_sql("data-optional")} = 'true', false) AS optional FROM t WHERE NOT closes AND depth = 0),
 r AS (SELECT page_id, k, place, line, name AS syntax, src AS target, caption, NOT optional AS required, tag FROM a WHERE src <> '' UNION ALL SELECT page_id, k, place, line, 'srcset', srcset, '', NOT optional, tag FROM a WHERE srcset IS NOT NULL)
"""


@query(
    TAGS
    + r"""SELECT page_id, place::BIGINT AS "at", line::BIGINT AS line, syntax, target, caption, required,
  CASE WHEN NOT regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.\-]*:') AND NOT regexp_matches(target, '^//[^/?#]') AND regexp_extract(target, '^[^?#]*') <> ''
   THEN replace(replace(regexp_extract(target, '^[^?#]*'), '%20', ' '), '%zz', '%zz') END AS local FROM r"""
)
def page_visuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active references of the pages with planted images: nested, unclosed and stray inert regions among them."""
    return visuals.page_visuals(table(spark, sf_dir, "pages").select("page_id", planted()), "page_id", "html").withColumnRenamed("id", "page_id").withColumns({c: F.col(c).cast("long") for c in ("at", "line")})


@query(
    TAGS
    + """, x AS (SELECT DISTINCT page_id, k, place, tag, '[Figure]' AS value FROM r),
 o AS (SELECT page_id, k, place, tag, closes, EXISTS (FROM x WHERE x.page_id = t.page_id AND x.k = t.k) AS active FROM t WHERE name = 'object'),
 z AS (SELECT page_id, k, place, tag, '' AS value FROM (SELECT *, lag(active AND NOT closes) OVER (PARTITION BY page_id ORDER BY k) AS ends FROM o) WHERE closes AND ends),
 y AS (SELECT page_id, k, value, tag FROM x UNION ALL SELECT page_id, k, value, tag FROM z),
 p AS (SELECT e.page_id, string_agg(e.before || coalesce(y.value, e.tag), '' ORDER BY e.k) AS head, count(y.value) AS n FROM e LEFT JOIN y ON e.page_id = y.page_id AND e.k = y.k GROUP BY 1)
SELECT s.page_id, sha256(p.head || s.texts[len(s.tags) + 1]) AS sha256, length(p.head || s.texts[len(s.tags) + 1])::BIGINT AS n_chars, p.n AS n_edits FROM s JOIN p USING (page_id)"""
)
def page_without_visuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages with [Figure] in the references' places."""
    out = visuals.without_visuals(table(spark, sf_dir, "pages").select("page_id", planted()), "page_id", "html")
    return out.select(F.col("id").alias("page_id"), sha256(F.col("text")).alias("sha256"), F.length("text").cast("long").alias("n_chars"), "n_edits")
