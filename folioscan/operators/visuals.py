"""Visual references in HTML, outside regions whose text is only shown, and texts without them.

A page is cut at its tags in the JVM; a window over its tags has the running
place, line and depth of inert regions. References at depth 0 are active.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Elements whose content is inert, those that refer to an image, and those whose srcset counts too.
INERT = ("pre", "code", "script", "style")
VISUAL = ("img", "embed", "object")
SETS = (*VISUAL, "source")
#: Comments and elements of raw text are one tag each; any other tag ends at the first > outside quotes.
TAG = r"(?is)<!--.*?(?:-->|\z)|<(?:script|style)\b[^>]*>.*?(?:</(?:script|style)\s*>|\z)|</?[a-z][^\s/>\"']*(?:\"[^\"]*\"|'[^']*'|[^'\">])*>"
#: What takes the place of an active reference.
FIGURE = "[Figure]"


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, with or without quotes, entities of markup resolved; null if it has none."""
    form = rf"(?is)\A<[^\s/>]+(?:\"[^\"]*\"|'[^']*'|[^'\">])*?\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    value = F.concat(*[F.regexp_extract(tag, form, k) for k in (1, 2, 3)])
    for entity, sign in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        value = F.replace(value, F.lit(entity), F.lit(sign))
    return F.when(tag.rlike(form), value)


def local_asset(target: Column) -> Column:
    """The path inside the source's folder that a target names: backslashes before \\ ( ) and blanks go, per cent signs are decoded.

    Null for a target with a scheme or a host, or without a path. A per cent
    sign without two hexadecimal digits stays, and + is no blank.
    """
    plain = F.regexp_replace(target, r"\\([\\() ])", "$1")
    path = F.regexp_extract(F.regexp_replace(plain, r"\A//(?=/)", ""), r"(?s)\A([^?#]*)", 1)
    kept = F.replace(F.regexp_replace(path, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    foreign = plain.rlike(r"\A[A-Za-z][A-Za-z0-9+.\-]*:") | plain.rlike(r"\A//[^/?#]")
    return F.when(~foreign & (path != ""), F.try_url_decode(kept))


def tags(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """row, id, k, before (text before the tag), tag, name, closes, at (0-based), line, depth: every tag of every page, and a last row without a tag.

    depth: how many inert elements are open where the tag stands, before an
    opening tag counts; a closing tag too many doesn't count. Elements of raw
    text (script, style) are one tag each and change no depth. Null pages have
    no tags. row tells rows with equal ids apart.
    """
    html = F.col(f"`{html_col}`").cast("string")
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.split(html, TAG, -1).alias("texts"), F.regexp_extract_all(html, F.lit(TAG), F.lit(0)).alias("tags")).where("texts IS NOT NULL")
    each = rows.select("row", "id", F.posexplode(F.arrays_zip("texts", "tags")).alias("k", "part")).select("row", "id", "k", F.col("part.texts").alias("before"), F.coalesce("part.tags", F.lit("")).alias("tag"))
    named = each.withColumn("name", F.lower(F.regexp_extract("tag", r"(?s)\A</?([A-Za-z][^\s/>]*)", 1))).withColumn("closes", F.startswith("tag", F.lit("</")))
    inert = F.col("name").isin(*INERT) & ~F.col("name").isin("script", "style")
    step = F.when(~inert, 0).when(F.col("closes"), -1).otherwise(1)
    width, breaks = F.length("before") + F.length("tag"), F.length(F.regexp_replace(F.concat("before", "tag"), "[^\n]", ""))
    w = Window.partitionBy("row").orderBy("k")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    sums = named.withColumns({"step": step, "at": F.coalesce(F.sum(width).over(past), F.lit(0)) + F.length("before"), "line": F.coalesce(F.sum(breaks).over(past), F.lit(0)) + F.length(F.regexp_replace("before", "[^\n]", "")) + 1})
    # closing tags too many are those by which the sum falls below its least value so far
    open_ = sums.withColumn("sum", F.coalesce(F.sum("step").over(past), F.lit(0)))
    depth = F.col("sum") - F.least(F.min("sum").over(w), F.lit(0))
    return open_.select("row", "id", "k", "before", "tag", "name", "closes", "at", "line", depth.alias("depth"))


def _references(found: DataFrame) -> DataFrame:
    """tags with refs: for active ones an array of struct<syntax, target, caption, required>, empty for others."""
    tag = F.col("tag")
    active = (F.col("depth") == 0) & ~F.col("closes")
    source = F.when(F.col("name") == "object", attribute(tag, "data")).when(F.col("name").isin("img", "embed"), attribute(tag, "src"))
    required = ~F.coalesce(attribute(tag, "data-optional") == "true", F.lit(False))
    first = F.when(F.coalesce(source != "", F.lit(False)), F.struct(F.col("name").alias("syntax"), source.alias("target"), F.coalesce(attribute(tag, "alt"), attribute(tag, "title"), F.lit("")).alias("caption"), required.alias("required")))
    many = F.when(F.col("name").isin(*SETS), attribute(tag, "srcset"))
    other = F.when(many.isNotNull(), F.struct(F.lit("srcset").alias("syntax"), many.alias("target"), F.lit("").alias("caption"), required.alias("required")))
    visual = active & F.col("name").isin(*SETS)
    return found.withColumn("refs", F.when(visual, F.array_compact(F.array(first, other))).otherwise(F.array_compact(F.array(F.when(F.lit(False), first)))))


def page_visuals(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, at, line, syntax, target, caption, required, local (path, null if the target is foreign): the active references of every page."""
    refs = _references(tags(pages, id_col, html_col)).where(F.size("refs") > 0)
    each = refs.select("id", "at", "line", F.explode("refs").alias("ref")).select("id", "at", "line", "ref.*")
    return each.withColumn("local", local_asset(F.col("target")))


def stitched(text: Column, edits: Column) -> Column:
    """text with edits (array of struct<start, end, value>, 0-based, sorted and apart) applied: what lies between them is kept."""
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(edits, lambda e: e["end"].cast("long")))
    parts = F.transform(edits, lambda e, i: F.concat(F.substring(text, F.get(ends, i).cast("int") + 1, (e["start"] - F.get(ends, i)).cast("int")), e["value"]))
    return F.concat(F.array_join(parts, ""), F.substring(text, F.element_at(ends, -1).cast("int") + 1, F.length(text)))


def visual_edits(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """row, id, start, end, value: active references become [Figure], and the end of an active object goes with it.

    An </object> ends the last object that is open, whatever its depth was.
    """
    found = _references(tags(pages, id_col, html_col))
    own = found.where(F.size("refs") > 0).select("row", "id", "k", F.col("at").alias("start"), (F.col("at") + F.length("tag")).alias("end"), F.lit(FIGURE).alias("value"))
    # objects pair like brackets: an opening at nesting n is ended by the first closing after it that leaves n again
    w = Window.partitionBy("row").orderBy("k")
    objects = found.where("name = 'object'").withColumn("step", F.when(F.col("closes"), -1).otherwise(1)).withColumn("sum", F.sum("step").over(w))
    least = F.coalesce(F.least(F.min("sum").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lit(0))
    nested = objects.withColumn("level", F.when(F.col("closes"), F.col("sum") + 1).otherwise(F.col("sum"))).withColumn("stray", F.col("closes") & (F.col("sum") < least)).where("NOT stray")
    pairs = nested.withColumn("opened", F.lag(F.when(~F.col("closes"), F.size("refs") > 0)).over(Window.partitionBy("row", "level").orderBy("k")))
    ends = pairs.where("closes AND opened").select("row", "id", "k", F.col("at").alias("start"), (F.col("at") + F.length("tag")).alias("end"), F.lit("").alias("value"))
    return own.unionByName(ends)


def without_visuals(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, text, n_edits for every page that isn't null: its text with the active references taken out."""
    html = F.col(f"`{html_col}`").cast("string")
    edits = visual_edits(pages, id_col, html_col).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "value"))).alias("edits"))
    texts = pages.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), html.alias("html")).where("html IS NOT NULL")
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return texts.join(edits, "row", "left").select("id", stitched(F.col("html"), F.coalesce("edits", none)).alias("text"), F.size(F.coalesce("edits", none)).cast("long").alias("n_edits"))
