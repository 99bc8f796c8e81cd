"""Scans of snapshots, ledgers and packets; representations and manifest binding."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions.digest import sha256
from folioscan.functions.text import BLOCK, HIDDEN, REFERENCE, markdown_text, unescape
from folioscan.functions.text import tidy
from folioscan.operators.checks import duplicates
from folioscan.sources.epub import epub

#: Adapter and version by suffix.
ADAPTERS = {".html": ("html", "1"), ".htm": ("html", "1"), ".md": ("markdown", "1"), ".epub": ("epub", "1"), ".txt": ("text", "1")}
REPRESENTATION = ("adapter", "adapter_version", "representation_encoding", "representation_sha256")


class _Visible(HTMLParser):
    def __init__(self):
        super().__init__()
        self.hidden, self.out = 0, []

    def handle_starttag(self, name, attributes):
        self.hidden += name in HIDDEN
        if name in BLOCK:
            self.out.append("\n")

    def handle_endtag(self, name):
        if name in HIDDEN:
            self.hidden = max(self.hidden - 1, 0)

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def parsed_html(page: Column) -> Column:
    """Visible text by the standard library's parser, before entities are decoded again and blanks tidied."""
    return F.pandas_udf(_parsed, "string")(page)


def _parsed(page: pd.Series) -> pd.Series:
    def one(text):
        if text is None:
            return None
        parser = _Visible()
        parser.feed(text)
        return "".join(parser.out)

    return page.map(one)


def html_by_parser(page: Column, closed: bool = False) -> Column:
    """The reference form of html_text(), for pages whose markup patterns might not cover; closed: see unescape()."""
    # an ampersand that begins no closed reference is written as one, which the parser turns back
    marked = F.regexp_replace(page, rf"&(?!{REFERENCE[1:]})", "&amp;") if closed else page
    return tidy(unescape(parsed_html(marked), closed))


def files(spark: SparkSession, folder: str) -> DataFrame:
    """path, name, suffix, adapter, adapter_version, content of the supported files of a folder (not below it)."""
    raw = spark.read.format("binaryFile").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    suffix = F.lower(F.regexp_extract(name, r"(\.[^.]+)\z", 1))
    known = F.create_map(*[F.lit(x) for k, (a, _) in ADAPTERS.items() for x in (k, a)])
    version = F.create_map(*[F.lit(x) for k, (_, v) in ADAPTERS.items() for x in (k, v)])
    return raw.select("path", name.alias("name"), suffix.alias("suffix"), known[suffix].alias("adapter"), version[suffix].alias("adapter_version"), "content").where("adapter IS NOT NULL")


def stem_clashes(found: DataFrame) -> DataFrame:
    """Stems, without regard to case, that several files share."""
    stem = F.lower(F.regexp_replace("name", r"\.[^.]+\z", ""))
    return duplicates(found.select(stem.alias("stem")), "stem")


def representations(found: DataFrame) -> DataFrame:
    """name, adapter, adapter_version, text, original_sha256, representation_sha256, assets, metadata, error.

    Bytes that aren't UTF-8 or no valid book give an error and no text, and
    don't fail the job.
    """
    decoded = F.try_validate_utf8(F.col("content").cast("string"))
    book = found.where("adapter = 'epub'").withColumn("book", epub("content"))
    flat = found.where("adapter <> 'epub'").withColumn("decoded", decoded)
    body = F.when(F.col("adapter") == "markdown", markdown_text(F.col("decoded"))).otherwise(F.col("decoded"))
    none, empty = F.lit(None).cast("array<string>"), F.lit(None).cast("map<string,string>")
    pages = flat.where("adapter = 'html'").withColumn("text", html_by_parser(F.col("decoded")))
    rest = flat.where("adapter <> 'html'").withColumn("text", body)
    error = F.when(F.col("decoded").isNull(), "invalid UTF-8")
    columns = ["name", "adapter", "adapter_version", "text", "assets", "metadata", "error", "content"]
    parts = [x.withColumns({"assets": none, "metadata": empty, "error": error}).select(*columns) for x in (pages, rest)]
    parts.append(book.select("name", "adapter", "adapter_version", "book.text", "book.assets", "book.metadata", "book.error", "content"))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.withColumns({"original_sha256": sha256(F.col("content")), "representation_sha256": sha256(F.col("text"))}).drop("content")


def bound(sources: DataFrame, manifest: DataFrame) -> DataFrame:
    """name, check of sources whose manifest row is missing, duplicate, of other bytes, incomplete or drifted.

    sources: name, original_sha256 and the REPRESENTATION columns; manifest:
    name, sha256 and the same columns, all or none of them.
    """
    m = manifest.groupBy("name").agg(F.count("*").alias("_fs_n"), F.first("sha256").alias("_fs_sha"), *[F.first(c).alias(f"_fs_{c}") for c in REPRESENTATION])
    j = sources.join(m, "name", "left")
    given = sum((F.col(f"_fs_{c}").isNotNull().cast("int") for c in REPRESENTATION[1:]), F.col(f"_fs_{REPRESENTATION[0]}").isNotNull().cast("int"))
    drift = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_fs_{c}")), F.lit(c)) for c in sorted(REPRESENTATION)]))
    check = (
        F.when(F.col("_fs_n").isNull(), "no manifest entry")
        .when(F.col("_fs_n") > 1, "duplicate manifest entry")
        .when(~F.col("_fs_sha").eqNullSafe(F.col("original_sha256")), "sha256 mismatch")
        .when((given > 0) & (given < len(REPRESENTATION)), "incomplete representation")
        .when((given > 0) & (F.size(drift) > 0), F.concat(F.lit("drift: "), F.array_join(drift, ",")))
    )
    return j.select("name", check.alias("check")).where("check IS NOT NULL")


def jsonl(spark: SparkSession, path: str) -> DataFrame:
    """file, line (1-based), raw, valid of a JSON-lines file; blank lines are skipped but counted."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r\n?|\n")).alias("at", "raw"))
    rows = whole.where(F.trim("raw") != "")
    return rows.select("file", (F.col("at") + 1).alias("line"), "raw", F.try_parse_json("raw").isNotNull().alias("valid"))


def packets(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Evidence packets worker-*.json with their worker (from the field, else the file's stem)."""
    found = spark.read.schema(schema).json(f"{folder}/worker-*.json", multiLine=True)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"\A(.*)\.json\z", 1)
    return found.withColumn("worker", F.coalesce("worker", stem) if "worker" in found.columns else stem)


def tree(spark: SparkSession, folder: str) -> DataFrame:
    """path below the folder, sha256 of all files in it and below, without .git."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    # the folder's own name ends the part of the path that is cut off
    root = folder.rstrip("/").rsplit("/", 1)[-1]
    path = F.regexp_extract("path", rf"/\Q{root}\E/(.*)\z", 1)
    return raw.select(path.alias("path"), sha256(F.col("content")).alias("sha256")).where(~F.col("path").rlike(r"(\A|/)\.git(/|\z)"))


def journal(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Rows of a SQLite journal's table in order of id, read by the driver in batches; a journal is a run's own small file."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        rows = pd.read_sql_query(f'SELECT * FROM "{table}" ORDER BY id', db)  # noqa: S608
    return spark.createDataFrame(rows)


def evaluation_defects(items: DataFrame, lines: DataFrame) -> DataFrame:
    """id, check of evaluation items: repeated ids, spans outside the file, expected text not in the span.

    items: id, source_file, first, last (1-based, end-exclusive), expected;
    lines: source_file, line, body.
    """
    ends = lines.groupBy("source_file").agg(F.max("line").alias("_fs_end"))
    held = items.join(lines, "source_file", "left").where(F.col("line").between(F.col("first"), F.col("last") - 1))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "body"))), lambda x: x["body"]), "")
    spans = held.groupBy("id").agg(body.alias("_fs_body"))
    j = items.join(ends, "source_file", "left").join(spans, "id", "left").join(duplicates(items, "id").select("id", F.lit(True).alias("_fs_twice")), "id", "left")
    outside = ~F.coalesce((F.col("first") >= 1) & (F.col("first") < F.col("last")) & (F.col("last") <= F.col("_fs_end") + 1), F.lit(False))
    check = F.when(F.col("_fs_twice"), "duplicate id").when(outside, "span outside file").when(~F.coalesce(F.col("_fs_body").contains(F.col("expected")), F.lit(False)), "expected text not in span")
    return j.select("id", check.alias("check")).where("check IS NOT NULL").distinct()
