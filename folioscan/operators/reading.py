"""Lines, sections, readings and their invariants."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from folioscan.functions.text import lines
from folioscan.operators.checks import multiset_differences
from folioscan.operators.grounding import containment_pairs


def document_lines(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """doc, line (1-based), body (with its terminator), start (0-based character of its first)."""
    each = docs.select(doc, F.posexplode(lines(F.col(text))).alias("at", "body"))
    before = Window.partitionBy(doc).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return each.select(doc, (F.col("at") + 1).alias("line"), "body", F.coalesce(F.sum(F.length("body")).over(before), F.lit(0)).alias("start"))


def sections(heads: DataFrame, doc: str, start: str, ends: DataFrame, end: str) -> DataFrame:
    """doc, first, last: 1-based, end-exclusive sections between the starting lines and the document's end line."""
    following = F.lead(start).over(Window.partitionBy(doc).orderBy(start))
    return heads.withColumn("last", following).join(ends.select(doc, F.col(end).alias("_fs_end")), doc).select(doc, F.col(start).alias("first"), F.coalesce("last", "_fs_end").alias("last"))


def coverage_gaps(spans: DataFrame, doc: str, first: str, last: str, ends: DataFrame, end: str) -> DataFrame:
    """doc, check, at of sections that don't cover their document line by line.

    Checks: "starts late" (not at line 1), "gap or overlap" (a section that
    doesn't start where the one before ends), "ends elsewhere".
    """
    order = Window.partitionBy(doc).orderBy(first, last)
    marked = spans.select(doc, first, last, F.lag(last).over(order).alias("_fs_last"), F.lead(first).over(order).alias("_fs_next"), F.row_number().over(order).alias("_fs_n"))
    joined = marked.join(ends.select(doc, F.col(end).alias("_fs_end")), doc)
    found = F.array_compact(F.array(
        F.when((F.col("_fs_n") == 1) & (F.col(first) != 1), F.struct(F.lit("starts late").alias("check"), F.col(first).cast("long").alias("at"))),
        F.when(F.col("_fs_last") != F.col(first), F.struct(F.lit("gap or overlap").alias("check"), F.col(first).cast("long").alias("at"))),
        F.when(F.col("_fs_next").isNull() & (F.col(last) != F.col("_fs_end")), F.struct(F.lit("ends elsewhere").alias("check"), F.col(last).cast("long").alias("at"))),
    ))
    return joined.select(doc, F.explode(found).alias("d")).select(doc, "d.check", "d.at")


def overlaps(spans: DataFrame, group: list[str], first: str, last: str) -> DataFrame:
    """Spans that start before an earlier one of their group ends (by start and end)."""
    before = F.lag(last).over(Window.partitionBy(*group).orderBy(first, last))
    return spans.withColumn("_fs_before", before).where(F.col("_fs_before") > F.col(first)).drop("_fs_before")


def packed(sections: DataFrame, doc: str, pos: str, tokens: str, target: int) -> DataFrame:
    """sections with reading (0-based): greedy groups in order, a new one when the sum would pass the target.

    A section above the target by itself stays whole; null tokens count as none.
    Where a group starts depends on the one before, so a document's sections
    go by in order within one task, sorted by Spark, which spills, and only the
    running sum and number are held: time is linear and memory bounded, however
    long a document is. Documents are dealt by hash; many share a task.
    """
    rows = sections.select(F.col(doc), F.col(pos).cast("long").alias(pos), F.coalesce(F.col(tokens).cast("long"), F.lit(0)).alias(tokens))
    kind = rows.schema[doc].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, reading = object(), 0, 0
        for batch in batches:
            numbers = []
            for d, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if d != current:
                    current, total, reading = d, n, 0
                elif total > 0 and total + n > target:
                    total, reading = n, reading + 1
                else:
                    total += n
                numbers.append(reading)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "reading"])

    ordered = rows.repartition(doc).sortWithinPartitions(doc, pos, tokens)
    return ordered.mapInArrow(run, f"`{doc}` {kind}, `{pos}` bigint, `{tokens}` bigint, reading bigint")


def with_tokens(rows: DataFrame, text: str, counter: Callable[[Column], Column], name: str = "tokens") -> DataFrame:
    """rows with the number of tokens of a text by a counter that is given; a null text counts as empty.

    The counter may be any column function: the size of a split, or an Arrow
    function over a tokenizer's vocabulary.
    """
    return rows.withColumn(name, counter(F.coalesce(F.col(text), F.lit(""))).cast("long"))


def running_groups(sections: DataFrame, doc: str, pos: str, tokens: str) -> DataFrame:
    """Sections with the tokens before them in their document."""
    before = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    return sections.withColumn("before", F.coalesce(F.sum(tokens).over(before), F.lit(0)))


def _level(first: str, last: str) -> Column:
    """The smallest k with 2**k lines for a span; such a span lies in at most two bins of that width."""
    return F.length(F.bin(F.greatest(F.col(last) - F.col(first) - 1, F.lit(0)).cast("long"))) * (F.col(last) - F.col(first) > 1).cast("int")


def _bins(first: Column, last: Column, level: Column) -> Column:
    """The bins of width 2**level that a span touches."""
    width = F.call_function("shiftleft", F.lit(1).cast("long"), level)
    return F.sequence(F.floor(first / width), F.floor((last - 1) / width))


def _levels(spans: DataFrame, first: str, last: str) -> DataFrame:
    """The different levels of all spans, at most 64 rows."""
    return F.broadcast(spans.select(_level(first, last).alias("_fs_level")).distinct())


def point_in_span(points: DataFrame, spans: DataFrame, doc: str, point: str, first: str, last: str) -> DataFrame:
    """Points with the span of the same document that holds them (first <= point < last).

    Joined by document, level and bin: a span of up to 2**k lines lies in at
    most two bins of level k, and a point in one bin of each level that there
    is, so a long document's points don't meet all of its spans.
    """
    own = spans.where(F.col(first) < F.col(last)).withColumn("_fs_level", _level(first, last)).withColumn("_fs_bin", F.explode(_bins(F.col(first), F.col(last), F.col("_fs_level"))))
    each = points.crossJoin(_levels(spans.where(F.col(first) < F.col(last)), first, last))
    each = each.withColumn("_fs_bin", F.floor(F.col(point) / F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_fs_level"))))
    met = each.join(own, [doc, "_fs_level", "_fs_bin"]).where((F.col(first) <= F.col(point)) & (F.col(point) < F.col(last)))
    return met.drop("_fs_level", "_fs_bin")


def span_intersections(a: DataFrame, b: DataFrame, doc: str) -> DataFrame:
    """Pairs of spans (first, last) of one document that share a line.

    The shorter span of a pair is looked up in the bins of the longer one's
    level, which both touch at most two of, and the pair counts in the bin
    where the later of them starts.
    """
    right = b.select(doc, F.col("first").alias("b_first"), F.col("last").alias("b_last"))
    left, right = a.where("first < last"), right.where("b_first < b_last")

    def dealt(rows: DataFrame, first: str, last: str, higher: DataFrame | None, least: int) -> DataFrame:
        """Rows by the bins of their own level, or of each level of the others that is higher by at least `least`."""
        if higher is None:
            rows = rows.withColumn("_fs_level", _level(first, last))
        else:
            rows = rows.withColumn("_fs_own", _level(first, last)).crossJoin(higher).where(F.col("_fs_level") >= F.col("_fs_own") + least).drop("_fs_own")
        return rows.withColumn("_fs_bin", F.explode(_bins(F.col(first), F.col(last), F.col("_fs_level"))))

    longer_a = dealt(left, "first", "last", None, 0).join(dealt(right, "b_first", "b_last", _levels(left, "first", "last"), 0), [doc, "_fs_level", "_fs_bin"])
    longer_b = dealt(left, "first", "last", _levels(right, "b_first", "b_last"), 1).join(dealt(right, "b_first", "b_last", None, 0), [doc, "_fs_level", "_fs_bin"])
    both = longer_a.unionByName(longer_b)
    start, width = F.greatest("first", "b_first"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_fs_level"))
    return both.where((start < F.least("last", "b_last")) & (F.floor(start / width) == F.col("_fs_bin"))).select(*a.columns, "b_first", "b_last")


def ownership(assigned: DataFrame, primary: DataFrame, section: str) -> DataFrame:
    """Sections that the readings don't hold exactly as often as the plan has them."""
    return multiset_differences(assigned, primary, section)


def context_defects(declared: DataFrame, used: DataFrame, excluded: DataFrame, section: str) -> DataFrame:
    """section, check: context that no reading uses, and excluded sections that one does."""
    idle = declared.select(section).distinct().join(used.select(section).distinct(), section, "left_anti").withColumn("check", F.lit("unused context"))
    wrong = used.select(section).distinct().join(excluded.select(section).distinct(), section, "left_semi").withColumn("check", F.lit("excluded but used"))
    return idle.unionByName(wrong)


def bindings(claims: DataFrame, assigned: DataFrame) -> DataFrame:
    """claim_id, n_spans: in how many assigned spans of its reading and file a claim's excerpt is; only one will do.

    claims: claim_id, reading_id, source_file, excerpt; assigned: reading_id,
    source_file, body. Each body is scanned once for all different excerpts
    (a block of bounded size at a time), not once for each claim of its reading.
    """
    keys = ["reading_id", "source_file"]
    excerpts = claims.where("excerpt <> ''").select("excerpt").distinct().withColumn("needle", F.col("excerpt"))
    spans = assigned.where("body IS NOT NULL").select(F.struct(*keys).alias("at"), "body")
    held = containment_pairs(spans, excerpts, "at", "body", "excerpt", "needle", folded=False).groupBy(*[F.col(f"at.{k}") for k in keys], "excerpt").agg(F.count("*").alias("n"))
    # an empty excerpt is in every body
    empty = spans.groupBy(*[F.col(f"at.{k}") for k in keys]).agg(F.count("*").alias("n")).select(*keys, F.lit("").alias("excerpt"), "n")
    return claims.join(held.unionByName(empty), [*keys, "excerpt"], "left").groupBy("claim_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_spans"))


def quote_bytes(text: Column, at: Column, quote: Column) -> dict[str, Column]:
    """Start and end in UTF-8 bytes of a quotation at a 1-based character place."""
    start = F.octet_length(F.substring(text, F.lit(1), (at - 1).cast("int")))
    return {"byte_start": start.cast("long"), "byte_end": (start + F.octet_length(quote)).cast("long")}


def missing_bibliography(works: DataFrame, evidence: DataFrame) -> DataFrame:
    """work_id, value of the bibliographic values that the work's evidence spans, in order, don't hold."""
    parts = F.sort_array(F.collect_list(F.struct("pos", "body")))
    joined = evidence.groupBy("work_id").agg(F.array_join(F.transform(parts, lambda x: x["body"]), "").alias("_fs_text"))
    each = works.select("work_id", F.explode("values").alias("value")).join(joined, "work_id", "left")
    return each.where(~F.coalesce(F.col("_fs_text").contains(F.col("value")), F.lit(False))).select("work_id", "value")


def budget(assigned: DataFrame, sections: DataFrame) -> DataFrame:
    """reading_id, role, tokens: token sums of a reading's sections by role, a repeated section counted once."""
    once = assigned.select("reading_id", "role", "section_id").distinct()
    return once.join(sections.select("section_id", "tokens"), "section_id").groupBy("reading_id", "role").agg(F.sum("tokens").alias("tokens"))
