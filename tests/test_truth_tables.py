"""Truth tables of operators over inline fixtures: every case states the rows that must come out, as SQL."""

from __future__ import annotations

from collections.abc import Callable

import duckdb
import pytest
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions import replies
from folioscan.functions import text as T
from folioscan.operators import coverage, identity, journal, ledger, publication, reading, wiki, witness

CASES: dict[str, tuple[Callable, str]] = {}


def query(sql: str):
    """A case with the SQL of its rows."""

    def add(f):
        CASES[f.__name__] = f, sql
        return f

    return add


SOURCE = (
    "the sailors mended what the storm had torn—knots, nets and all, for winter was near. He is not idle, but a patient man, slow and sure. "
    "Nine of my company went ashore who were the strongest and the bravest of all. carrying the captain&#39;s letters."
)
#: (excerpt, whether it is grounded in SOURCE)
TRUTH = (
    ("Nine of my company went ashore who were the strongest", True),
    ("the storm had torn —knots, nets and all", True),
    ("carrying the captain's letters", True),
    ("carrying the captain's letters.”", True),
    ("He is not idle,   but a patient man, slow and sure", True),
    ("He is idle, but a patient man, slow and sure", False),
    ("Ten of my company went ashore who were the strongest", False),
    ("ashore went Nine of my company who were the strongest", False),
    ("the captain burned the letters", False),
    ("", False),
    ("...", False),
)


def rows_sql(rows: list[tuple]) -> str:
    literal = lambda x: "NULL" if x is None else str(x) if isinstance(x, (bool, int)) else "'" + x.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)


@query(f"SELECT * FROM (VALUES {rows_sql([(i, t) for i, (_, t) in enumerate(TRUTH)])}) v(id, is_grounded)")
def grounding_truth_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(i, e, SOURCE) for i, (e, _) in enumerate(TRUTH)], "id int, excerpt string, source string")
    folded = rows.select("id", T.fold(F.col("excerpt")).alias("n"), T.fold(F.col("source")).alias("h"))
    plain = folded.withColumn("plain", T.grounded(F.col("n"), F.col("h")))
    return plain.select("id", (F.col("plain") | F.coalesce(T.elided_udf(T.trim_quotes(F.col("n")), F.col("h")), F.lit(False))).alias("is_grounded"))


WITNESSES = [
    ("c1", "Aen.1.1", "w1", "1.1-5", "Ann", "arms and the man I sing", None),
    ("c2", "Aen.1.1", "w1", "1.1-5", "Ann", "weapons and a man", "excerpt not verbatim"),
    ("c3", "Aen.1.1", "lat", "1.1", "Ann", "arma virumque cano", "not a translation witness"),
    ("c4", "Aen.2.9", "w1", "1.1", "Ann", "arms and the man I sing", "locator book differs"),
    ("c5", "Aen.1.1", "w9", "1.1", "Ann", "x", "witness source not in ledger"),
    ("c6", "Aen.1.1", "w1", "somewhere", "Ann", "arms and the man I sing", "locator unparseable"),
    ("c7", "Aen.5.1", "w1", "BOOK V, 1", "Ann", "arms and the man I sing", "no alignment"),
    ("c8", "Aen.1.1", "w1", "1; 1", "Bob", "arms and the man I sing", "translator not in sources"),
]


@query(f"SELECT * FROM (VALUES {rows_sql([(w[0], w[-1]) for w in WITNESSES if w[-1]] + [('c3', 'no alignment')])}) v(claim_id, \"check\")")
def witness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = spark.createDataFrame([w[:-1] for w in WITNESSES], "claim_id string, locator string, source_id string, w_locator string, translator string, excerpt string")
    claims = flat.select("claim_id", "locator", F.struct("source_id", F.col("w_locator").alias("locator"), "excerpt", "translator").alias("witness"))
    sources = spark.createDataFrame([("w1", "translation", "Ann", "Arms and the man I sing, who first"), ("lat", "canonical", "Vergil", "arma virumque cano")], "source_id string, role string, translator string, text string")
    alignment = spark.createDataFrame([(1, {"ann": {"source_id": "w1", "aligned_to": ""}}), (2, {"Ann": {"source_id": "w1", "aligned_to": "Aen.2.1-"}})], "book int, witnesses map<string,struct<source_id:string,aligned_to:string>>")
    return witness.witness_violations(claims, sources, witness.aligned(alignment))


PAGES = [
    ("index.md", "See [[concepts/fate]] and [[fate|Fate]] and [[missing]] [a](concepts/fate.md) [b](../out.md) [c](https://x.y/z) [d](<concepts/no file.md>)"),
    ("concepts/fate.md", "Back to [[index]] [[../index]] [up](../index.md#top) [self](./fate.md) [gone](other.md)"),
    ("sources/raw.md", "[[nowhere]]"),
]


def wiki_pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAGES, "path string, text string")


@query("SELECT * FROM (VALUES ('index.md', 'missing'), ('concepts/fate.md', '../index')) v(path, raw)")
def wikilink_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki.dead_wikilinks(wiki.semantic(wiki_pages(spark), "path"), "path", "text")


@query("SELECT * FROM (VALUES ('index.md', 'fate|Fate'), ('index.md', 'missing'), ('concepts/fate.md', '../index')) v(path, raw)")
def wikilink_audit_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki.dead_wikilinks(wiki.semantic(wiki_pages(spark), "path"), "path", "text", exact=True)


@query("SELECT * FROM (VALUES ('index.md', '../out.md', 'escapes wiki'), ('index.md', 'concepts/no file.md', 'missing target'), ('concepts/fate.md', 'other.md', 'missing target')) v(path, target, \"check\")")
def local_link_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki.dead_links(wiki.semantic(wiki_pages(spark), "path"), wiki_pages(spark), "path", "text")


@query("SELECT * FROM (VALUES (1, 'missing keys', 'confidence,stance'), (3, 'missing keys', 'claim,claim_id,confidence,excerpt,independence_group,locator,note,source_ids,stance,verified_at')) v(line, \"check\", missing)")
def required_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [k for k in ledger.CLAIM_KEYS if k not in ("stance", "confidence")]
    some = "{" + ", ".join(f'"{k}": null' for k in keys) + "}"
    full = "{" + ", ".join(f'"{k}": 1' for k in ledger.CLAIM_KEYS) + "}"
    raw = spark.createDataFrame([(1, some), (2, full), (3, "[]")], "line int, raw string")
    return ledger.missing_keys(raw, "raw", "line", ledger.CLAIM_KEYS).select("line", F.lit("missing keys").alias("check"), "missing")


PACKETS = [
    ("w1", 0, "a claim", "f", "1", "words", "supports"),
    ("w1", 1, "...", "TBD", None, "…", "supports"),
    ("w1", 2, "b", "f", "2", " ", "agrees"),
    ("w2", 0, "c", "f", "1", "w", "qualifies"),
]


@query("""SELECT * FROM (VALUES ('w1', 'missing locator', 2::BIGINT), ('w1', 'placeholder echo', 2), ('w1', 'missing excerpt', 3), ('w1', 'non-concrete stance', 3), ('w3', 'zero claims', NULL), ('w4', 'not an object', NULL), ('w5', 'no claims list', NULL)) v(worker, "check", ordinal)""")
def packet_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(PACKETS, "worker string, pos int, claim string, source_file string, locator string, excerpt string, stance string")
    packets = spark.createDataFrame([("w1", True, True), ("w2", True, True), ("w3", True, True), ("w4", False, False), ("w5", True, False)], "worker string, is_object boolean, has_list boolean")
    return ledger.packet_defects(rows, packets)


STATES = [("r1", s, i) for i, s in enumerate(journal.STATES)] + [("r2", "PLANNING", 0), ("r2", "COMPILING", 1), ("r2", "FAILED", 2), ("r3", "RESEARCHING", 0), ("r3", "FAILED", 1), ("r3", "FAILED", 2)]


@query("SELECT * FROM (VALUES ('r2', 'COMPILING', 1), ('r3', 'RESEARCHING', 0), ('r3', 'FAILED', 2)) v(run, state, seq)")
def illegal_state_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.illegal_transitions(spark.createDataFrame(STATES, "run string, state string, seq int"), "run", "seq", "state")


def values(columns: str, *rows: tuple) -> str:
    """SQL of the rows, or of an empty table."""
    named = ", ".join(f'"{c}"' for c in columns.split(", "))
    return f"SELECT {named} FROM (VALUES {rows_sql(list(rows))}) v({named})"


def one_each(spark: SparkSession, column: str, kind: str, rows: list, made: Column, name: str) -> DataFrame:
    """id and a computed column for each of the values."""
    return spark.createDataFrame(list(enumerate(rows)), f"id int, {column} {kind}").select("id", made.alias(name))


# packets and ledgers

PACKET = "worker string, pos int, claim string, source_file string, locator string, excerpt string, stance string, claim_type string, english_witness struct<translator:string,source_id:string,locator:string,excerpt:string>, consulted_is_text boolean"


@query(values(
    "worker, check, ordinal", ("a", "claim_type not allowed", 2), ("a", "source_file is a translation witness", 2), ("b", "english_witness is not an object", 1), ("b", "english_witness missing locator", 2),
    ("b", "english_witness translator unknown", 2), ("b", "witnesses_consulted must be a list", 2), ("c", "missing locator", 1), ("d", "zero claims", None),
))
def multi_witness_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = ("Ann", "w1", "1.1", "arms and the man")
    rows = [
        ("a", 0, "x", "book-01-latin.html", "1.1", "arma", "supports", "event", good, False), ("a", 1, "x", "book-1-english.html", "1.1", "arma", "supports", "rumour", good, False),
        ("b", 0, "x", "book-2-latin.html", "1.1", "arma", "supports", "event", None, True), ("b", 1, "x", "notes.html", "1.1", "arma", "supports", "event", ("Bob", "w1", " ", "arms"), True),
        ("c", 0, "x", "book-3-english.html", "", "arma", "supports", "rumour", None, False),
    ]
    packets = spark.createDataFrame([(w, True, True) for w in "abcd"], "worker string, is_object boolean, has_list boolean")
    return ledger.multi_witness_defects(spark.createDataFrame(rows, PACKET), packets, ["event", "place"], {"english": "Ann"}, "book-{n}-{w}.html", True)


@query(values("worker, pos", ("a", 1), ("b", 0)))
def placeholder_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("a", 0, "x", "f", "1", "e"), ("a", 1, "x", "f", "TBD", "e"), ("b", 0, "...", "…", "TBD", "..."), ("b", 1, None, "f", "1", "e")]
    return ledger.any_placeholder(spark.createDataFrame(rows, "worker string, pos int, claim string, source_file string, locator string, excerpt string")).select("worker", "pos")


@query(values("source_file, excerpt", ("book-1.html", "arms and the man"), (None, "")))
def normalised_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.normalised(spark.createDataFrame([("book-\n 1.html", "  arms and\n\tthe man "), (None, " \n")], "source_file string, excerpt string"))


NOTES = [("f1", "n1", "s1"), ("f2", "n2", "s2")]
DRAFTS = [("w1", 0, "c-w1-1", "f1", "x", "1", "e", None, None, None), ("w1", 1, "c-w1-2", "f9", "y", "2", "e", "qualifies", 0.5, "g"), ("w2", 0, None, "f2", "z", "3", "e", None, 0.9, None), ("w2", 1, "c-w2-2", "f2", "z", "3", "e", "contradicts", 0.9, "h")]
DRAFT = "worker string, pos int, claim_id string, source_file string, claim string, locator string, excerpt string, stance string, confidence double, independence_group string"


@query("SELECT * FROM (VALUES ('c-w1-1', 's1', 'n1', 'supports', 0.0::DOUBLE, 'w1', '2024-01-01'), ('c-w2-2', 's2', 'n2', 'contradicts', 0.9::DOUBLE, 'h', '2024-01-01')) v(claim_id, source_id, note, stance, confidence, independence_group, verified_at)")
def ledger_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = ledger.ledger_rows(spark.createDataFrame(DRAFTS, DRAFT), spark.createDataFrame(NOTES, "source_file string, note string, source_id string"), "2024-01-01")
    return rows.select("claim_id", F.element_at("source_ids", 1).alias("source_id"), "note", "stance", "confidence", "independence_group", "verified_at")


@query(values("worker, pos, source_file", ("w1", 1, "f9"), ("w2", 0, "f2")))
def ledger_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.ledger_rows(spark.createDataFrame(DRAFTS, DRAFT), spark.createDataFrame(NOTES, "source_file string, note string, source_id string"), "2024-01-01")[1]


@query(values("worker, check", ("b", "no execution lineage"), ("c", "no extraction call"), ("d", "model not allowed"), ("e", "model not allowed")))
def model_restriction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, bad, other = ("extraction", "m1", "m1"), ("extraction", "m1", "m9"), ("verify", "m9", "m9")
    rows = [("a", [ok, other]), ("b", None), ("c", [other]), ("d", [ok, bad]), ("e", [("extraction", None, "m1")])]
    return ledger.model_violations(spark.createDataFrame(rows, "worker string, execution array<struct<role:string,requested:string,returned:string>>"), ["m1", "m2"])


@query(values("id, state", (0, "unavailable"), (1, "available"), (2, "malformed"), (3, "unavailable")))
def advisory_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_each(spark, "reply", "string", [None, "Scope: all\nUncertainty: low", "Scope: all", " \n"], ledger.advisory(F.col("reply")), "state")


@query(values("bundle_key, disposition", ("a", "available"), ("b", "incomplete-optional"), ("c", "no-visuals")))
def visual_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("a", "x", "d"), ("a", "y", "d"), ("b", "x", "d"), ("b", "y", None), ("c", None, None)]
    return ledger.visual_disposition(spark.createDataFrame(rows, "bundle_key string, asset string, derivative string"))


# texts and replies


@query(values("id, plain", (0, "a b"), (1, "<!-- kept --> x"), (2, "")))
def without_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_each(spark, "t", "string", ["a <!--@@chapter ch%201-->b", "<!-- kept --> x<!--@@formula-->", "<!--@@section s-->"], T.without_markers(F.col("t")), "plain")


@query(values("id, n", (0, 3), (1, 3), (2, 4), (3, 6)))
def fence_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_each(spark, "t", "string", ["none", "`a` ``b``", "```\nx\n```", "a ````` b ```"], T.fence_length(F.col("t")), "n")


@query(values("id, found", (0, "A-1,B"), (1, "")))
def bracket_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_each(spark, "t", "string", ["see [a-1], [B] and [A-1]", "none []"], F.array_join(T.labels(F.col("t")), ","), "found")


@query(values("id, name", (0, "Book 3"), (1, "Book 12"), (2, "The Sea")))
def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_each(spark, "t", "string", ["book-03", "epic-book-12", "the-sea"], T.display_name(F.col("t")), "name")


@query(values("id, packet", (0, '{"claims": [1]}'), (1, '{"claims": []}'), (2, '{"a": {"claims": [2]}}'), (3, None), (4, '{"claims": [3]}')))
def packet_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = ['{"claims": [1]}', 'Here:\n```json\n{"claims": []}\n```\nDone', ' {"a": {"claims": [2]}} ', "no packet {", 'I found {"x": 1} and {"claims": [3]} here']
    return one_each(spark, "t", "string", said, replies.packets(F.col("t")), "packet")


@query(values("id, proposal", (0, '{"found": true}'), (1, '{"found": false, "why": "none"}'), (2, None)))
def repair_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = ['{"found": true}', 'So {"x": 1} then {"found": false, "why": "none"}.', '{"lost": true}']
    return one_each(spark, "t", "string", said, replies.repairs(F.col("t")), "proposal")


@query("SELECT 0 AS id, '--- before/p.md' || chr(10) || '+++ after/p.md' || chr(10) || '@@ -1,2 +1,2 @@' || chr(10) || ' a' || chr(10) || '-b' || chr(10) || '+c' || chr(10) AS diff UNION ALL SELECT 1, ''")
def page_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(0, "a\nb\n", "a\nc\n"), (1, "same\n", "same\n")], "id int, b string, a string")
    return rows.select("id", replies.unified_diff(F.col("b"), F.col("a"), F.lit("p.md")).alias("diff"))


# readings


@query(values("claim_id, n_spans", ("c1", 1), ("c2", 2), ("c3", 0), ("c4", 0)))
def reading_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = spark.createDataFrame([("c1", "r1", "f", "arms"), ("c2", "r1", "f", "man"), ("c3", "r1", "g", "arms"), ("c4", "r2", "f", "arms")], "claim_id string, reading_id string, source_file string, excerpt string")
    spans = spark.createDataFrame([("r1", "f", "arms and the man"), ("r1", "f", "the man again"), ("r2", "f", "nothing")], "reading_id string, source_file string, body string")
    return reading.bindings(claims, spans)


@query(values("work_id, value", ("w1", "1900"), ("w2", "x")))
def missing_bibliography(spark: SparkSession, sf_dir: str) -> DataFrame:
    works = spark.createDataFrame([("w1", ["Ann", "London", "1900"]), ("w2", ["x"])], "work_id string, values array<string>")
    return reading.missing_bibliography(works, spark.createDataFrame([("w1", 2, "don 19"), ("w1", 1, "by Ann, Lon")], "work_id string, pos int, body string"))


def _names(spark: SparkSession, column: str, names: str) -> DataFrame:
    return spark.createDataFrame([(x,) for x in names], f"{column} string")


@query(values("section_id, check", ("b", "unused context"), ("d", "excluded but used")))
def context_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.context_defects(_names(spark, "section_id", "aab"), _names(spark, "section_id", "acd"), _names(spark, "section_id", "dde"), "section_id")


@query(values("section_id", ("b",), ("c",), ("d",)))
def reading_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.ownership(_names(spark, "section_id", "abbc"), _names(spark, "section_id", "abccd"), "section_id").select("section_id").distinct()


@query(values("section_id", ("b",), ("x",)))
def unit_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.uncovered(_names(spark, "section_id", "abbx"), _names(spark, "section_id", "ab"), "section_id").select("section_id").distinct()


@query(values("reading_id, role, tokens", ("r1", "primary", 12), ("r1", "context", 5), ("r2", "primary", 5)))
def reading_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = spark.createDataFrame([("r1", "primary", "a"), ("r1", "primary", "a"), ("r1", "primary", "c"), ("r1", "context", "b"), ("r2", "primary", "b")], "reading_id string, role string, section_id string")
    return reading.budget(assigned, spark.createDataFrame([("a", 10), ("b", 5), ("c", 2)], "section_id string, tokens int"))


# identities and histories

EVENTS = "claim_id string, event string, new_excerpt string, reason string, attempt_id string, state_before string, state_after string, source_file string, source_revision string"


@query(values("check, claim_id", ("binding differs", "c2"), ("drop has an excerpt", "c3"), ("no reason", "c3"), ("no attempt", "c4"), ("state unchanged", "c4")))
def drop_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [
        ("c1", "drop", None, "gone", "a1", "s0", "s1", "f", "r"), ("c2", "drop", None, "gone", "a1", "s0", "s1", "g", "r"), ("c3", "drop", "x", " ", "a1", "s0", "s1", "f", "r"),
        ("c4", "drop", None, "gone", None, "s1", "s1", "f", None), ("c5", "repair", "y", None, None, "s1", "s1", "z", "z"),
    ]
    bindings = spark.createDataFrame([("c1", "f", "r"), ("c2", "f", "r"), ("c3", "f", "r"), ("c4", "f", None)], "claim_id string, source_file string, source_revision string")
    return identity.drop_violations(spark.createDataFrame(rows, EVENTS), bindings)


@query(values("claim_id, side", ("b", "left"), ("d", "right"), ("x", "new")))
def unaccounted_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.unaccounted(*(_names(spark, "claim_id", x) for x in ("abcd", "adx", "cd")))


@query(values("worker, binding, incompatible", ("a", "b1", False), ("b", "b2", True)))
def packet_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.packet_bindings(spark.createDataFrame([("a", 0, "b1"), ("a", 1, "b1"), ("b", 3, "b3"), ("b", 1, "b2")], "worker string, pos int, binding string"))


LEDGER = "pos int, claim_id string, claim string, stance string, source_file string, excerpt string, packet_state_revision string"
OLD = [(0, "c1", "x", "supports", "f", "old", "p0"), (1, "c2", "y", "supports", "f", "old", "p0"), (2, "c3", "z", "supports", "f", "old", "p0"), (3, "c4", "w", "supports", "f", "old", "p0")]
LIVE = [("c1", "x", "supports", "f", "new", "p1"), ("c4", "w", "qualifies", "f", "old", "p1"), ("c9", "v", "supports", "f", "e", "p1")]


def _synchronised(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return identity.synchronised(spark.createDataFrame(OLD, LEDGER), spark.createDataFrame(LIVE, LEDGER.removeprefix("pos int, ")), _names(spark, "claim_id", "x").select(F.lit("c2").alias("claim_id")))


@query(values("pos, claim_id, excerpt, packet_state_revision", (0, "c1", "new", "p1"), (3, "c4", "old", "p1")))
def synchronised_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synchronised(spark)[0].select("pos", "claim_id", "excerpt", "packet_state_revision")


@query(values("check, claim_id", ("ledger row is neither live nor dropped", "c3"), ("immutable field differs", "c4"), ("live claim has no ledger row", "c9")))
def synchronised_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synchronised(spark)[1]


@query(values("worker, alias, claim_id, n", ("a", "c-a-1", "c-a-1", 1), ("a", "1", "c-a-1", 1), ("a", "2", "c-a-2", 2), ("b", "9", None, 0)))
def report_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "worker string, alias string, claim_id string"
    failures = spark.createDataFrame([("a", "c-a-1"), ("a", "1"), ("a", "2"), ("b", "9")], "worker string, alias string")
    live = spark.createDataFrame([("a", "c-a-1"), ("a", "c-a-2"), ("a", "c-a-3")], "worker string, claim_id string")
    return identity.report_targets(failures, live, spark.createDataFrame([("a", "1", "c-a-1"), ("a", "2", "c-a-2"), ("a", "2", "c-a-3"), ("b", "1", "c-a-1")], names))


@query(values("decision, n", ("drop", 3), ("repair", 1)))
def repair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("c1", True, True), ("c2", True, False), ("c3", False, None), ("c4", None, True)]
    return identity.repair_counts(identity.repair_decisions(spark.createDataFrame(rows, "claim_id string, found boolean, is_grounded boolean")))


@query(values("at, check", (2, "fields differ"), (3, "digest differs"), (4, "no row"), (5, "no claim")))
def legacy_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = "at int, claim string, stance string, source_file string, locator string, excerpt string, sha256 string"
    row = ("x", "supports", "f", "1", "e")
    packets = [(1, *row, "d1"), (2, *row, "d2"), (3, *row, "d3"), (4, *row, "d4")]
    rows = [(1, *row, "d1"), (2, "y", *row[1:], "d2"), (3, *row, "d9"), (5, *row, "d5")]
    return identity.legacy_differences(spark.createDataFrame(packets, kind), spark.createDataFrame(rows, kind))


# plans and publication


@query(values("path, check", ("b", "missing"), ("c", "digest differs"), ("d", "digest differs")))
def required_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = "path string, sha256 string"
    before, after = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], tree), spark.createDataFrame([("a", "1"), ("c", "4"), ("d", "5")], tree)
    return coverage.required_outputs(_names(spark, "path", "abcd"), before, after)


@query(values("source_file, note", ("a", "unit"), ("b", "bundle"), ("c", "base")))
def overlaid_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda names, note: spark.createDataFrame([(x, note) for x in names], "source_file string, note string")
    return coverage.overlaid_notes(part("abc", "base"), part("ab", "bundle"), part("a", "unit"))


@query(values("book, variant, source_file, note", (1, "latin", "book-1-latin.html", "Book 1"), (1, "english", "book-1-english.html", "Book 1"), (2, "latin", "book-2-latin.html", "Book 2"), (2, "english", "book-2-english.html", "Book 2")))
def source_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.source_maps(spark.createDataFrame([(1,), (2,)], "book int"), spark.createDataFrame([("latin",), ("english",)], "variant string"), "book-{book}-{variant}.html", "Book {book}")


UNITS = [("u1", 10, 100, False), ("u2", None, 50, True), ("u3", 5, 20, True)]


@query(values("units, tokens, bytes, unresolved, least_requests", (3, 15, 170, 2, 13)))
def planning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.planning_report(spark.createDataFrame(UNITS, "unit_id string, tokens int, bytes int, unresolved boolean"), _names(spark, "reading_id", "abcd"))


@query(values("unit_id", ("u2",), ("u3",)))
def unresolved_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.unresolved(spark.createDataFrame(UNITS, "unit_id string, tokens int, bytes int, unresolved boolean"))


@query(values("worker, state", ("a", "reused"), ("b", "pending"), ("c", "pending"), ("d", "pending")))
def packet_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = spark.createDataFrame([(w, "p1") for w in "abcd"], "worker string, provenance string")
    stored = spark.createDataFrame([("a", "p1", 0), ("b", "p0", 0), ("c", "p1", 2)], "worker string, provenance string, n_defects int")
    reused, pending = coverage.reuse(specs, stored)
    return reused.select("worker", F.lit("reused").alias("state")).unionByName(pending.select("worker", F.lit("pending").alias("state")))


@query(values("path, check", ("b", "several assets"), ("c", "digest differs"), ("d", "no asset"), ("../e", "unsafe path")))
def visual_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = "path string, sha256 string"
    return publication.visual_matches(spark.createDataFrame([(p, "1") for p in ("a", "b", "c", "d", "../e")], tree), spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "1"), ("c", "2"), ("../e", "1")], tree))


@query(values("pos, check", (1, "other unit"), (2, "other input"), (3, "no outcome"), (4, "extra outcome")))
def unit_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = "pos int, unit_id string, input_sha256 string"
    units = spark.createDataFrame([(0, "u0", "i0"), (1, "u1", "i1"), (2, "u2", "i2"), (3, "u3", "i3")], kind)
    return publication.unit_outcomes(units, spark.createDataFrame([(0, "u0", "i0"), (1, "u9", "i1"), (2, "u2", "i9"), (4, "u4", "i4")], kind))


@query(values("check, path", ("planned and applied differ", "b.md"), ("no backlink", "b.md")))
def compile_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = "action string, path string"
    planned = spark.createDataFrame([("write", "sum.md"), ("write", "a.md"), ("write", "b.md")], acts)
    pages = spark.createDataFrame([("sum.md", "x"), ("a.md", "see [[sum]]"), ("b.md", "none")], "path string, text string")
    return publication.completion(planned, planned.where("path <> 'b.md'"), pages, "sum.md").distinct()


@query(values("asset, check", ("b", "required but not inspected"), ("c", "digest differs"), ("z", "unknown asset"), ("c", "several records"), (None, "token budget")))
def context_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = spark.createDataFrame([("a", "1", True), ("b", "2", True), ("c", "3", False), ("d", "4", False)], "asset string, sha256 string, required boolean")
    seen = spark.createDataFrame([("a", "1", "1", 40), ("c", "3", "9", 30), ("c", "3", "9", 30), ("z", "5", "5", 1)], "asset string, input_sha256 string, inspected_sha256 string, tokens int")
    return publication.context_violations(seen, assets, 100)


@query(values("bundle_key, state", ("a", "complete"), ("b", "incomplete"), ("c", "incomplete")))
def inspected_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = spark.createDataFrame([("a", "x", "ok", None), ("a", "y", "ok", "seen"), ("b", "x", "ok", "seen"), ("c", "x", "ok", " ")], "bundle_key string, asset string, result string, note string")
    return publication.inspected(calls, spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "x")], "bundle_key string, asset string"))


@query(values("path, check", ("https://x/a.png", "not local"), ("../a.png", "unsafe path"), ("a.svg", "suffix not allowed")))
def bad_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.bad_images(spark.createDataFrame([("img/a.PNG",), ("https://x/a.png",), ("../a.png",), ("a.svg",)], "path string"), "path")


@query(values("check, detail", ("unexpected file", "notes.txt"), ("missing witness file", "2/english")))
def snapshot_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.createDataFrame([("book-1-latin.html",), ("book-1-english.html",), ("book-2-latin.html",), ("notes.txt",)], "name string")
    return publication.snapshot_gaps(names, "name", r"\Abook-(\d+)-(\w+)\.html\z", spark.createDataFrame([(1,), (2,)], "book int"), spark.createDataFrame([("latin",), ("english",)], "variant string"))


@query(values("path, check", ("b", "not tracked"), ("c", "after review: changed"), ("d", "after review: removed"), ("d", "not tracked"), ("e", "after review: added")))
def output_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = "path string, sha256 string"
    reviewed = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "1")], tree)
    return publication.output_differences(reviewed, spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2"), ("e", "1")], tree), _names(spark, "path", "ac"))


@query(values("section_id, row", ("s1", '{"section_id":"s1","target":"assets/k/original/a.md#L1-L3","heading":"# One"}')))
def citation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.citation_rows(spark.createDataFrame([("s1", "assets/k/original/a.md#L1-L3", "# One \nbody\n")], "section_id string, target string, body string"))


@query(values("id, target", (0, "assets/k/original/a.md#L1-L3"), (1, "assets/k/original/d%20e/%C3%A9%2B.md#L1-L3")))
def citation_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_each(spark, "p", "string", ["a.md", "d e/é+.md"], publication.citation_target(F.lit("k"), F.col("p"), F.lit(1), F.lit(4)), "target")


# journals


@query(values("run, check", ("b", "requests differ"), ("c", "tokens differ"), ("d", "requests differ"), ("d", "tokens differ")))
def budget_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = spark.createDataFrame([("a", 2, 5), ("b", 2, 5), ("c", 1, 4), ("d", 1, 1)], "run string, requests int, tokens int")
    return journal.reconciliation(state, spark.createDataFrame([("a", 5), ("a", None), ("b", 5), ("c", 5)], "run string, tokens int"), "run")


@query(values("id, profile", (0, "p0"), (1, "p1"), (2, "p1")))
def fallback_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_each(spark, "i", "int", [0, 1, 7], journal.fallback(F.array(F.lit("p0"), F.lit("p1")), F.col("i")), "profile")


ERRORS = [(401, None), (403, None), (429, None), (408, None), (504, None), (503, None), (422, None), (None, "ReadTimeout"), (None, "ConnectError"), (None, "ValueError"), (200, "X")]
CLASSES = ("authentication", "authentication", "rate_limited", "timeout", "timeout", "unavailable", "invalid_request", "timeout", "unavailable", "failed", "failed")


@query(values("id, class", *enumerate(CLASSES)))
def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(i, *e) for i, e in enumerate(ERRORS)], "id int, status int, kind string")
    return rows.select("id", journal.error_class(F.col("status"), F.col("kind")).alias("class"))


@query(values("id, tokens", (0, 9), (1, 7), (2, None), (3, 7), (4, None)))
def usage_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(3, 4, 9), (3, 4, None), (3, None, None), (3, 4, -1), (-3, 4, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, p int, c int, t int")
    return df.select("id", journal.usage(F.col("p"), F.col("c"), F.col("t")).alias("tokens"))


@query(values("id, n", (0, 1024 + 256 + 100 + 2), (1, 1024 + 512 + 3)))
def envelope_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(0, "é", 1, 100), (1, "abc", 2, 0)], "id int, t string, m int, r int")
    return rows.select("id", journal.envelope_bytes(F.col("t"), F.col("m"), F.col("r")).alias("n"))


@query(values("id, ok", (0, True), (1, False), (2, False), (3, False)))
def accepted_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([(0, "stop", "x"), (1, "length", "x"), (2, "stop", "  "), (3, None, "x")], "id int, f string, c string")
    return rows.select("id", journal.accepted(F.col("f"), F.col("c")).alias("ok"))


@query(values("pos, skip", (0, True), (1, True), (2, False), (3, False)))
def resumable_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = "pos int, unit_id string, input_sha256 string, output_sha256 string"
    done = [(0, "a", "1", "x"), (1, "b", "2", "y"), (2, "c", "9", "z"), (3, "d", "4", "w")]
    units = [(0, "a", "1", "x"), (1, "b", "2", "y"), (2, "c", "3", "z"), (3, "d", "4", "w")]
    return journal.resumable(spark.createDataFrame(done, kind), spark.createDataFrame(units, kind)).select("pos", "skip")


# witnesses and pages


@query(values("claim_id, witness_excerpt", ("c1", "first"), ("c2", "second"), ("c3", "first")))
def assembled_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = spark.createDataFrame([(c, p, e) for c in ("c1", "c2", "c3") for p, e in ((0, "first"), (1, "second"))], "claim_id string, pos int, excerpt string")
    choices = spark.createDataFrame([("c2", 1, 0), ("c2", 2, 1), ("c3", 1, 7)], "claim_id string, seq int, pos int")
    return witness.assembled(spark.createDataFrame([(f"c{i}",) for i in range(1, 5)], "claim_id string"), candidates, choices)


@query(values("id", (0,), (2,)))
def verbatim_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(0, "<p>Arms and\n the <i>man</i></p>", "arms AND the man"), (1, "arms and the man", "arms of the man"), (2, "x", "<b>x</b>"), (3, "x", "  ")]
    return witness.verbatim_pairs(spark.createDataFrame(rows, "id int, t string, e string"), "id", "t", "e").select("id")


@query(values("path, file, fragment, check", ("p", "assets/k/original/a.md", "L9", "not a frozen section"), ("p", "assets/k/original/z.md", None, "not in the reading plan")))
def foreign_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = [("p", "assets/k/original/a.md", "L1-L3"), ("p", "assets/k/original/a.md", "L9"), ("p", "assets/k/original/z.md", None), ("p", "other.md", None)]
    return wiki.foreign_citations(spark.createDataFrame(links, "path string, file string, fragment string"), spark.createDataFrame([("assets/k/original/a.md", "L1-L3")], "file string, fragment string"))


@query(values("page, at, body", ("p", 1, "# x"), ("p", 2, "- [[book 2]]"), ("p", 3, "- [[Book 10]]"), ("p", 4, "y"), ("p", 5, "- [[b]]")))
def sorted_bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("p", 1, "# x"), ("p", 2, "- [[Book 10]]"), ("p", 3, "- [[book 2]]"), ("p", 4, "y"), ("p", 5, "- [[b]]")]
    return wiki.sorted_bullets(spark.createDataFrame(rows, "page string, at int, body string"), "page", "at", "body")


@query(values("id, md", (0, "see [a](a.md) and [title](b.md)"), (1, "[c](c.md)")))
def relative_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_each(spark, "t", "string", ["see [[a]] and [[b#part|title]]", "[[c#x]]"], wiki.relative_links(F.col("t")), "md")


@pytest.mark.parametrize("name", CASES)
def test_case(spark, name):
    f, sql = CASES[name]
    df, want = f(spark, ""), duckdb.connect().sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
