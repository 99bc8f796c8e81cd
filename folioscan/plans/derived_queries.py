"""Queries of packets, replies, readings, histories, plans, journals and wiki pages over inputs that SQL derives from the tables.

An input is one piece of SQL that Spark and DuckDB both understand, so the
operator and its oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions import replies
from folioscan.functions import text as T
from folioscan.operators import coverage, identity, journal, ledger, publication, reading, wiki, witness
from folioscan.plans.catalog import query, table

TABLES = ("lineitem", "orders", "customer", "supplier", "part", "nation", "region", "documents", "pages", "events", "conversations", "benchmark", "labels")


def rows(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The rows of an input; {table} stands for a table."""
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in sql})


def duck(sql: str, **inputs: str) -> str:
    """The oracle's SQL with its inputs as named subqueries."""
    named = ", ".join(f"{name} AS ({x})" for name, x in inputs.items())
    out = sql if not named else f"WITH {named}, {sql.lstrip()[5:]}" if sql.lstrip().startswith("WITH ") else f"WITH {named} {sql}"
    for t in TABLES:
        out = out.replace("{" + t + "}", t)
    return out


# packets and ledgers

CLAIMS = """SELECT l_orderkey AS worker, l_linenumber - 1 AS pos, 'x' AS claim, 'book-' || (l_suppkey % 3 + 1) || CASE WHEN l_linenumber = 2 THEN '-english.html' ELSE '-latin.html' END AS source_file,
 CASE WHEN l_orderkey % 23 = 0 AND l_linenumber = 1 THEN '' ELSE '1.1' END AS locator, 'arma' AS excerpt, 'supports' AS stance, CASE WHEN l_returnflag = 'R' THEN 'rumour' ELSE 'event' END AS claim_type,
 l_linenumber = 5 AS no_witness, CASE WHEN l_linestatus = 'F' THEN 'Bob' ELSE 'Ann' END AS translator, CASE WHEN l_linenumber = 4 THEN ' ' ELSE '1.1' END AS w_locator, l_linenumber = 6 AS consulted_is_text FROM {lineitem}"""
PACKETS = "SELECT o_orderkey AS worker, o_orderkey % 31 <> 0 AS is_object, o_orderkey % 29 <> 0 AS has_list FROM {orders}"
SIZED = """s AS (SELECT p.*, coalesce(k, 0) AS k FROM p LEFT JOIN (SELECT worker, count(*) AS k FROM c GROUP BY 1) USING (worker)),
 w AS (SELECT worker, CASE WHEN NOT is_object THEN 'not an object' WHEN NOT has_list THEN 'no claims list' WHEN k = 0 THEN 'zero claims' END AS "check", NULL::BIGINT AS ordinal FROM s),
 f AS (SELECT c.* FROM c JOIN w USING (worker) WHERE w."check" IS NULL)"""


@query(duck(f"""
WITH {SIZED},
 b AS (SELECT * FROM w WHERE "check" IS NOT NULL UNION ALL SELECT worker, 'missing locator', pos + 1 FROM f WHERE locator = ''),
 g AS (SELECT * FROM c WHERE worker IN (SELECT worker FROM p) AND worker NOT IN (SELECT worker FROM b))
SELECT * FROM b UNION ALL SELECT worker, 'claim_type not allowed', pos + 1 FROM g WHERE claim_type = 'rumour' UNION ALL SELECT worker, 'source_file is a translation witness', pos + 1 FROM g WHERE source_file LIKE '%-english.html'
UNION ALL SELECT worker, 'english_witness is not an object', pos + 1 FROM g WHERE no_witness UNION ALL SELECT worker, 'english_witness missing locator', pos + 1 FROM g WHERE NOT no_witness AND w_locator = ' '
UNION ALL SELECT worker, 'english_witness translator unknown', pos + 1 FROM g WHERE NOT no_witness AND translator = 'Bob' UNION ALL SELECT worker, 'witnesses_consulted must be a list', pos + 1 FROM g WHERE NOT no_witness AND consulted_is_text
""", c=CLAIMS, p=PACKETS))  # fmt: skip
def multi_witness_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.when(~F.col("no_witness"), F.struct("translator", F.lit("w1").alias("source_id"), F.col("w_locator").alias("locator"), F.lit("arms").alias("excerpt")))
    claims = rows(spark, sf_dir, CLAIMS).withColumn("english_witness", w)
    return ledger.multi_witness_defects(claims, rows(spark, sf_dir, PACKETS), ["event", "place"], {"english": "Ann"}, "book-{n}-{w}.html", True)


DRAFT_CLAIMS = """SELECT l_orderkey AS worker, l_linenumber - 1 AS pos, CASE WHEN l_partkey % 17 = 0 THEN '...' ELSE 'a claim' END AS claim, CASE WHEN l_partkey % 17 = 0 THEN 'TBD' ELSE 'f' END AS source_file,
 CASE WHEN l_partkey % 17 = 0 AND l_linenumber < 4 THEN 'TBD' WHEN l_partkey % 13 = 0 THEN NULL ELSE '1' END AS locator, CASE WHEN l_partkey % 17 = 0 THEN '…' WHEN l_partkey % 11 = 0 THEN ' ' ELSE 'e' END AS excerpt, CASE WHEN l_returnflag = 'A' THEN 'agrees' ELSE 'supports' END AS stance FROM {lineitem}"""
ALL_FOUR = "l.claim = '...' AND l.source_file = 'TBD' AND coalesce(l.locator = 'TBD', true) AND l.excerpt = '…'"


@query(duck(f"""
WITH {SIZED}
SELECT * FROM w WHERE "check" IS NOT NULL UNION ALL SELECT worker, 'missing locator', pos + 1 FROM f WHERE locator IS NULL UNION ALL SELECT worker, 'missing excerpt', pos + 1 FROM f WHERE excerpt = ' '
UNION ALL SELECT worker, 'non-concrete stance', pos + 1 FROM f WHERE stance = 'agrees' UNION ALL SELECT worker, 'placeholder echo', pos + 1 FROM f l WHERE {ALL_FOUR}
""", c=DRAFT_CLAIMS, p=PACKETS))  # fmt: skip
def packet_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.packet_defects(rows(spark, sf_dir, DRAFT_CLAIMS), rows(spark, sf_dir, PACKETS))


@query(duck("SELECT worker, pos FROM c WHERE claim = '...' OR source_file = 'TBD' OR locator = 'TBD' OR excerpt = '…'", c=DRAFT_CLAIMS))
def placeholder_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.any_placeholder(rows(spark, sf_dir, DRAFT_CLAIMS)).select("worker", "pos")


WRAPPED = "SELECT conv_id, turn, 'conv-' || chr(10) || ' ' || conv_id || '.html' AS source_file, '  ' || text || chr(10) || chr(9) || role || ' ' AS excerpt FROM {conversations}"


@query(duck("SELECT conv_id, turn, 'conv-' || conv_id || '.html' AS source_file, md5(trim(regexp_replace(excerpt, '\\s+', ' ', 'g'))) AS excerpt FROM c", c=WRAPPED))
def normalised_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.normalised(rows(spark, sf_dir, WRAPPED)).withColumn("excerpt", F.md5(F.col("excerpt").cast("binary")))


DRAFTS = """SELECT user_id AS worker, event_id AS pos, CASE WHEN event_id % 19 <> 0 THEN 'c-' || event_id END AS claim_id, 'f' || (user_id % 40) AS source_file, event_type AS claim, '1' AS locator, 'e' AS excerpt,
 CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN 'qualifies' ELSE 'contradicts' END AS stance, CASE WHEN event_id % 3 > 0 THEN CAST(event_id % 10 AS DOUBLE) / 10 END AS confidence, CASE WHEN event_id % 5 > 0 THEN 'g' || event_id % 7 END AS independence_group FROM {events}"""
NOTES = "SELECT 'f' || n_nationkey AS source_file, 'n' || n_regionkey AS note, 's' || n_nationkey AS source_id FROM {nation}"


def _ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return ledger.ledger_rows(rows(spark, sf_dir, DRAFTS).withColumn("worker", F.col("worker").cast("string")), rows(spark, sf_dir, NOTES), "2024-01-01")


@query(duck("SELECT claim_id, source_id, note, coalesce(stance, 'supports') AS stance, coalesce(confidence, 0) AS confidence, coalesce(independence_group, worker::VARCHAR) AS independence_group, '2024-01-01' AS verified_at FROM d JOIN n USING (source_file) WHERE claim_id IS NOT NULL", d=DRAFTS, n=NOTES))
def ledger_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger(spark, sf_dir)[0].select("claim_id", F.element_at("source_ids", 1).alias("source_id"), "note", "stance", "confidence", "independence_group", "verified_at")


@query(duck("SELECT worker::VARCHAR AS worker, pos, source_file FROM d WHERE claim_id IS NULL OR source_file NOT IN (SELECT source_file FROM n)", d=DRAFTS, n=NOTES))
def ledger_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger(spark, sf_dir)[1]


CALLS = "SELECT user_id AS worker, event_id, CASE WHEN event_type = 'error' THEN 'verify' ELSE 'extraction' END AS role, CASE WHEN value > 199 THEN NULL ELSE 'm' || event_id % 2 END AS requested, CASE WHEN event_id % 997 = 3 THEN 'm9' ELSE 'm1' END AS returned FROM {events}"


@query(duck("""
WITH u AS (SELECT c_custkey AS worker FROM {customer}), x AS (SELECT u.worker, count(e.event_id) AS n, count(*) FILTER (WHERE role = 'extraction') AS k, coalesce(bool_or(role = 'extraction' AND (requested IS NULL OR requested NOT IN ('m0', 'm1') OR returned NOT IN ('m0', 'm1'))), false) AS bad FROM u LEFT JOIN e ON u.worker = e.worker GROUP BY 1)
SELECT worker, CASE WHEN n = 0 THEN 'no execution lineage' WHEN k = 0 THEN 'no extraction call' ELSE 'model not allowed' END AS "check" FROM x WHERE n = 0 OR k = 0 OR bad
""", e=CALLS))  # fmt: skip
def model_restriction(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = rows(spark, sf_dir, CALLS).groupBy("worker").agg(F.collect_list(F.struct("role", "requested", "returned")).alias("execution"))
    return ledger.model_violations(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("worker")).join(calls, "worker", "left"), ["m0", "m1"])


REPLIES = "SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Scope: ' || role || chr(10) || 'Uncertainty: low' WHEN 2 THEN 'Scope: ' || text ELSE ' ' || chr(10) END AS reply FROM {conversations}"


@query(duck("SELECT conv_id, turn, CASE WHEN trim(regexp_replace(coalesce(reply, ''), '\\s+', ' ', 'g')) = '' THEN 'unavailable' WHEN contains(reply, 'Scope:') AND contains(reply, 'Uncertainty:') THEN 'available' ELSE 'malformed' END AS state FROM r", r=REPLIES))
def advisory_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, REPLIES).select("conv_id", "turn", ledger.advisory(F.col("reply")).alias("state"))


ASSETS = "SELECT o_custkey AS bundle_key, CASE WHEN o_custkey % 9 <> 0 THEN 'a' || o_orderkey END AS asset, CASE WHEN o_orderkey % 7 > 0 AND o_custkey % 9 <> 0 THEN 'd' || o_orderkey END AS derivative FROM {orders}"


@query(duck("SELECT bundle_key, CASE WHEN count(asset) = 0 THEN 'no-visuals' WHEN count(derivative) = count(*) THEN 'available' ELSE 'incomplete-optional' END AS disposition FROM a GROUP BY 1", a=ASSETS))
def visual_dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.visual_disposition(rows(spark, sf_dir, ASSETS))


# texts and replies

MARKED = "SELECT doc_id, '<!--@@chapter c' || doc_id || '-->' || text || '<!-- kept --><!--@@formula-->' AS t FROM {documents}"


@query(duck("SELECT doc_id, md5(text || '<!-- kept -->') AS plain FROM m JOIN {documents} USING (doc_id)", m=MARKED))
def without_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, MARKED).select("doc_id", F.md5(T.without_markers(F.col("t")).cast("binary")).alias("plain"))


TICKS = "SELECT conv_id, turn, text || repeat('`', CAST(conv_id % 6 AS INT)) || ' x ' || repeat('`', CAST(turn % 5 AS INT)) AS t FROM {conversations}"


@query(duck("SELECT conv_id, turn, greatest(3, coalesce(list_max(list_transform(regexp_extract_all(t, '`+'), lambda x: length(x))), 0) + 1)::INTEGER AS n FROM x", x=TICKS))
def fence_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, TICKS).select("conv_id", "turn", T.fence_length(F.col("t")).alias("n"))


LABELLED = "SELECT l_orderkey, l_linenumber, l_partkey, 'see [' || lower(l_returnflag) || '-' || l_suppkey || '], [' || l_linestatus || '] and [' || l_returnflag || '-' || l_suppkey || '] []' AS t FROM {lineitem}"


@query(duck("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag || '-' || l_suppkey || ',' || l_linestatus AS found FROM {lineitem}"))
def bracket_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, LABELLED).select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(T.labels(F.col("t")), ",").alias("found"))


STEMS = "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'epic-book-0' || p_partkey WHEN p_partkey % 3 = 1 THEN 'book' || p_partkey ELSE 'the-sea-and-sky' END AS stem FROM {part}"


@query(duck("SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN 'The Sea And Sky' ELSE 'Book ' || p_partkey END AS name FROM s", s=STEMS))
def display_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, STEMS).select("p_partkey", T.display_name(F.col("stem")).alias("name"))


#: A packet in a reply: alone, fenced after prose, after other JSON, in an object, or none at all.
SAID = """SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN '{{"claims": [' || conv_id || ']}}' WHEN 1 THEN 'Here, ' || role || ':' || chr(10) || '```json' || chr(10) || '{{"claims": [' || turn || ']}}' || chr(10) || '```' || chr(10) || 'Done'
 WHEN 2 THEN ' {{"a": {{"claims": [2]}}}} ' WHEN 3 THEN 'no packet {{' ELSE 'I found {{"x": 1}} and {{"claims": [3]}} here' END AS t FROM {conversations}"""
PLAIN_SAID = SAID.replace("{{", "{").replace("}}", "}")


@query(duck("""SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN '{"claims": [' || conv_id || ']}' WHEN 1 THEN '{"claims": [' || turn || ']}' WHEN 2 THEN '{"a": {"claims": [2]}}' WHEN 4 THEN '{"claims": [3]}' END AS packet FROM {conversations}"""))
def packet_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, SAID).select("conv_id", "turn", replies.packets(F.col("t")).alias("packet"))


PROPOSED = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '{{"found": true}}' WHEN o_orderkey % 3 = 1 THEN 'So {{"x": ' || o_custkey || '}} then {{"found": false, "why": "' || o_orderstatus || '"}}.' ELSE '{{"lost": true}}' END AS t FROM {orders}"""


@query(duck("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '{"found": true}' WHEN 1 THEN '{"found": false, "why": "' || o_orderstatus || '"}' END AS proposal FROM {orders}"""))
def repair_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, PROPOSED).select("o_orderkey", replies.repairs(F.col("t")).alias("proposal"))


VERSIONS = "SELECT c_custkey, 'a' || c_nationkey || chr(10) || c_name || chr(10) AS b, 'a' || c_nationkey || chr(10) || CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'new ' || c_custkey END || chr(10) AS a FROM {customer}"


@query(duck("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '--- before/p.md' || chr(10) || '+++ after/p.md' || chr(10) || '@@ -1,2 +1,2 @@' || chr(10) || ' a' || c_nationkey || chr(10) || '-' || c_name || chr(10) || '+new ' || c_custkey || chr(10) END AS diff FROM {customer}"))
def page_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, VERSIONS).select("c_custkey", replies.unified_diff(F.col("b"), F.col("a"), F.lit("p.md")).alias("diff"))


@query(duck("SELECT c_custkey AS line, 'confidence,stance' AS missing FROM {customer} WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'claim,claim_id,confidence,excerpt,independence_group,locator,note,source_ids,stance,verified_at' FROM {customer} WHERE c_custkey % 3 = 1"))
def required_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of JSON a customer: without two keys, no object, or with all."""
    keys = [k for k in ledger.CLAIM_KEYS if k not in ("stance", "confidence")]
    part = lambda names: ", ".join(f'"{k}": ' for k in names).replace(": ,", ": null,") + "null"
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, F.concat(F.lit("{" + part(keys) + ', "id": '), k.cast("string"), F.lit("}"))).when(k % 3 == 1, F.concat(F.lit("["), k.cast("string"), F.lit("]"))).otherwise("{" + part(ledger.CLAIM_KEYS) + "}")
    return ledger.missing_keys(table(spark, sf_dir, "customer").select(k.alias("line"), raw.alias("raw")), "raw", "line", ledger.CLAIM_KEYS)


#: Excerpts of benchmark passages as they are, wrapped, with an elided gap, or with words changed.
EXCERPTS = "SELECT item_id, text, CASE WHEN item_id % 4 = 0 THEN replace(text, ' ', chr(10) || ' ') WHEN item_id % 4 = 1 THEN lower(text) WHEN item_id % 4 = 2 THEN 'Nowhere ' || text ELSE '' END AS excerpt FROM {benchmark}"


@query(duck("SELECT item_id, item_id % 4 < 2 AS is_grounded FROM e", e=EXCERPTS))
def grounding_truth_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = rows(spark, sf_dir, EXCERPTS).select("item_id", T.fold(F.col("excerpt")).alias("n"), T.fold(F.col("text")).alias("h"))
    plain = folded.withColumn("plain", T.grounded(F.col("n"), F.col("h")))
    return plain.select("item_id", (F.col("plain") | F.coalesce(T.elided_udf(T.trim_quotes(F.col("n")), F.col("h")), F.lit(False))).alias("is_grounded"))


# readings

CITED = "SELECT doc_id AS claim_id, doc_id % 50 AS reading_id, lang AS source_file, substr(text, 1, 12) AS excerpt FROM {documents} WHERE length(text) > 40"
ASSIGNED = "SELECT doc_id % 50 AS reading_id, lang AS source_file, text AS body FROM {documents} WHERE doc_id % 3 > 0"


@query(duck("SELECT claim_id, count(body) AS n_spans FROM c LEFT JOIN a ON a.reading_id = c.reading_id AND a.source_file = c.source_file AND contains(body, excerpt) GROUP BY 1", c=CITED, a=ASSIGNED))
def reading_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.bindings(rows(spark, sf_dir, CITED), rows(spark, sf_dir, ASSIGNED))


EVIDENCE = "SELECT conv_id AS work_id, turn AS pos, text AS body FROM {conversations} WHERE turn < 3"


@query(duck("""
WITH j AS (SELECT work_id, string_agg(body, '' ORDER BY pos) AS t FROM e GROUP BY 1), w AS (SELECT conv_id AS work_id, left(text, 20) AS value FROM {conversations})
SELECT work_id, value FROM w LEFT JOIN j USING (work_id) WHERE NOT coalesce(contains(t, value), false)
""", e=EVIDENCE))  # fmt: skip
def missing_bibliography(spark: SparkSession, sf_dir: str) -> DataFrame:
    works = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("work_id")).agg(F.collect_list(F.substring("text", 1, 20)).alias("values"))
    return reading.missing_bibliography(works, rows(spark, sf_dir, EVIDENCE))


@query(duck("""
SELECT DISTINCT s_suppkey AS section_id, 'unused context' AS "check" FROM {supplier} WHERE s_suppkey NOT IN (SELECT l_suppkey FROM {lineitem} WHERE l_quantity > 47 AND l_tax > 0.06)
UNION ALL SELECT DISTINCT l_suppkey, 'excluded but used' FROM {lineitem} WHERE l_quantity > 47 AND l_tax > 0.06 AND l_suppkey % 5 = 0
"""))
def context_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = rows(spark, sf_dir, "SELECT s_suppkey AS section_id FROM {supplier}")
    used = rows(spark, sf_dir, "SELECT l_suppkey AS section_id FROM {lineitem} WHERE l_quantity > 47 AND l_tax > 0.06")
    return reading.context_defects(s, used, s.where("section_id % 5 = 0"), "section_id")


OWNED, PLANNED = "SELECT l_orderkey AS section_id FROM {lineitem} WHERE l_returnflag <> 'N'", "SELECT o_orderkey AS section_id FROM {orders}"
DIFFERS = "SELECT section_id, coalesce(x, 0) AS n_left, coalesce(y, 0) AS n_right FROM (SELECT section_id, count(*) AS x FROM a GROUP BY 1) FULL JOIN (SELECT section_id, count(*) AS y FROM b GROUP BY 1) USING (section_id) WHERE coalesce(x, 0) <> coalesce(y, 0)"


@query(duck(DIFFERS, a=OWNED, b=PLANNED))
def reading_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.ownership(rows(spark, sf_dir, OWNED), rows(spark, sf_dir, PLANNED), "section_id")


COVERED, PRIMARY = "SELECT user_id AS section_id FROM {events} WHERE event_type = 'view'", "SELECT user_id AS section_id FROM {events} WHERE event_type = 'click'"


@query(duck(DIFFERS, a=COVERED, b=PRIMARY))
def unit_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.uncovered(rows(spark, sf_dir, COVERED), rows(spark, sf_dir, PRIMARY), "section_id")


READINGS = "SELECT l_orderkey AS reading_id, CASE WHEN l_linenumber > 3 THEN 'context' ELSE 'primary' END AS role, l_partkey AS section_id FROM {lineitem}"


@query(duck("SELECT reading_id, role, sum(length(p_name))::BIGINT AS tokens FROM (SELECT DISTINCT * FROM r) JOIN {part} ON p_partkey = section_id GROUP BY ALL", r=READINGS))
def reading_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading.budget(rows(spark, sf_dir, READINGS), table(spark, sf_dir, "part").select(F.col("p_partkey").alias("section_id"), F.length("p_name").alias("tokens")))


@query("SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^ ]', '', 'g')) + 1 AS tokens FROM documents")
def token_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter that is given: here one token for each part between blanks."""
    return reading.with_tokens(table(spark, sf_dir, "documents"), "text", lambda x: F.size(F.split(x, " ", -1))).select("doc_id", "tokens")


# identities and histories

DROPS = """SELECT 'c' || o_orderkey AS claim_id, CASE WHEN o_orderkey % 4 = 0 THEN 'repair' ELSE 'drop' END AS event, CASE WHEN o_orderkey % 5 = 0 THEN 'x' END AS new_excerpt, CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE 'gone' END AS reason, CASE WHEN o_orderkey % 11 > 0 THEN 'a1' END AS attempt_id,
 's0' AS state_before, CASE WHEN o_orderkey % 13 = 0 THEN 's0' ELSE 's1' END AS state_after, 'f' || o_custkey % 10 AS source_file, CASE WHEN o_orderkey % 17 > 0 THEN 'r' END AS source_revision FROM {orders}"""
BOUND = "SELECT 'c' || o_orderkey AS claim_id, 'f' || o_custkey % 9 AS source_file, CASE WHEN o_orderkey % 17 > 0 THEN 'r' END AS source_revision FROM {orders} WHERE o_orderkey % 6 > 0"


@query(duck("""
WITH j AS (SELECT e.*, b.source_file AS f, b.source_revision AS r FROM e LEFT JOIN b USING (claim_id) WHERE event = 'drop')
SELECT 'binding differs' AS "check", claim_id FROM j WHERE source_file IS DISTINCT FROM f OR source_revision IS DISTINCT FROM r UNION ALL SELECT 'drop has an excerpt', claim_id FROM j WHERE new_excerpt IS NOT NULL
UNION ALL SELECT 'no reason', claim_id FROM j WHERE trim(reason) = '' UNION ALL SELECT 'no attempt', claim_id FROM j WHERE attempt_id IS NULL UNION ALL SELECT 'state unchanged', claim_id FROM j WHERE state_before = state_after
""", e=DROPS, b=BOUND))  # fmt: skip
def drop_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.drop_violations(rows(spark, sf_dir, DROPS), rows(spark, sf_dir, BOUND))


@query(duck("""
WITH a AS (SELECT event_id FROM {events} WHERE event_id % 5 > 0), b AS (SELECT event_id FROM {events} WHERE event_id % 7 > 0), d AS (SELECT event_id FROM {events} WHERE event_id % 3 = 0)
SELECT event_id AS claim_id, 'left' AS side FROM a WHERE event_id NOT IN (FROM b) AND event_id NOT IN (FROM d) UNION ALL SELECT event_id, 'right' FROM d WHERE event_id NOT IN (SELECT event_id FROM a WHERE event_id NOT IN (FROM b)) UNION ALL SELECT event_id, 'new' FROM b WHERE event_id NOT IN (FROM a)
"""))
def unaccounted_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("claim_id"))
    return identity.unaccounted(e.where("claim_id % 5 > 0"), e.where("claim_id % 7 > 0"), e.where("claim_id % 3 = 0"))


FAILED = "SELECT user_id AS worker, event_id AS pos, CASE WHEN user_id % 3 = 0 THEN 'b' || event_id % 2 ELSE 'b' || user_id END AS binding FROM {events}"


@query(duck("SELECT worker, arg_min(binding, pos) AS binding, count(DISTINCT binding) > 1 AS incompatible FROM f GROUP BY 1", f=FAILED))
def packet_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.packet_bindings(rows(spark, sf_dir, FAILED))


ROWS = "SELECT o_orderkey AS pos, 'c' || o_orderkey AS claim_id, o_orderpriority AS claim, o_orderstatus AS stance, 'f' AS source_file, 'old' AS excerpt, 'p0' AS packet_state_revision FROM {orders} WHERE o_orderkey % 10 > 0"
LIVE = "SELECT 'c' || o_orderkey AS claim_id, o_orderpriority AS claim, CASE WHEN o_orderkey % 8 = 0 THEN 'X' ELSE o_orderstatus END AS stance, 'f' AS source_file, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS excerpt, 'p1' AS packet_state_revision FROM {orders} WHERE o_orderkey % 7 > 0"
GONE = "SELECT 'c' || o_orderkey AS claim_id FROM {orders} WHERE o_orderkey % 14 = 0"


def _synchronised(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return identity.synchronised(*(rows(spark, sf_dir, x) for x in (ROWS, LIVE, GONE)))


@query(duck("SELECT r.pos, claim_id, l.excerpt, l.packet_state_revision FROM r JOIN l USING (claim_id)", r=ROWS, l=LIVE))
def synchronised_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synchronised(spark, sf_dir)[0].select("pos", "claim_id", "excerpt", "packet_state_revision")


@query(duck("""
SELECT 'live claim has no ledger row' AS "check", claim_id FROM l WHERE claim_id NOT IN (SELECT claim_id FROM r) UNION ALL SELECT 'ledger row is neither live nor dropped', claim_id FROM r WHERE claim_id NOT IN (SELECT claim_id FROM l) AND claim_id NOT IN (SELECT claim_id FROM g)
UNION ALL SELECT 'immutable field differs', claim_id FROM r JOIN l USING (claim_id) WHERE r.stance <> l.stance
""", r=ROWS, l=LIVE, g=GONE))  # fmt: skip
def synchronised_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synchronised(spark, sf_dir)[1]


NAMED = "SELECT DISTINCT user_id AS worker, 'c-' || event_id % 40 AS alias FROM {events} WHERE event_type = 'error'"
PRESENT = "SELECT DISTINCT user_id AS worker, 'c-' || event_id % 30 AS claim_id FROM {events} WHERE event_type = 'view'"
OTHERS = "SELECT DISTINCT user_id AS worker, 'c-' || event_id % 50 AS alias, 'c-' || event_id % 3 AS claim_id FROM {events} WHERE event_type = 'click'"


@query(duck("""
WITH n AS (SELECT worker, claim_id AS alias, claim_id FROM l UNION SELECT worker, alias, claim_id FROM o)
SELECT worker, alias, min(claim_id) AS claim_id, count(DISTINCT claim_id) AS n FROM f LEFT JOIN n USING (worker, alias) GROUP BY ALL
""", f=NAMED, l=PRESENT, o=OTHERS))  # fmt: skip
def report_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.report_targets(*(rows(spark, sf_dir, x) for x in (NAMED, PRESENT, OTHERS)))


ANSWERS = "SELECT event_id AS claim_id, CASE WHEN event_id % 9 > 0 THEN event_type <> 'error' END AS found, CASE WHEN event_id % 4 > 0 THEN value > 100 END AS is_grounded FROM {events}"


@query(duck("SELECT CASE WHEN coalesce(found, false) AND coalesce(is_grounded, false) THEN 'repair' ELSE 'drop' END AS decision, count(*) AS n FROM a GROUP BY 1", a=ANSWERS))
def repair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.repair_counts(identity.repair_decisions(rows(spark, sf_dir, ANSWERS)))


OLD_ROWS = "SELECT o_orderkey AS at, o_orderpriority AS claim, o_orderstatus AS stance, 'f' AS source_file, '1' AS locator, 'e' AS excerpt, md5(CAST(o_custkey AS STRING)) AS sha256 FROM {orders} WHERE o_orderkey % 10 > 0"
NEW_ROWS = "SELECT o_orderkey AS at, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS claim, o_orderstatus AS stance, 'f' AS source_file, '1' AS locator, 'e' AS excerpt, md5(CASE WHEN o_orderkey % 9 = 0 THEN 'other' ELSE CAST(o_custkey AS STRING) END) AS sha256 FROM {orders} WHERE o_orderkey % 11 > 0"


@query(duck("""
SELECT coalesce(n.at, o.at) AS at, CASE WHEN o.at IS NULL THEN 'no row' WHEN n.at IS NULL THEN 'no claim' WHEN n.claim IS NULL THEN 'fields differ' ELSE 'digest differs' END AS "check" FROM n FULL JOIN o ON n.at = o.at WHERE o.at IS NULL OR n.at IS NULL OR n.claim IS NULL OR n.sha256 <> o.sha256
""", n=NEW_ROWS, o=OLD_ROWS))  # fmt: skip
def legacy_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.legacy_differences(rows(spark, sf_dir, NEW_ROWS), rows(spark, sf_dir, OLD_ROWS))


# plans and publication

REVIEWED = "SELECT 'p/' || doc_id AS path, md5(text) AS sha256 FROM {documents} WHERE doc_id % 9 > 0"
COMMITTED = "SELECT 'p/' || doc_id AS path, md5(CASE WHEN doc_id % 10 = 0 THEN 'changed' ELSE text END) AS sha256 FROM {documents} WHERE doc_id % 7 > 0"
TRACKED = "SELECT 'p/' || doc_id AS path FROM {documents} WHERE doc_id % 4 > 0"


@query(duck("SELECT path, CASE WHEN b.sha256 IS NULL THEN 'missing' ELSE 'digest differs' END AS \"check\" FROM t LEFT JOIN a USING (path) LEFT JOIN b USING (path) WHERE b.sha256 IS NULL OR a.sha256 IS DISTINCT FROM b.sha256", t=TRACKED, a=REVIEWED, b=COMMITTED))
def required_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.required_outputs(*(rows(spark, sf_dir, x) for x in (TRACKED, REVIEWED, COMMITTED)))


@query(duck("""
SELECT path, 'after review: ' || CASE WHEN a.sha256 IS NULL THEN 'added' WHEN b.sha256 IS NULL THEN 'removed' ELSE 'changed' END AS "check" FROM a FULL JOIN b USING (path) WHERE a.sha256 IS DISTINCT FROM b.sha256
UNION ALL SELECT path, 'not tracked' FROM a WHERE path NOT IN (SELECT path FROM t)
""", t=TRACKED, a=REVIEWED, b=COMMITTED))  # fmt: skip
def output_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.output_differences(*(rows(spark, sf_dir, x) for x in (REVIEWED, COMMITTED, TRACKED)))


def _note(of: str, where: str) -> str:
    return f"SELECT 'f' || c_custkey AS source_file, '{of} ' || c_nationkey AS note FROM {{customer}} WHERE {where}"


BASE, BUNDLE, UNIT = _note("base", "c_custkey % 5 > 0"), _note("bundle", "c_custkey % 3 = 0"), _note("unit", "c_custkey % 4 = 0")


@query(duck("SELECT source_file, coalesce(u.note, b.note, a.note) AS note FROM a FULL JOIN b USING (source_file) FULL JOIN u USING (source_file)", a=BASE, b=BUNDLE, u=UNIT))
def overlaid_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.overlaid_notes(*(rows(spark, sf_dir, x) for x in (BASE, BUNDLE, UNIT)))


@query(duck("SELECT n_nationkey AS book, lower(r_name) AS variant, 'book-' || n_nationkey || '-' || lower(r_name) || '.html' AS source_file, 'Book ' || n_nationkey AS note FROM {nation}, {region}"))
def source_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.source_maps(rows(spark, sf_dir, "SELECT n_nationkey AS book FROM {nation}"), rows(spark, sf_dir, "SELECT lower(r_name) AS variant FROM {region}"), "book-{book}-{variant}.html", "Book {book}")


UNITS = "SELECT o_orderkey AS unit_id, CASE WHEN o_orderkey % 6 > 0 THEN o_custkey END AS tokens, o_orderkey % 100 AS bytes, o_orderstatus = 'P' AS unresolved FROM {orders}"


@query(duck("SELECT count(*) AS units, sum(tokens)::BIGINT AS tokens, sum(bytes)::BIGINT AS bytes, count(*) FILTER (WHERE unresolved) AS unresolved, 3 * count(*) + (SELECT count(*) FROM {customer}) AS least_requests FROM u", u=UNITS))
def planning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.planning_report(rows(spark, sf_dir, UNITS), table(spark, sf_dir, "customer"))


@query(duck("SELECT unit_id FROM u WHERE unresolved", u=UNITS))
def unresolved_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.unresolved(rows(spark, sf_dir, UNITS))


SPECS, STORED = "SELECT c_custkey AS worker, 'p' || c_nationkey AS provenance FROM {customer}", "SELECT c_custkey AS worker, 'p' || CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE c_nationkey END AS provenance, c_custkey % 3 AS n_defects FROM {customer} WHERE c_custkey % 5 > 0"


@query(duck("SELECT worker, CASE WHEN t.provenance = s.provenance AND n_defects = 0 THEN 'reused' ELSE 'pending' END AS state FROM s LEFT JOIN t USING (worker)", s=SPECS, t=STORED))
def packet_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    reused, pending = coverage.reuse(rows(spark, sf_dir, SPECS), rows(spark, sf_dir, STORED))
    return reused.select("worker", F.lit("reused").alias("state")).unionByName(pending.select("worker", F.lit("pending").alias("state")))


FIGURES = "SELECT CASE WHEN p_partkey % 11 = 0 THEN '../' ELSE 'fig/' END || p_partkey AS path, md5(p_name) AS sha256 FROM {part}"
FOUND = "SELECT CASE WHEN p_partkey % 11 = 0 THEN '../' ELSE 'fig/' END || p_partkey AS path, md5(CASE WHEN p_partkey % 6 = 0 THEN 'x' ELSE p_name END) AS sha256 FROM {part} WHERE p_partkey % 4 > 0 UNION ALL SELECT 'fig/' || p_partkey, md5(p_name) FROM {part} WHERE p_partkey % 10 = 1"


@query(duck("""
WITH n AS (SELECT path, count(*) AS n, min(sha256) AS got FROM a GROUP BY 1), j AS (SELECT s.path, s.sha256, n, got FROM s LEFT JOIN n USING (path))
SELECT path, CASE WHEN contains(path, '..') THEN 'unsafe path' WHEN n IS NULL THEN 'no asset' WHEN n > 1 THEN 'several assets' ELSE 'digest differs' END AS "check" FROM j WHERE contains(path, '..') OR n IS NULL OR n > 1 OR got <> sha256
""", s=FIGURES, a=FOUND))  # fmt: skip
def visual_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.visual_matches(rows(spark, sf_dir, FIGURES), rows(spark, sf_dir, FOUND))


STEPS_PLANNED = "SELECT o_orderkey AS pos, 'u' || o_custkey AS unit_id, md5(CAST(o_orderkey AS STRING)) AS input_sha256 FROM {orders} WHERE o_orderkey % 13 > 0"
STEPS_DONE = "SELECT o_orderkey AS pos, CASE WHEN o_orderkey % 7 = 0 THEN 'other' ELSE 'u' || o_custkey END AS unit_id, md5(CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE CAST(o_orderkey AS STRING) END) AS input_sha256 FROM {orders} WHERE o_orderkey % 11 > 0"


@query(duck("""
SELECT coalesce(u.pos, o.pos) AS pos, CASE WHEN o.pos IS NULL THEN 'no outcome' WHEN u.pos IS NULL THEN 'extra outcome' WHEN u.unit_id <> o.unit_id THEN 'other unit' ELSE 'other input' END AS "check" FROM u FULL JOIN o ON u.pos = o.pos WHERE u.pos IS NULL OR o.pos IS NULL OR u.unit_id <> o.unit_id OR u.input_sha256 <> o.input_sha256
""", u=STEPS_PLANNED, o=STEPS_DONE))  # fmt: skip
def unit_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.unit_outcomes(rows(spark, sf_dir, STEPS_PLANNED), rows(spark, sf_dir, STEPS_DONE))


WRITTEN = "SELECT 'write' AS action, 'c/' || c_custkey || '.md' AS path FROM {customer} UNION ALL SELECT 'write', 'sum.md'"
APPLIED = "SELECT 'write' AS action, 'c/' || c_custkey || '.md' AS path FROM {customer} WHERE c_custkey % 8 > 0 UNION ALL SELECT 'write', 'sum.md'"
BODIES = "SELECT 'c/' || c_custkey || '.md' AS path, CASE WHEN c_custkey % 6 > 0 THEN 'see [[sum]] ' || c_name ELSE c_name END AS text FROM {customer} WHERE c_custkey % 9 > 0 UNION ALL SELECT 'sum.md', 'x'"


@query(duck("""
SELECT 'planned and applied differ' AS "check", path FROM w WHERE path NOT IN (SELECT path FROM a) UNION ALL SELECT 'no backlink', path FROM w LEFT JOIN b USING (path) WHERE path <> 'sum.md' AND NOT coalesce(contains(text, 'sum'), false)
""", w=WRITTEN, a=APPLIED, b=BODIES))  # fmt: skip
def compile_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.completion(*(rows(spark, sf_dir, x) for x in (WRITTEN, APPLIED, BODIES)), "sum.md").distinct()


SEEN_ASSETS = "SELECT 'a' || s_suppkey AS asset, md5(s_name) AS sha256, s_suppkey % 2 = 0 AS required FROM {supplier} WHERE s_suppkey % 10 > 0"
INSPECTED = "SELECT 'a' || s_suppkey AS asset, md5(s_name) AS input_sha256, md5(CASE WHEN s_suppkey % 7 = 0 THEN 'x' ELSE s_name END) AS inspected_sha256, s_suppkey AS tokens FROM {supplier} WHERE s_suppkey % 3 > 0 UNION ALL SELECT 'a' || s_suppkey, md5(s_name), md5(s_name), 1 FROM {supplier} WHERE s_suppkey % 11 = 1"


@query(duck("""
SELECT DISTINCT asset, CASE WHEN i.tokens IS NULL THEN 'required but not inspected' ELSE 'digest differs' END AS "check" FROM a LEFT JOIN i USING (asset) WHERE (required AND i.tokens IS NULL) OR (i.tokens IS NOT NULL AND (sha256 <> input_sha256 OR sha256 <> inspected_sha256))
UNION ALL SELECT asset, 'unknown asset' FROM i WHERE asset NOT IN (SELECT asset FROM a) UNION ALL SELECT asset, 'several records' FROM i GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT NULL, 'token budget' FROM (SELECT sum(tokens) AS n FROM i) WHERE n > 20
""", a=SEEN_ASSETS, i=INSPECTED))  # fmt: skip
def context_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.context_violations(rows(spark, sf_dir, INSPECTED), rows(spark, sf_dir, SEEN_ASSETS), 20)


BUNDLE_CALLS = "SELECT o_custkey AS bundle_key, 'a' || o_orderkey AS asset, CASE WHEN o_orderkey % 9 > 0 THEN 'ok' END AS result, CASE WHEN o_orderkey % 3 = 0 THEN 'seen' WHEN o_orderkey % 3 = 1 THEN ' ' END AS note FROM {orders} WHERE o_orderkey % 12 > 0"
BUNDLE_LIST = "SELECT o_custkey AS bundle_key, 'a' || o_orderkey AS asset FROM {orders}"


@query(duck("""
WITH d AS (SELECT DISTINCT bundle_key, asset FROM c WHERE result IS NOT NULL), n AS (SELECT bundle_key, bool_or(coalesce(trim(note) <> '', false)) AS noted FROM c GROUP BY 1), j AS (SELECT l.bundle_key, bool_and(d.asset IS NOT NULL) AS whole FROM l LEFT JOIN d USING (bundle_key, asset) GROUP BY 1)
SELECT bundle_key, CASE WHEN whole AND coalesce(noted, false) THEN 'complete' ELSE 'incomplete' END AS state FROM j LEFT JOIN n USING (bundle_key)
""", c=BUNDLE_CALLS, l=BUNDLE_LIST))  # fmt: skip
def inspected_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.inspected(rows(spark, sf_dir, BUNDLE_CALLS), rows(spark, sf_dir, BUNDLE_LIST))


IMAGES = "SELECT CASE WHEN page_id % 4 = 0 THEN url || '.png' WHEN page_id % 4 = 1 THEN 'img/' || page_id || '.PNG' WHEN page_id % 4 = 2 THEN '../' || page_id || '.png' ELSE 'img/' || page_id || '.svg' END AS path FROM {pages}"


@query(duck("SELECT path, CASE WHEN regexp_matches(path, '^[a-z]+:') THEN 'not local' WHEN starts_with(path, '..') THEN 'unsafe path' ELSE 'suffix not allowed' END AS \"check\" FROM i WHERE NOT ends_with(path, '.PNG')", i=IMAGES))
def bad_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.bad_images(rows(spark, sf_dir, IMAGES), "path")


SNAPSHOTS = "SELECT DISTINCT CASE WHEN c_nationkey % 6 = 5 THEN 'notes-' || c_nationkey || '.txt' ELSE 'book-' || c_nationkey || '-' || CASE WHEN c_custkey % 3 = 0 THEN 'english' ELSE 'latin' END || '.html' END AS name FROM {customer} WHERE c_nationkey % 4 > 0"


@query(duck("""
SELECT 'unexpected file' AS "check", name AS detail FROM s WHERE starts_with(name, 'notes') UNION ALL SELECT 'missing witness file', n_nationkey || '/' || v FROM {nation}, (VALUES ('latin'), ('english')) t(v) WHERE 'book-' || n_nationkey || '-' || v || '.html' NOT IN (SELECT name FROM s)
""", s=SNAPSHOTS))  # fmt: skip
def snapshot_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = spark.createDataFrame([("latin",), ("english",)], "variant string")
    return publication.snapshot_gaps(rows(spark, sf_dir, SNAPSHOTS), "name", r"\Abook-(\d+)-(\w+)\.html\z", rows(spark, sf_dir, "SELECT CAST(n_nationkey AS INT) AS book FROM {nation}"), variants)


SECTIONS = "SELECT doc_id AS section_id, 'assets/k/original/' || doc_id || '.md#L1-L3' AS target, '# Title ' || doc_id || ' ' || chr(10) || text AS body FROM {documents}"


@query(duck("""SELECT section_id, '{"section_id":' || section_id || ',"target":"assets/k/original/' || section_id || '.md#L1-L3","heading":"# Title ' || section_id || '"}' AS row FROM s""", s=SECTIONS))
def citation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publication.citation_rows(rows(spark, sf_dir, SECTIONS))


PATHS = "SELECT page_id, 'd e/é+' || page_id || '/' || lower(substr(url, 1, 4)) || '.md' AS path, page_id % 50 + 1 AS first FROM {pages}"


@query(duck("SELECT page_id, 'assets/k/original/d%20e/%C3%A9%2B' || page_id || '/http.md#L' || first || '-L' || (first + 2) AS target FROM p", p=PATHS))
def citation_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, PATHS).select("page_id", publication.citation_target(F.lit("k"), F.col("path"), F.col("first"), F.col("first") + 3).alias("target"))


# journals

COUNTED = "SELECT user_id AS run, CAST(event_id % 30 AS INT) AS tokens FROM {events} WHERE event_type <> 'view'"
STATED = "SELECT user_id AS run, count(*) - CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END AS requests, sum(event_id % 30) + CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS tokens FROM {events} WHERE event_type <> 'view' GROUP BY user_id"


@query(duck("SELECT run, 'requests differ' AS \"check\" FROM s WHERE run % 4 = 0 UNION ALL SELECT run, 'tokens differ' FROM s WHERE run % 3 = 0", s=STATED))
def budget_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.reconciliation(rows(spark, sf_dir, STATED), rows(spark, sf_dir, COUNTED), "run")


@query(duck("SELECT conv_id, turn, 'p' || least(turn, 2) AS profile FROM {conversations}"))
def fallback_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", journal.fallback(F.array(F.lit("p0"), F.lit("p1"), F.lit("p2")), F.col("turn")).alias("profile"))


FAILURES = "SELECT event_id, CASE WHEN event_id % 3 > 0 THEN CAST(400 + event_id % 130 AS INT) END AS status, CASE WHEN event_id % 4 = 0 THEN 'ReadTimeout' WHEN event_id % 4 = 1 THEN 'ConnectError' ELSE 'ValueError' END AS kind FROM {events}"


@query(duck("SELECT event_id, CASE WHEN status IN (401, 403) THEN 'authentication' WHEN status = 429 THEN 'rate_limited' WHEN status IN (408, 504) THEN 'timeout' WHEN status >= 500 THEN 'unavailable' WHEN status >= 400 THEN 'invalid_request' WHEN kind = 'ReadTimeout' THEN 'timeout' WHEN kind = 'ConnectError' THEN 'unavailable' ELSE 'failed' END AS class FROM f", f=FAILURES))
def error_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, FAILURES).select("event_id", journal.error_class(F.col("status"), F.col("kind")).alias("class"))


USED = "SELECT event_id, event_id % 50 - 3 AS p, CASE WHEN event_id % 7 > 0 THEN event_id % 20 END AS c, CASE WHEN event_id % 4 = 0 THEN event_id % 90 - 10 END AS t FROM {events}"


@query(duck("SELECT event_id, CASE WHEN t >= 0 THEN t WHEN p >= 0 AND c >= 0 THEN p + c END AS tokens FROM u", u=USED))
def usage_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, USED).select("event_id", journal.usage(F.col("p"), F.col("c"), F.col("t")).alias("tokens"))


@query(duck("SELECT conv_id, turn, strlen(text) + 1024 + 256 * turn + conv_id AS n FROM {conversations}"))
def envelope_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", journal.envelope_bytes(F.col("text"), F.col("turn"), F.col("conv_id")).alias("n"))


ENDED = "SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'stop' WHEN 1 THEN 'length' END AS f, CASE WHEN conv_id % 5 = 0 THEN '  ' ELSE text END AS c FROM {conversations}"


@query(duck("SELECT conv_id, turn, coalesce(f = 'stop' AND trim(c) <> '', false) AS ok FROM e", e=ENDED))
def accepted_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, ENDED).select("conv_id", "turn", journal.accepted(F.col("f"), F.col("c")).alias("ok"))


TO_DO = "SELECT o_orderkey AS pos, 'u' || o_custkey AS unit_id, o_orderpriority AS input_sha256, o_orderstatus AS output_sha256 FROM {orders}"
DONE = "SELECT o_orderkey AS pos, 'u' || o_custkey AS unit_id, CASE WHEN o_orderkey % 1009 = 700 THEN 'x' ELSE o_orderpriority END AS input_sha256, o_orderstatus AS output_sha256 FROM {orders}"


@query(duck("SELECT u.pos, u.pos < (SELECT coalesce(min(u.pos), 1e18::BIGINT) FROM u LEFT JOIN d USING (pos) WHERE d.input_sha256 IS DISTINCT FROM u.input_sha256) AS skip FROM u", u=TO_DO, d=DONE))
def resumable_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.resumable(rows(spark, sf_dir, DONE), rows(spark, sf_dir, TO_DO)).select("pos", "skip")


#: Runs of states in order; some skip one, some fail, some go on after the end.
STATES = "SELECT conv_id AS run, turn AS seq, CASE WHEN conv_id % 6 = 0 AND turn = 3 THEN 'FAILED' WHEN conv_id % 5 = 0 AND turn = 2 THEN 'COMPILING' WHEN turn = 0 THEN 'PLANNING' WHEN turn = 1 THEN 'RESEARCHING' WHEN turn = 2 THEN 'VERIFYING_SOURCES' WHEN turn = 3 THEN 'COMPILING' WHEN turn = 4 THEN 'MATERIALIZING_LEDGER' WHEN turn = 5 THEN 'VERIFYING_DIFF' ELSE 'READY_FOR_REVIEW' END AS state FROM {conversations}"
RANKS = "('PLANNING', 1), ('RESEARCHING', 2), ('VERIFYING_SOURCES', 3), ('COMPILING', 4), ('MATERIALIZING_LEDGER', 5), ('VERIFYING_DIFF', 6), ('READY_FOR_REVIEW', 7)"


@query(duck(f"""
WITH r AS (SELECT * FROM (VALUES {RANKS}) t(state, rank)), j AS (SELECT s.*, coalesce(r.rank, 0) AS rank, lag(s.state) OVER w AS last, lag(coalesce(r.rank, 0)) OVER w AS before FROM s LEFT JOIN r ON s.state = r.state WINDOW w AS (PARTITION BY run ORDER BY seq))
SELECT run, seq, state FROM j WHERE NOT coalesce((last IS NULL AND rank = 1) OR (rank > 0 AND before > 0 AND rank = before + 1) OR (state = 'FAILED' AND before BETWEEN 1 AND 6), false)
""", s=STATES))  # fmt: skip
def illegal_state_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.illegal_transitions(rows(spark, sf_dir, STATES), "run", "seq", "state").select("run", "seq", "state")


# witnesses and pages

CANDIDATES = "SELECT conv_id AS claim_id, turn AS pos, md5(text) AS excerpt FROM {conversations} WHERE conv_id % 7 > 0"
CHOICES = "SELECT conv_id AS claim_id, turn AS seq, (turn * 3 + conv_id) % 9 AS pos FROM {conversations} WHERE conv_id % 2 = 0"


@query(duck("""
WITH k AS (SELECT DISTINCT conv_id AS claim_id FROM {conversations}), x AS (SELECT claim_id, arg_max(pos, seq) AS wanted FROM h GROUP BY 1)
SELECT claim_id, coalesce(min(excerpt) FILTER (WHERE pos = wanted), arg_min(excerpt, pos)) AS witness_excerpt FROM k JOIN c USING (claim_id) LEFT JOIN x USING (claim_id) GROUP BY 1
""", c=CANDIDATES, h=CHOICES))  # fmt: skip
def assembled_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("claim_id")).distinct()
    return witness.assembled(claims, rows(spark, sf_dir, CANDIDATES), rows(spark, sf_dir, CHOICES))


VERBATIM = "SELECT page_id, html AS t, CASE WHEN page_id % 4 = 0 THEN '<b>' || substr(html, 400, 12) || '</b>' WHEN page_id % 4 = 1 THEN '  ' WHEN page_id % 4 = 2 THEN 'zzz qqq' ELSE substr(html, 1, 200) END AS e FROM {pages}"
VISIBLE = r"lower(trim(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')))"


@query(duck(f"SELECT page_id FROM v WHERE {VISIBLE.format('e')} <> '' AND contains({VISIBLE.format('t')}, {VISIBLE.format('e')})", v=VERBATIM))
def verbatim_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witness.verbatim_pairs(rows(spark, sf_dir, VERBATIM), "page_id", "t", "e").select("page_id")


#: Claims with a translation witness each; suppliers are the sources, nations the books that are aligned.
WITNESSED = "SELECT 'c-' || o_orderkey AS claim_id, 'Aen.' || (o_custkey % 7 + 1) || '.1' AS locator, o_orderkey % 3 = 0 AND o_orderkey % 5 = 0 AS absent, 's' || o_custkey % 12 AS source_id, CASE WHEN o_orderkey % 11 = 0 THEN 'somewhere' ELSE (o_custkey % 7 + 1 + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END) || '.1' END AS w_locator, CASE WHEN o_orderkey % 17 = 0 THEN 'arma virumque' ELSE 'Arms and the man' END AS excerpt, CASE WHEN o_orderkey % 19 = 0 THEN 'Bob' ELSE 'Ann' END AS translator FROM {orders}"
WITNESS_SOURCES = "SELECT 's' || s_suppkey AS source_id, CASE WHEN s_suppkey % 4 = 3 THEN 'canonical' ELSE 'translation' END AS role, 'Ann' AS translator, CASE WHEN s_suppkey % 5 = 4 THEN '' ELSE 'Lo, arms and the man I sing ' || s_name END AS text FROM {supplier} WHERE s_suppkey < 10"
BOOKS = "SELECT CAST(n_nationkey AS INT) AS book FROM {nation} WHERE n_nationkey BETWEEN 1 AND 5"


@query(duck("""
WITH j AS (SELECT c.*, (string_split(locator, '.'))[2]::INT AS book, TRY_CAST((string_split(w_locator, '.'))[1] AS INT) AS w_book, s.role, s.text, s.source_id IS NOT NULL AS known FROM c LEFT JOIN s USING (source_id)), l AS (SELECT *, text <> '' AS full_, book IN (SELECT book FROM b) AS has FROM j WHERE NOT absent AND known)
SELECT claim_id, 'no witness' AS "check" FROM j WHERE absent UNION ALL SELECT claim_id, 'witness source not in ledger' FROM j WHERE NOT absent AND NOT known UNION ALL SELECT claim_id, 'not a translation witness' FROM l WHERE role <> 'translation' UNION ALL SELECT claim_id, 'witness snapshot missing' FROM l WHERE NOT full_
UNION ALL SELECT claim_id, 'excerpt not verbatim' FROM l WHERE full_ AND excerpt LIKE 'arma%' UNION ALL SELECT claim_id, 'locator unparseable' FROM l WHERE full_ AND w_book IS NULL UNION ALL SELECT claim_id, 'no alignment' FROM l WHERE full_ AND w_book IS NOT NULL AND NOT has
UNION ALL SELECT claim_id, 'locator book differs' FROM l WHERE full_ AND w_book <> book AND has UNION ALL SELECT claim_id, 'translator not in sources' FROM l WHERE full_ AND w_book IS NOT NULL AND has AND translator = 'Bob'
""", c=WITNESSED, s=WITNESS_SOURCES, b=BOOKS))  # fmt: skip
def witness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.when(~F.col("absent"), F.struct("source_id", F.col("w_locator").alias("locator"), "excerpt", "translator"))
    claims = rows(spark, sf_dir, WITNESSED).select("claim_id", "locator", w.alias("witness"))
    meta = F.struct(F.lit("w").alias("source_id"), F.lit("").alias("aligned_to"))
    alignment = rows(spark, sf_dir, BOOKS).withColumn("witnesses", F.create_map(F.lit("ANN"), meta))
    return witness.witness_violations(claims, rows(spark, sf_dir, WITNESS_SOURCES), witness.aligned(alignment))


#: A wiki page a customer: links to another customer's page, by path or name, to nowhere and upwards.
WIKI = "SELECT CASE WHEN c_custkey % 10 = 0 THEN 'sources/' WHEN c_custkey % 2 = 0 THEN 'a/' ELSE '' END || 'c' || c_custkey || '.md' AS path, c_custkey AS k, 'See [[c' || (c_custkey + 3) || ']], [[a/c' || (c_custkey + 2) || '#x|other]] and [[../c1]] [one](c' || (c_custkey + 2) || '.md#top) [two](../c' || (c_custkey + 1) || '.md) [three](https://x.y/z)' AS text FROM {customer}"
RAW = "SELECT path, unnest(['c' || (k + 3), 'a/c' || (k + 2) || '#x|other', '../c1']) AS raw, unnest(['c' || (k + 3), 'a/c' || (k + 2), '../c1']) || '.md' AS file FROM s"


@query(duck(f"WITH s AS (SELECT * FROM w WHERE NOT starts_with(path, 'sources/')), r AS ({RAW}) SELECT path, raw FROM r WHERE starts_with(file, '..') OR (file NOT IN (SELECT path FROM s) AND file NOT IN (SELECT regexp_extract(path, '[^/]*$') FROM s))", w=WIKI))
def wikilink_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki.dead_wikilinks(wiki.semantic(rows(spark, sf_dir, WIKI), "path"), "path", "text")


@query(duck(f"WITH s AS (SELECT * FROM w WHERE NOT starts_with(path, 'sources/')), r AS ({RAW}) SELECT path, raw FROM r WHERE starts_with(file, '..') OR file NOT IN (SELECT path FROM s)", w=WIKI))
def wikilink_audit_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki.dead_wikilinks(wiki.semantic(rows(spark, sf_dir, WIKI), "path"), "path", "text", exact=True)


@query(duck("""
WITH s AS (SELECT * FROM w WHERE NOT starts_with(path, 'sources/')), l AS (SELECT path, 'c' || (k + 2) || '.md#top' AS target, regexp_extract(path, '^(.*/)?', 0) || 'c' || (k + 2) || '.md' AS file FROM s UNION ALL SELECT path, '../c' || (k + 1) || '.md', CASE WHEN contains(path, '/') THEN 'c' || (k + 1) || '.md' END FROM s)
SELECT path, target, CASE WHEN file IS NULL THEN 'escapes wiki' ELSE 'missing target' END AS "check" FROM l WHERE file IS NULL OR file NOT IN (SELECT path FROM w)
""", w=WIKI))  # fmt: skip
def local_link_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = rows(spark, sf_dir, WIKI)
    return wiki.dead_links(wiki.semantic(pages, "path"), pages, "path", "text")


CITES = "SELECT 'p' || doc_id AS path, CASE WHEN doc_id % 5 = 0 THEN 'other.md' ELSE 'assets/k/original/' || doc_id % 300 || '.md' END AS file, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 'L1-L3' ELSE 'L9' END AS fragment FROM {documents}"
FROZEN = "SELECT 'assets/k/original/' || doc_id || '.md' AS file, CASE WHEN doc_id % 2 = 0 THEN 'L1-L3' END AS fragment FROM {documents} WHERE doc_id < 200"


@query(duck("""
SELECT path, file, fragment, CASE WHEN file IN (SELECT file FROM f) THEN 'not a frozen section' ELSE 'not in the reading plan' END AS "check" FROM c
WHERE (file IN (SELECT file FROM f) AND NOT EXISTS (FROM f WHERE f.file = c.file AND coalesce(f.fragment, '') = coalesce(c.fragment, ''))) OR (file NOT IN (SELECT file FROM f) AND contains(file, '/original/'))
""", c=CITES, f=FROZEN))  # fmt: skip
def foreign_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki.foreign_citations(rows(spark, sf_dir, CITES), rows(spark, sf_dir, FROZEN))


BULLETS = "SELECT conv_id AS page, turn AS at, CASE WHEN turn % 4 = 0 THEN '# ' || role ELSE '- [[Book ' || (97 - conv_id * turn % 97) || ']] ' || turn END AS body FROM {conversations}"


@query(duck("""
WITH n AS (SELECT *, starts_with(body, '- ') AS b, sum(CASE WHEN starts_with(body, '- ') THEN 0 ELSE 1 END) OVER (PARTITION BY page ORDER BY "at") AS block FROM x)
SELECT page, min("at") OVER (PARTITION BY page, block, b) + row_number() OVER (PARTITION BY page, block, b ORDER BY CASE WHEN b THEN regexp_extract(body, 'Book (\\d+)', 1)::INT ELSE 0 END, "at") - 1 AS at, body FROM n
""", x=BULLETS))  # fmt: skip
def sorted_bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wiki.sorted_bullets(rows(spark, sf_dir, BULLETS), "page", "at", "body")


@query(duck("SELECT path, 'See [c' || (k + 3) || '](c' || (k + 3) || '.md), [other](a/c' || (k + 2) || '.md) and [../c1](../c1.md) [one](c' || (k + 2) || '.md#top) [two](../c' || (k + 1) || '.md) [three](https://x.y/z)' AS md FROM w", w=WIKI))
def relative_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows(spark, sf_dir, WIKI).select("path", wiki.relative_links(F.col("text")).alias("md"))
