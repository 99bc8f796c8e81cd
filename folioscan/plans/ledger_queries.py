"""Queries over the relational tables as ledgers, packets, histories and journals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions import text as T
from folioscan.functions.digest import quoted
from folioscan.operators import checks, coverage, identity, journal, ledger, ranks
from folioscan.plans.catalog import query, table

LABELLED = "SELECT doc_id, quality, toxic FROM labels"


@query("""
SELECT 'lineitem.order' AS "check", l_orderkey::VARCHAR AS subject_id FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 50 <> 0)
UNION ALL SELECT 'lineitem.part', l_partkey::VARCHAR FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 40 <> 0)
UNION ALL SELECT 'lineitem.supplier', l_suppkey::VARCHAR FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'labels.document', doc_id::VARCHAR FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang <> 'es')
""")
def ledger_fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to tables from which some rows were taken, so that there are violations."""
    line = table(spark, sf_dir, "lineitem")
    parts = [
        ("lineitem.order", line, "l_orderkey", table(spark, sf_dir, "orders").where("o_orderkey % 50 <> 0"), "o_orderkey"),
        ("lineitem.part", line, "l_partkey", table(spark, sf_dir, "part").where("p_partkey % 40 <> 0"), "p_partkey"),
        ("lineitem.supplier", line, "l_suppkey", table(spark, sf_dir, "supplier"), "s_suppkey"),
        ("labels.document", table(spark, sf_dir, "labels"), "doc_id", table(spark, sf_dir, "documents").where("lang <> 'es'"), "doc_id"),
    ]
    return checks.union(*[checks.orphans(c, k, p, pk).select(F.lit(n).alias("check"), F.col(k).cast("string").alias("subject_id")) for n, c, k, p, pk in parts])


CLAIMS = """SELECT CASE WHEN l_orderkey % 7 = 0 THEN ' ' ELSE l_orderkey || '-' || l_linenumber END AS claim_id,
 CASE l_returnflag WHEN 'A' THEN 'supports' WHEN 'R' THEN 'qualifies' ELSE 'mentions' END AS stance, CASE WHEN l_linenumber = 7 THEN 0 ELSE 1 END AS n_sources, l_discount * 20 AS confidence FROM lineitem"""


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as claims: some without an id, with a wrong stance, no sources, or a confidence above one."""
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        F.when(c("l_orderkey") % 7 == 0, " ").otherwise(F.concat_ws("-", c("l_orderkey"), c("l_linenumber"))).alias("claim_id"),
        F.when(c("l_returnflag") == "A", "supports").when(c("l_returnflag") == "R", "qualifies").otherwise("mentions").alias("stance"),
        F.when(c("l_linenumber") == 7, F.array().cast("array<string>")).otherwise(F.array(c("l_suppkey").cast("string"))).alias("source_ids"),
        (c("l_discount") * 20).alias("confidence"),
    )


DEFECTS = f"""SELECT 'missing claim_id' AS "check", claim_id AS subject_id FROM ({CLAIMS}) WHERE trim(claim_id) = ''
UNION ALL SELECT 'bad stance', claim_id FROM ({CLAIMS}) WHERE stance = 'mentions'
UNION ALL SELECT 'no source_ids', claim_id FROM ({CLAIMS}) WHERE n_sources = 0
UNION ALL SELECT 'bad confidence', claim_id FROM ({CLAIMS}) WHERE NOT confidence BETWEEN 0 AND 1"""


@query(DEFECTS)
def ledger_row_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.claim_defects(claims(spark, sf_dir))


@query(f"SELECT (SELECT count(*) FROM lineitem) AS claims, (SELECT count(*) FROM supplier) AS sources, (SELECT count(*) FROM ({DEFECTS})) AS violations, (SELECT count(*) FROM ({DEFECTS})) = 0 AS valid")
def gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = claims(spark, sf_dir)
    return checks.decision(ledger.claim_defects(rows), claims=rows, sources=table(spark, sf_dir, "supplier"))


@query(f"SELECT * FROM ({DEFECTS}) WHERE \"check\" = 'bad stance' AND subject_id NOT IN (SELECT claim_id FROM ({CLAIMS}) WHERE NOT confidence BETWEEN 0 AND 1)")
def suppressed_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stance failures of claims that no confidence failure has reported."""
    found = ledger.claim_defects(claims(spark, sf_dir))
    return checks.suppressed(found.where(F.col("check") == "bad stance"), found.where(F.col("check") == "bad confidence"))


@query("""
SELECT l_orderkey AS claim_id FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY l_orderkey
HAVING NOT bool_or(coalesce(s.s_nationkey = l_orderkey % 25, false))
""")
def revision_in_cited_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders cite the suppliers of their lines; the revision they state must be one of their nations."""
    cited = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("claim_id")).agg(F.collect_set("l_suppkey").alias("source_ids"))
    stated = cited.withColumn("source_revision", (F.col("claim_id") % 25).cast("string"))
    sources = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_id"), F.col("s_nationkey").cast("string").alias("sha256"))
    return ledger.foreign_revisions(stated, sources)


@query("SELECT conv_id, turn, 'c-' || conv_id || '-' || row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS claim_id FROM conversations")
def packet_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.ordinal_ids(table(spark, sf_dir, "conversations"), "conv_id", "turn").select("conv_id", "turn", "claim_id")


@query("SELECT conv_id, sha256('{\"claims\":[' || string_agg(to_json(role || ':' || md5(text))::VARCHAR, ',' ORDER BY turn) || ']}') AS packet_state_revision FROM conversations GROUP BY conv_id")
def packet_state_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = quoted(F.concat_ws(":", "role", F.md5("text")))
    return identity.ordered_digest(table(spark, sf_dir, "conversations"), "conv_id", "turn", part, "packet_state_revision")


@query("SELECT conv_id AS worker, CASE WHEN count(*) < 4 THEN 'too few claims' ELSE 'too many claims' END AS \"check\" FROM conversations GROUP BY conv_id HAVING count(*) NOT BETWEEN 4 AND 7")
def packet_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    rows = turns.select(F.col("conv_id").alias("worker"), F.col("turn").alias("pos"), *[F.lit("x").alias(f) for f in ledger.PACKET_FIELDS], F.lit("supports").alias("stance"))
    packets = turns.select(F.col("conv_id").alias("worker"), F.lit(True).alias("is_object"), F.lit(True).alias("has_list")).distinct()
    return ledger.packet_defects(rows, packets, 4, 7).select("worker", "check")


CHAIN = "SELECT conv_id, turn, md5(text) AS after, CASE WHEN turn % 5 = 3 AND conv_id % 4 = 0 THEN 'lost' ELSE lag(md5(text)) OVER (PARTITION BY conv_id ORDER BY turn) END AS before FROM conversations"


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as events whose state is their text's digest; some have lost the state before."""
    from pyspark.sql import Window

    after = F.md5("text")
    last = F.lag(after).over(Window.partitionBy("conv_id").orderBy("turn"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", after.alias("after"), F.when((F.col("turn") % 5 == 3) & (F.col("conv_id") % 4 == 0), "lost").otherwise(last).alias("before"))


@query(f"SELECT conv_id, turn FROM (SELECT *, lag(after) OVER w AS p, row_number() OVER w AS n FROM ({CHAIN}) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE n > 1 AND before IS DISTINCT FROM p")
def event_chain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.chain_breaks(chain(spark, sf_dir), "conv_id", "turn", "before", "after").select("conv_id", "turn")


@query("SELECT conv_id, arg_max(md5(text), turn) AS state FROM conversations GROUP BY conv_id")
def final_packet_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.final_states(chain(spark, sf_dir), "conv_id", "turn", "after")


@query("""
WITH e AS (SELECT user_id, arg_max(event_type, event_id) AS event, arg_max(props, event_id) AS excerpt FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1)
SELECT c_custkey AS claim_id, coalesce(CASE WHEN e.event = 'purchase' THEN e.excerpt END, c_name) AS excerpt
FROM customer LEFT JOIN e ON c_custkey = e.user_id WHERE e.event IS NULL OR e.event <> 'error'
""")
def replayed_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as claims; a purchase repairs one and an error drops it."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("claim_id"), F.col("c_name").alias("excerpt"))
    kind = F.when(F.col("event_type") == "purchase", "repair").when(F.col("event_type") == "error", "drop")
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("claim_id"), F.col("event_id").alias("seq"), kind.alias("event"), F.col("props").alias("new_excerpt"))
    return identity.replay(rows, events)


@query("SELECT user_id, arg_max(event_type, event_id) AS state FROM events GROUP BY user_id")
def latest_state_per_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return journal.latest(table(spark, sf_dir, "events"), "user_id", "event_id", "event_type").select("user_id", F.col("event_type").alias("state"))


COST = "CAST(floor(value * 100) AS BIGINT)"


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("cost", F.floor(F.col("value") * 100).cast("long"))


@query(f"SELECT user_id, event_id, 5000 - coalesce(sum({COST}) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS remaining FROM events")
def budget_running_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = journal.remaining(costs(spark, sf_dir), "user_id", ["event_id"], "cost", 5000, "remaining")
    return left.select("user_id", "event_id", F.col("remaining").cast("long").alias("remaining"))


@query(f"""
SELECT event_type, count(*) AS requests, sum(coalesce(CASE WHEN event_id % 3 <> 0 THEN {COST} END, 0))::BIGINT AS tokens, count(*) FILTER (WHERE event_id % 3 = 0) AS unknown,
 sum(coalesce(CASE WHEN event_id % 5 <> 0 THEN 2::BIGINT END, 300))::BIGINT AS seconds FROM events GROUP BY event_type
""")
def budget_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage unknown for every third attempt, every fifth one pending."""
    rows = costs(spark, sf_dir).withColumns({"tokens": F.when(F.col("event_id") % 3 != 0, F.col("cost")), "elapsed": F.when(F.col("event_id") % 5 != 0, F.lit(2).cast("long")), "timeout": F.lit(300).cast("long")})
    return journal.totals(rows, "event_type", "tokens", "elapsed", "timeout")


@query(f"SELECT user_id, event_id, CASE WHEN sum({COST}) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) > 20000 THEN 'budget_exhausted' ELSE event_type END AS outcome FROM events")
def reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = costs(spark, sf_dir).withColumn("outcome", F.col("event_type"))
    return journal.reserved(rows, "user_id", ["event_id"], "cost", 20000).select("user_id", "event_id", "outcome")


@query("SELECT user_id, count(*) AS n, bool_or(event_type IN ('error', 'purchase')) AS blocked FROM events WHERE event_id > 500 GROUP BY user_id")
def attempts_after_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("outcome", F.col("event_type"))
    return journal.blocked(rows, "user_id", "event_id", 500, ["error", "purchase"])


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def idempotent_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.replayed_once(table(spark, sf_dir, "events"), "event_id", "user_id", "event_type").select("user_id", "event_type", "event_id")


@query("SELECT event_type, to_json(list(DISTINCT json_keys(props) ORDER BY json_keys(props)))::VARCHAR AS shapes, count(*) AS n FROM events GROUP BY event_type")
def usage_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.to_json(F.sort_array(F.collect_set(F.json_object_keys("props")))).alias("shapes"), F.count("*").alias("n"))


@query("""
SELECT n, row_number() OVER (ORDER BY k, n) AS rank FROM (SELECT c_name || '-' || (c_custkey % 120) AS n,
 array_to_string(list_transform(regexp_extract_all(c_name || '-' || (c_custkey % 120), '(\\d+|\\D+)'), lambda p: CASE WHEN regexp_matches(p, '^\\d') THEN lpad(ltrim(p, '0'), 20, '0') ELSE p END), '') AS k FROM customer)
""")
def natural_sort_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in natural order with their rank, taken over ranges of the order."""
    rows = table(spark, sf_dir, "customer").select(F.concat_ws("-", "c_name", F.col("c_custkey") % 120).alias("n")).withColumn("k", T.natural_key(F.col("n")))
    return ranks.ranked(rows, [], [F.col("k"), F.col("n")]).select("n", "rank")


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, regexp_matches(p_name, '^[A-Za-z0-9][A-Za-z0-9_-]{0,127}$') AS is_safe FROM part")
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", T.slug(F.col("p_name")).alias("slug"), T.safe_id(F.col("p_name")).alias("is_safe"))


@query("""
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' WHEN 3 THEN 'PASS' END AS verdict,
 CASE turn % 4 WHEN 0 THEN role WHEN 1 THEN 'bad quote' WHEN 2 THEN 'FAIL with no enumerated defect' ELSE 'implicit positive attestation' END AS detail FROM conversations
""")
def verdict_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies made from turns: a pass after a fail, a fail, a fail without reason, an implicit pass."""
    k = F.col("turn") % 4
    reply = F.when(k == 0, F.concat(F.lit("VERDICT: FAIL - x\n verdict: pass — "), F.col("role"))).when(k == 1, "text\nVERDICT: FAIL: bad quote").when(k == 2, "VERDICT: FAIL - ").otherwise("All verified sound.")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.verdict(reply).alias("v")).select("conv_id", "turn", "v.verdict", "v.detail")


@query("SELECT o_orderkey, CASE WHEN count(l_orderkey) = 0 THEN 'idle' END AS \"check\" FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber > 2 GROUP BY 1 HAVING count(l_orderkey) = 0")
def context_never_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    idle = checks.orphans(table(spark, sf_dir, "orders"), "o_orderkey", table(spark, sf_dir, "lineitem").where("l_linenumber > 2"), "l_orderkey")
    return idle.select("o_orderkey", F.lit("idle").alias("check"))


@query("""
SELECT n_nationkey AS doc, 'declared only' AS "check" FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey < 20)
""")
def asset_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("doc"))
    return coverage.closure(declared, table(spark, sf_dir, "supplier").where("s_nationkey < 20").select(F.col("s_nationkey").alias("doc")).distinct(), "doc")


@query("""
SELECT s.s_nationkey AS grp, s.k::INTEGER AS at, s.s_suppkey::VARCHAR AS "left", c.c_custkey::VARCHAR AS "right"
FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) k FROM supplier) s JOIN (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) k FROM customer) c
 ON s.s_nationkey = c.c_nationkey AND s.k = c.k WHERE s.s_suppkey <> c.c_custkey
UNION ALL SELECT c.c_nationkey, c.k::INTEGER, NULL, c.c_custkey::VARCHAR FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) k FROM customer) c
 WHERE c.k > (SELECT count(*) FROM supplier WHERE s_nationkey = c.c_nationkey)
UNION ALL SELECT s.s_nationkey, s.k::INTEGER, s.s_suppkey::VARCHAR, NULL FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) k FROM supplier) s
 WHERE s.k > (SELECT count(*) FROM customer WHERE c_nationkey = s.s_nationkey)
""")
def positional_attestations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and customers of a nation compared row by row."""
    a = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("grp"), "s_suppkey", F.col("s_suppkey").cast("string").alias("v"))
    b = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("grp"), F.col("c_custkey").alias("s_suppkey"), F.col("c_custkey").cast("string").alias("v"))
    return identity.positional_by(a, b, "grp", "s_suppkey", "v")
