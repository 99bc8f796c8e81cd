"""Queries of streams with their sinks, bundles and the decision over all gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.operators import bundles, gates
from folioscan.plans.catalog import query, table
from folioscan.sources import journal
from folioscan.sources.scratch import folder
from folioscan.streaming import acceptance

#: Events are delivered as claims of their users: all once, every 7th again as it was, every 11th with another value.
DELIVERIES = """
SELECT user_id::VARCHAR AS worker, event_id AS seq, event_id::VARCHAR AS claim, md5(event_type || value::DECIMAL(18,2)::VARCHAR) AS digest FROM events
UNION ALL SELECT user_id::VARCHAR, 10000000 + event_id, event_id::VARCHAR, md5(event_type || value::DECIMAL(18,2)::VARCHAR) FROM events WHERE event_id % 7 = 0
UNION ALL SELECT user_id::VARCHAR, 20000000 + event_id, event_id::VARCHAR, md5(event_type || value::DECIMAL(18,2)::VARCHAR || '!') FROM events WHERE event_id % 11 = 0
"""


def deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    e = table(spark, sf_dir, "events")

    def sent(rows: DataFrame, after: int, mark: Column) -> DataFrame:
        digest = F.md5(F.concat("event_type", F.col("value").cast("decimal(18,2)").cast("string"), mark))
        return rows.select(F.col("user_id").cast("string").alias("worker"), (F.col("event_id") + after).alias("seq"), F.col("event_id").cast("string").alias("claim"), digest.alias("digest"))

    none = F.lit("")
    first, again, other = sent(e, 0, none), sent(e.where("event_id % 7 = 0"), 10_000_000, none), sent(e.where("event_id % 11 = 0"), 20_000_000, F.lit("!"))
    middle = e.selectExpr("max(event_id) / 2 AS m").first()["m"] or 0
    return [first.where(F.col("seq") <= middle), first.where(F.col("seq") > middle), again.unionByName(other)]


@query(f"""
WITH d AS ({DELIVERIES}), f AS (SELECT worker, claim, min(seq) AS seq, arg_min(digest, seq) AS digest FROM d GROUP BY ALL),
 o AS (SELECT *, row_number() OVER (PARTITION BY worker ORDER BY seq) AS ordinal FROM f)
SELECT d.worker, d.seq, d.claim, o.digest, 'c-' || d.worker || '-' || ordinal AS claim_id, CASE WHEN d.seq = o.seq THEN 'accepted' WHEN d.digest = o.digest THEN 'unchanged' ELSE 'drift' END AS status FROM d JOIN o USING (worker, claim)
""")
def accepted_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries in three parts; the stream ends after the first and is started again from its checkpoint for the others."""
    at = folder(spark)
    parts = deliveries(spark, sf_dir)
    for k, part in enumerate(parts):
        part.write.mode("append").parquet(f"{at}/in")
        if k != 1:
            acceptance.run(spark.readStream.schema(part.schema).parquet(f"{at}/in"), f"{at}/out", f"{at}/checkpoint")
    return spark.read.schema(acceptance.SCHEMA).parquet(f"{at}/out").select("worker", "seq", "claim", "digest", "claim_id", "status")


PAGES = "SELECT page_id AS node, html, regexp_extract(html, '<title>([^ <]*)', 1) AS name FROM pages"
REFERENCES = f"SELECT node, unnest(regexp_extract_all(html, '<li><a href=\"/([^\"]*)\">', 1)) AS reference FROM ({PAGES})"


@query(f"""
WITH RECURSIVE n AS (SELECT name AS reference, min(node) AS "to" FROM ({PAGES}) WHERE name <> '' GROUP BY 1),
 e AS (SELECT DISTINCT node, r.reference, "to" FROM ({REFERENCES}) r LEFT JOIN n USING (reference)),
 w AS (SELECT page_id AS node FROM pages WHERE page_id % 50 = 7 UNION SELECT e."to" FROM w JOIN e USING (node) WHERE e."to" IS NOT NULL)
SELECT DISTINCT reference, CASE WHEN "to" IS NULL THEN 'limitation' ELSE 'record' END AS outcome, "to" AS node FROM e WHERE node IN (SELECT node FROM w)
""")
def bundle_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference reached from some pages: a word of a page's menu leads to the page whose title begins with it, if any."""
    pages = table(spark, sf_dir, "pages")
    records = pages.select(F.regexp_extract("html", "<title>([^ <]*)", 1).alias("reference"), F.col("page_id").alias("node")).where("reference <> ''")
    references = pages.select(F.col("page_id").alias("node"), F.explode(F.regexp_extract_all("html", F.lit('<li><a href="/([^"]*)">'), F.lit(1))).alias("reference"))
    return bundles.closure(pages.where("page_id % 50 = 7").select(F.col("page_id").alias("node")), references, records).select("reference", "outcome", "node")


@query("""
WITH g AS (
 SELECT 'claims' AS gate, count(*) AS n_rows, count(*) FILTER (WHERE l_discount > 0.09 OR l_shipdate IS NULL OR l_quantity >= 50) AS n_invalid FROM lineitem
 UNION ALL SELECT 'packets', count(*), count(*) FILTER (WHERE o_totalprice <= 0 OR o_orderstatus NOT IN ('F', 'O', 'P')) FROM orders
 UNION ALL SELECT 'sources', count(*), count(*) FILTER (WHERE trim(coalesce(text, '')) = '' OR lang IS NULL) FROM documents
 UNION ALL SELECT 'attempts', count(*), count(*) FILTER (WHERE event_type = 'error' AND value > 190) FROM events)
SELECT gate, n_rows, n_invalid, n_invalid = 0 AS valid FROM g
UNION ALL SELECT 'publication', sum(n_rows)::BIGINT, sum(n_invalid)::BIGINT, bool_and(n_invalid = 0) FROM g
""")
def publication_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, invalid rows and the decision of the gates over claims, packets, sources and attempts, from one scan of each."""
    _, decision = gates.judged(_gates(spark, sf_dir))
    receipt = {r["gate"]: r["n_rows"] for r in decision.collect()}  # four rows
    return gates.published(decision, receipt)


@query("""
SELECT 'claims' AS gate, 'overstated' AS "check", l_orderkey || '-' || l_linenumber AS subject_id FROM lineitem WHERE l_discount > 0.09
UNION ALL SELECT 'claims', 'undated', l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_shipdate IS NULL
UNION ALL SELECT 'claims', 'too long', l_orderkey || '-' || l_linenumber FROM lineitem WHERE l_quantity >= 50
UNION ALL SELECT 'packets', 'no price', o_orderkey::VARCHAR FROM orders WHERE o_totalprice <= 0
UNION ALL SELECT 'packets', 'unknown status', o_orderkey::VARCHAR FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')
UNION ALL SELECT 'sources', 'empty', doc_id::VARCHAR FROM documents WHERE trim(coalesce(text, '')) = ''
UNION ALL SELECT 'sources', 'no language', doc_id::VARCHAR FROM documents WHERE lang IS NULL
UNION ALL SELECT 'attempts', 'costly error', event_id::VARCHAR FROM events WHERE event_type = 'error' AND value > 190
""")
def publication_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.judged(_gates(spark, sf_dir))[0]


def _gates(spark: SparkSession, sf_dir: str) -> list[gates.Gate]:
    c = F.col
    return [
        gates.Gate("claims", table(spark, sf_dir, "lineitem"), F.concat_ws("-", "l_orderkey", "l_linenumber"), {"overstated": c("l_discount") > 0.09, "undated": c("l_shipdate").isNull(), "too long": c("l_quantity") >= 50}),
        gates.Gate("packets", table(spark, sf_dir, "orders"), c("o_orderkey"), {"no price": c("o_totalprice") <= 0, "unknown status": ~c("o_orderstatus").isin("F", "O", "P")}),
        gates.Gate("sources", table(spark, sf_dir, "documents"), c("doc_id"), {"empty": F.trim(F.coalesce("text", F.lit(""))) == "", "no language": c("lang").isNull()}),
        gates.Gate("attempts", table(spark, sf_dir, "events"), c("event_id"), {"costly error": (c("event_type") == "error") & (c("value") > 190)}),
    ]


@query("""SELECT event_id AS id, user_id AS run, event_type AS outcome, (event_id % 40)::BIGINT AS prompt_tokens, CASE WHEN event_id % 3 > 0 THEN (event_id % 7)::BIGINT END AS completion_tokens, CASE WHEN event_id % 4 > 0 THEN event_id % 40 + event_id % 7 END AS total_tokens, event_id % 4 = 0 AS unknown FROM events WHERE event_id >= 100 AND event_id < (SELECT max(event_id) FROM events) - 100""")
def journal_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as journals, written by the tasks and read back in ranges of ids, of which bounds leave some out."""
    at = folder(spark)
    k = F.col("event_id")
    part = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f', "{name}": '), value.cast("string"))).otherwise("")
    usage = F.concat(F.lit('{"prompt_tokens": '), (k % 40).cast("string"), part("completion_tokens", F.when(k % 3 > 0, k % 7)), part("total_tokens", F.when(k % 4 > 0, k % 40 + k % 7)), F.lit("}"))
    events = table(spark, sf_dir, "events")
    journal.write_journals(events.select(k.alias("id"), F.col("user_id").alias("run"), F.col("event_type").alias("outcome"), usage.alias("usage")).repartitionByRange(3, "id"), at, "attempts")
    most = events.agg(F.max("event_id").alias("m")).first()["m"] or 0
    return journal.history(journal.journals(spark, at, "attempts", 2000, 100, most - 101))


@query("""
WITH f AS (SELECT page_id || CASE page_id % 5 WHEN 0 THEN '.HTML' WHEN 1 THEN '.md' WHEN 2 THEN '.pdf' WHEN 3 THEN '.txt' ELSE '' END AS name, page_id % 5 AS k FROM pages)
SELECT name, CASE WHEN k = 1 THEN 'ambiguous' ELSE 'unsupported' END AS "check" FROM f WHERE k IN (1, 2, 4)
""")
def adapter_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id") % 5
    names = table(spark, sf_dir, "pages").select(F.concat(F.col("page_id").cast("string"), F.when(k == 0, ".HTML").when(k == 1, ".md").when(k == 2, ".pdf").when(k == 3, ".txt").otherwise("")).alias("name"))
    registry = spark.createDataFrame([("html", ".html"), ("markdown", ".md"), ("notes", ".md"), ("text", ".txt")], "adapter string, suffix string")
    return journal.adapter_faults(names, registry)
