"""Queries of the checks where data enter, over inputs derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.functions import text as T
from folioscan.operators import boundary
from folioscan.plans.catalog import query, table
from folioscan.plans.derived_queries import duck, rows

STORED = "SELECT o_custkey AS worker, CASE WHEN o_orderkey % 41 = 0 THEN '' WHEN o_orderkey % 43 = 0 THEN NULL ELSE o_orderpriority END AS packet_revision FROM {orders} WHERE o_orderkey % 10 = 1"
STORED_CLAIMS = "SELECT l_orderkey AS worker, 'c-' || l_orderkey || '-' || l_linenumber AS claim_id FROM {lineitem}"


@query(duck("""
SELECT 'no persisted identity' AS "check", worker::VARCHAR AS subject FROM p WHERE coalesce(packet_revision, '') = '' UNION ALL SELECT 'duplicate worker', worker::VARCHAR FROM p GROUP BY worker HAVING count(*) > 1 UNION ALL SELECT 'claim id is not unique', claim_id FROM c GROUP BY 2 HAVING count(*) > 1
""", p=STORED, c=STORED_CLAIMS))  # fmt: skip
def store_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary.store_defects(rows(spark, sf_dir, STORED), rows(spark, sf_dir, STORED_CLAIMS))


WRAPPED = "SELECT c_custkey, 'a ' || chr(10) || c_name AS f, c_name || chr(9) || 'x' AS g, ' p. ' || chr(10) || c_nationkey || ' ' AS l FROM {customer}"


@query(duck("SELECT c_custkey, 'a' || regexp_replace(c_name, '\\s+', '', 'g') || '|' || regexp_replace(c_name, '\\s+', '', 'g') || 'x|p. ' || c_nationkey AS conflict FROM {customer}"))
def normalised_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = rows(spark, sf_dir, WRAPPED).withColumn("c", F.array(F.struct(F.col("f").alias("source_file"), F.array("g").alias("source_files"), F.col("l").alias("locator"))))
    one = F.element_at(boundary.normalised_conflicts(F.col("c")), 1)
    return made.select("c_custkey", F.concat_ws("|", one["source_file"], F.element_at(one["source_files"], 1), one["locator"]).alias("conflict"))


ROLES = "SELECT l_orderkey AS reading_id, CASE WHEN l_linenumber % 3 = 0 OR l_orderkey % 7 = 0 THEN 'context' ELSE 'primary' END AS role FROM {lineitem}"


@query(duck("""
WITH n AS (SELECT o_orderkey AS reading_id, count(role) FILTER (WHERE role = 'primary') AS p, count(role) AS n FROM {orders} LEFT JOIN b ON reading_id = o_orderkey GROUP BY 1)
SELECT reading_id, CASE WHEN p < 1 THEN 'too few primary claims' ELSE 'too many claims' END AS "check" FROM n WHERE p < 1 OR n > 5
""", b=ROLES))  # fmt: skip
def reading_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary.reading_bounds(rows(spark, sf_dir, ROLES), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("reading_id")), 1, 5)


ASSIGNED = "SELECT conv_id AS reading_id, CASE WHEN turn % 2 = 0 THEN 'primary' ELSE 'context' END AS role, turn AS pos, conv_id * 100 + turn AS section_id FROM {conversations}"
SECTIONS = "SELECT conv_id * 100 + turn AS section_id, role || '.md' AS source_file, turn + 1 AS first, turn + 3 AS last, text AS body FROM {conversations}"


@query(duck("SELECT reading_id, md5(string_agg(chr(10) || '[' || upper(role) || ' SOURCE ' || source_file || ' L' || first || '-' || (last - 1) || ']' || chr(10) || body, '' ORDER BY role DESC, pos)) AS text FROM a JOIN s USING (section_id) GROUP BY 1", a=ASSIGNED, s=SECTIONS))
def reading_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = boundary.reading_input(rows(spark, sf_dir, ASSIGNED), rows(spark, sf_dir, SECTIONS))
    return out.select("reading_id", F.md5(F.col("text").cast("binary")).alias("text"))


READ = "SELECT 'd' || doc_id || '.md' AS source_file, CASE WHEN lang = 'fr' THEN 'html' ELSE 'markdown' END AS adapter, doc_id % 30 AS work_id, CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 13 = 0 THEN NULL ELSE md5(text) END AS source_id FROM {documents}"


@query(duck("""
WITH m AS (SELECT source_id FROM r WHERE source_id <> '' GROUP BY 1 HAVING count(*) > 1)
SELECT source_file, 'not markdown' AS "check" FROM r WHERE adapter <> 'markdown' UNION ALL SELECT source_file, 'unknown work' FROM r WHERE work_id NOT IN (SELECT n_nationkey FROM {nation}) UNION ALL SELECT source_file, 'no source id' FROM r WHERE coalesce(source_id, '') = '' UNION ALL SELECT source_file, 'ambiguous source id' FROM r JOIN m USING (source_id)
""", r=READ))  # fmt: skip
def reading_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary.reading_source_defects(rows(spark, sf_dir, READ), table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("work_id")))


@query(duck("SELECT count(*) AS n_sources, count(DISTINCT md5(text)) AS n_ids, count(DISTINCT lang) AS n_translators, count(DISTINCT md5(text)) < count(*) AS ambiguous FROM {documents}"))
def source_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary.identity_counts(rows(spark, sf_dir, "SELECT md5(text) AS source_id, lang AS translator FROM {documents}"))


INPUTS = "SELECT o_orderkey AS worker, CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderstatus END AS packet_revision, o_orderpriority AS packet_state_revision, 's' || o_custkey AS source_revision FROM {orders}"
AGAIN = "SELECT o_orderkey AS worker, o_orderstatus AS packet_revision, CASE WHEN o_orderkey % 17 = 0 THEN 'new' ELSE o_orderpriority END AS packet_state_revision, 's' || (o_custkey + CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END) AS source_revision FROM {orders}"
BUNDLES = "SELECT 's' || s_suppkey AS name, s_suppkey AS key, s_suppkey + CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS stated_key, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 's' || s_suppkey END AS stated_name FROM {supplier}"


@query(duck("""
WITH j AS (SELECT p.*, a.packet_state_revision AS b, a.source_revision AS c FROM p JOIN a USING (worker))
SELECT worker::VARCHAR AS subject, 'no accepted metadata' AS "check" FROM j WHERE packet_revision IS NULL UNION ALL SELECT worker::VARCHAR, 'packet_state_revision drift' FROM j WHERE packet_revision IS NOT NULL AND packet_state_revision <> b UNION ALL SELECT worker::VARCHAR, 'source_revision drift' FROM j WHERE packet_revision IS NOT NULL AND source_revision <> c
UNION ALL SELECT name, 'bundle identity drift' FROM u WHERE key <> stated_key UNION ALL SELECT name, 'source identity drift' FROM u WHERE stated_name IS NULL
""", p=INPUTS, a=AGAIN, u=BUNDLES))  # fmt: skip
def publication_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary.publication_drift(*(rows(spark, sf_dir, x) for x in (INPUTS, AGAIN, BUNDLES)))


SHAPE = "SELECT l_orderkey AS worker, 'missing excerpt' AS \"check\" FROM lineitem WHERE l_quantity >= 49 UNION ALL SELECT l_orderkey, 'drift: revision' FROM lineitem WHERE l_tax >= 0.08 AND l_linenumber = 2 UNION ALL SELECT o_orderkey, 'model not allowed' FROM orders WHERE o_orderkey % 50 = 3"


@query(f"SELECT worker, count(*) AS n_defects, false AS valid FROM ({SHAPE}) GROUP BY 1")
def worker_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    said = lambda df, key, check: df.select(F.col(key).alias("worker"), F.lit(check).alias("check"))
    return boundary.worker_outputs(said(l.where("l_quantity >= 49"), "l_orderkey", "missing excerpt"), said(l.where("l_tax >= 0.08 AND l_linenumber = 2"), "l_orderkey", "drift: revision"), said(o.where("o_orderkey % 50 = 3"), "o_orderkey", "model not allowed"))


TRIES = "SELECT conv_id AS step, turn + 1 AS attempt, CASE WHEN (conv_id + turn) % 4 = 0 THEN 'VERDICT: PASS ' || role WHEN (conv_id + turn) % 4 = 1 THEN 'VERDICT: FAIL' ELSE text END AS reply FROM {conversations}"


@query(duck("""
WITH u AS (SELECT step, attempt, string_split(reply, 'PASS ')[2] AS detail FROM t WHERE attempt <= 2 AND starts_with(reply, 'VERDICT: PASS ')), f AS (SELECT step, min(attempt) AS attempt, arg_min(detail, attempt) AS detail FROM u GROUP BY 1)
SELECT DISTINCT t.step, f.attempt, CASE WHEN f.step IS NOT NULL THEN 'PASS' END AS verdict, CASE WHEN f.step IS NULL THEN 'no usable verdict' ELSE detail END AS detail FROM t LEFT JOIN f USING (step)
""", t=TRIES))  # fmt: skip
def advisory_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundary.advisory_verdicts(rows(spark, sf_dir, TRIES))


@query(duck("SELECT c_custkey AS project, 'f' || c_nationkey AS field, CASE WHEN n_nationkey < 20 THEN '/kb/' || n_name END AS root, CASE WHEN n_nationkey < 20 THEN n_name END AS description FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey"))
def field_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = rows(spark, sf_dir, "SELECT 'f' || n_nationkey AS field, '/kb/' || n_name AS root, n_name AS description FROM {nation} WHERE n_nationkey < 20")
    return boundary.field_roots(rows(spark, sf_dir, "SELECT c_custkey AS project, 'f' || c_nationkey AS field FROM {customer}"), registry)


@query(duck("SELECT conv_id, turn, md5(text) AS original, CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) - CASE WHEN ends_with(text, chr(10)) THEN 1 ELSE 0 END END::INTEGER AS n_lines FROM {conversations}"))
def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and numbers of lines of representations, from which line offsets follow."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(F.col("text").cast("binary")).alias("original"), F.size(T.lines(F.col("text"))).alias("n_lines"))
