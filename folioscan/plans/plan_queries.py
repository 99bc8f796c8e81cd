"""Queries of reading plans, projections, bindings of sources and report targets, over inputs that SQL derives from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscan.operators import plan
from folioscan.plans.catalog import query
from folioscan.plans.derived_queries import duck, rows

SECTIONS = """SELECT l_orderkey * 10 + l_linenumber AS section_id, l_orderkey AS source_file, l_linenumber * 2 - 1 AS first, l_linenumber * 2 + CASE WHEN max(l_suppkey) % 97 = 0 THEN -1 ELSE 1 END AS last,
 CASE WHEN max(l_partkey) % 11 = 0 THEN 'context' WHEN max(l_partkey) % 13 = 0 THEN 'excluded' WHEN max(l_partkey) % 101 = 0 THEN 'other' ELSE 'primary' END AS disposition,
 CASE WHEN max(l_suppkey) % 3 = 0 THEN ' ' ELSE 'r' END AS reason FROM {lineitem} GROUP BY l_orderkey, l_linenumber"""
STOPS = "SELECT o_orderkey AS source_file, coalesce(max(l_linenumber), 1) * 2 + CASE WHEN o_orderkey % 19 = 0 THEN 3 ELSE 1 END AS stop FROM {orders} LEFT JOIN {lineitem} ON l_orderkey = o_orderkey GROUP BY o_orderkey"
CUTS = "SELECT l_orderkey AS source_file, l_linenumber * 2 - 2 AS cut FROM {lineitem} WHERE l_suppkey % 7 <> 0 UNION ALL SELECT l_orderkey, l_linenumber * 2 FROM {lineitem} WHERE l_partkey % 5 <> 0"


@query(duck("""
WITH e AS (SELECT section_id, source_file, first - 1 AS cut FROM s UNION ALL SELECT section_id, source_file, last - 1 FROM s),
 o AS (SELECT s.*, stop, lag(last) OVER w AS before, lead(first) OVER w AS after, row_number() OVER w AS n FROM s JOIN t USING (source_file) WINDOW w AS (PARTITION BY source_file ORDER BY first, last))
SELECT 'section' AS level, CAST(section_id AS VARCHAR) AS subject, 'no range' AS "check" FROM s WHERE NOT first < last
UNION ALL SELECT 'section', CAST(section_id AS VARCHAR), 'unknown disposition' FROM s WHERE disposition = 'other'
UNION ALL SELECT 'section', CAST(section_id AS VARCHAR), 'no reason' FROM s WHERE disposition <> 'primary' AND reason = ' '
UNION ALL SELECT DISTINCT 'section', CAST(section_id AS VARCHAR), 'edge inside a block' FROM e WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.source_file = e.source_file AND c.cut = e.cut)
UNION ALL SELECT 'file', CAST(source_file AS VARCHAR), 'starts late' FROM o WHERE n = 1 AND first <> 1
UNION ALL SELECT DISTINCT 'file', CAST(source_file AS VARCHAR), 'gap or overlap' FROM o WHERE before <> first
UNION ALL SELECT 'file', CAST(source_file AS VARCHAR), 'ends elsewhere' FROM o WHERE after IS NULL AND last <> stop
UNION ALL SELECT 'file', CAST(source_file AS VARCHAR), 'no sections' FROM t WHERE source_file NOT IN (SELECT source_file FROM s)
""", s=SECTIONS, t=STOPS, c=CUTS))  # fmt: skip
def plan_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.section_defects(rows(spark, sf_dir, SECTIONS), rows(spark, sf_dir, CUTS), rows(spark, sf_dir, STOPS))


READINGS = """SELECT CASE WHEN o_orderkey % 41 = 0 THEN '-o' ELSE 'o' END || o_orderkey AS reading_id, o_custkey % 5 AS work_id FROM {orders} UNION ALL SELECT 'o' || o_orderkey, o_custkey % 5 FROM {orders} WHERE o_orderkey % 43 = 0"""
ASSIGNED = """SELECT 'o' || l_orderkey AS reading_id, CASE WHEN l_linenumber > 4 THEN 'context' ELSE 'primary' END AS role, l_orderkey * 10 + l_linenumber + CASE WHEN l_suppkey % 37 = 0 THEN 6 WHEN l_partkey % 29 = 0 THEN -1 ELSE 0 END AS section_id FROM {lineitem}"""
WORKS = "SELECT o_orderkey AS source_file, o_custkey % 5 + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS work_id FROM {orders}"


@query(duck("""
WITH p AS (SELECT * FROM a WHERE role = 'primary'), h AS (SELECT a.*, source_file, first, last FROM a JOIN s USING (section_id)),
 o AS (SELECT *, lag(last) OVER (PARTITION BY reading_id, source_file ORDER BY first, last) AS before FROM h),
 k AS (SELECT section_id, sum(x) AS x, sum(y) AS y FROM (SELECT section_id, 1 AS x, 0 AS y FROM p UNION ALL SELECT section_id, 0, 1 FROM s WHERE disposition = 'primary') GROUP BY 1)
SELECT 'reading' AS level, reading_id AS subject, 'unsafe id' AS "check" FROM r WHERE reading_id LIKE '-%'
UNION ALL SELECT 'reading', reading_id, 'duplicate id' FROM r GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'reading', reading_id, 'no primary section' FROM r WHERE reading_id NOT IN (SELECT reading_id FROM p)
UNION ALL SELECT DISTINCT 'reading', reading_id, 'unknown section' FROM a WHERE section_id NOT IN (SELECT section_id FROM s)
UNION ALL SELECT DISTINCT 'reading', r.reading_id, 'primary section of another work' FROM h JOIN r USING (reading_id) LEFT JOIN w USING (source_file) WHERE role = 'primary' AND w.work_id IS DISTINCT FROM r.work_id
UNION ALL SELECT DISTINCT 'reading', reading_id, 'sections overlap' FROM o WHERE before > first
UNION ALL SELECT 'section', CAST(section_id AS VARCHAR), 'not owned exactly once' FROM k WHERE x <> y
UNION ALL SELECT 'section', CAST(section_id AS VARCHAR), 'unused context' FROM s WHERE disposition = 'context' AND section_id NOT IN (SELECT section_id FROM a WHERE role = 'context')
UNION ALL SELECT 'section', CAST(section_id AS VARCHAR), 'excluded but used' FROM s WHERE disposition = 'excluded' AND section_id IN (SELECT section_id FROM a WHERE role = 'context')
""", s=SECTIONS, r=READINGS, a=ASSIGNED, w=WORKS))  # fmt: skip
def plan_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.assignment_defects(*(rows(spark, sf_dir, x) for x in (READINGS, ASSIGNED, SECTIONS, WORKS)))


SPANS = "SELECT conv_id AS reading_id, CASE WHEN turn % 2 = 0 THEN 'primary' ELSE 'context' END AS role, turn AS section_id, conv_id % 7 AS work_id, 's' || (conv_id % 7) AS source_id, text AS body, turn * 100000 AS byte_start FROM {conversations}"
CLAIMS = """SELECT conv_id * 100 + turn AS claim_id, conv_id AS reading_id, CASE WHEN turn % 2 = 0 THEN 'primary' ELSE 'context' END AS role, turn + CASE WHEN conv_id % 11 = 0 THEN 50 ELSE 0 END AS section_id, conv_id % 7 AS work_id,
 CASE WHEN conv_id % 19 = 0 THEN 'other' WHEN conv_id % 5 <> 0 THEN 's' || (conv_id % 7) END AS source_id, CASE WHEN conv_id % 13 = 0 THEN 'absent!' WHEN conv_id % 17 = 0 THEN '' WHEN turn % 3 = 0 THEN substr(text, 3, 3) ELSE substr(text, 9, 30) END AS excerpt,
 CASE WHEN conv_id % 23 = 0 THEN -1 WHEN turn % 2 = 0 THEN conv_id % 7 END AS independence_group, turn * 100000 + 8 AS byte_start, turn * 100000 + 38 AS byte_end FROM {conversations}"""
SEEN = """v AS (SELECT c.*, a.body, instr(a.body, c.excerpt) AS pos, a.source_id AS planned, a.byte_start AS base FROM c LEFT JOIN a ON c.reading_id = a.reading_id AND c.role = a.role AND c.section_id = a.section_id AND c.work_id = a.work_id),
 j AS (SELECT v.*, CASE WHEN body IS NULL THEN 'another assignment' WHEN source_id <> planned THEN 'another source' WHEN excerpt = '' THEN 'no excerpt' WHEN pos = 0 THEN 'quote missing' WHEN instr(substr(body, pos + 1), excerpt) > 0 THEN 'quote ambiguous' END AS state,
  CASE WHEN role = 'primary' THEN work_id END AS grp, base + strlen(substr(body, 1, pos - 1)) AS s FROM v)"""


@query(duck(f"""WITH {SEEN} SELECT claim_id, state AS "check", CASE WHEN state IS NULL THEN grp END AS independence_group, CASE WHEN state IS NULL THEN s END AS byte_start, CASE WHEN state IS NULL THEN s + strlen(excerpt) END AS byte_end FROM j""", c=CLAIMS, a=SPANS))
def projected_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.projected(rows(spark, sf_dir, CLAIMS), rows(spark, sf_dir, SPANS))


@query(duck(f"""
WITH {SEEN} SELECT claim_id, CASE WHEN state IS NOT NULL THEN state WHEN grp IS DISTINCT FROM independence_group THEN 'another group' ELSE 'another place' END AS "check"
FROM j WHERE state IS NOT NULL OR grp IS DISTINCT FROM independence_group OR s <> byte_start OR s + strlen(excerpt) <> byte_end
""", c=CLAIMS, a=SPANS))  # fmt: skip
def projection_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.projection_drift(rows(spark, sf_dir, CLAIMS), rows(spark, sf_dir, SPANS))


LIVE = """SELECT l_orderkey AS worker, l_linenumber AS claim_id, 'f' || (max(l_suppkey) % 5) AS source_file, 'd' || (max(l_suppkey) % 9) AS digest, CASE WHEN max(l_partkey) % 13 = 0 THEN NULL WHEN max(l_partkey) % 29 = 0 THEN 'old' ELSE 'd' || (max(l_suppkey) % 9) END AS source_revision,
 CASE WHEN max(l_partkey) % 3 = 0 THEN '[1,2]' END AS reading FROM {lineitem} WHERE l_partkey % 47 <> 0 GROUP BY l_orderkey, l_linenumber"""
SAVED = """SELECT l_orderkey AS worker, l_linenumber AS claim_id, 'f' || (max(l_suppkey) % 5 + CASE WHEN max(l_partkey) % 37 = 0 THEN 1 ELSE 0 END) AS source_file, 'd' || (max(l_suppkey) % 9 + CASE WHEN max(l_partkey) % 41 = 0 THEN 1 ELSE 0 END) AS source_revision,
 CASE WHEN max(l_partkey) % 3 = 0 AND max(l_partkey) % 7 <> 0 THEN '[1,2]' END AS reading FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING max(l_partkey) % 31 <> 0"""
ORIGINALS = "SELECT DISTINCT l_orderkey AS worker, l_linenumber AS claim_id FROM {lineitem}"
ALIASES = "SELECT l_orderkey AS worker, 'a' || l_linenumber AS alias, l_linenumber + CASE WHEN max(l_suppkey) % 11 = 0 THEN 1 ELSE 0 END AS target FROM {lineitem} GROUP BY l_orderkey, l_linenumber"


@query(duck("""
WITH j AS (SELECT l.*, b.source_file AS f, b.source_revision AS d, b.reading AS g FROM l JOIN b USING (worker, claim_id))
SELECT worker, claim_id, 'binding changed' AS "check" FROM j WHERE source_file <> f OR digest <> d OR reading IS DISTINCT FROM g
UNION ALL SELECT worker, claim_id, 'revision mismatch' FROM l WHERE source_revision <> digest
UNION ALL SELECT worker, claim_id, 'no saved binding' FROM o WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.worker = o.worker AND b.claim_id = o.claim_id)
UNION ALL SELECT worker, target, 'several aliases' FROM x GROUP BY worker, target HAVING count(*) > 1
UNION ALL SELECT DISTINCT worker, target, 'alias of an unknown claim' FROM x WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.worker = x.worker AND o.claim_id = x.target)
""", l=LIVE, b=SAVED, o=ORIGINALS, x=ALIASES))  # fmt: skip
def source_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.binding_defects(*(rows(spark, sf_dir, x) for x in (LIVE, SAVED, ORIGINALS, ALIASES)))


FAILURES = """SELECT CASE WHEN l_partkey % 47 = 0 THEN NULL ELSE l_orderkey END AS worker, l_orderkey * 10 + l_linenumber AS claim_id, l_partkey % 53 <> 0 AS has_excerpt, CASE WHEN l_partkey % 3 = 0 THEN NULL WHEN l_partkey % 5 = 0 THEN 'was' ELSE 'e' || l_linenumber END AS old_excerpt,
 CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE 'r' END AS reason, l_linestatus = 'F' AS applied FROM {lineitem} WHERE l_returnflag = 'R'"""
PRESENT = "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS claim_id, 'e' || l_linenumber AS excerpt FROM {lineitem} WHERE l_suppkey % 7 <> 0"
BOUND = "SELECT o_orderkey AS worker, CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN 'stale' ELSE o_orderstatus END AS packet_revision, o_orderkey % 29 = 0 AS incompatible FROM {orders} WHERE o_orderkey % 13 <> 0"
HELD = "SELECT o_orderkey AS worker, o_orderstatus AS packet_revision FROM {orders} WHERE o_orderkey % 31 <> 0"


@query(duck("""
WITH j AS (SELECT f.*, c.excerpt AS now, count(*) OVER (PARTITION BY claim_id) AS n FROM f LEFT JOIN c USING (claim_id))
SELECT DISTINCT 'claim' AS level, CAST(claim_id AS VARCHAR) AS subject, 'no identity fields' AS "check" FROM j WHERE worker IS NULL OR reason IS NULL OR NOT has_excerpt
UNION ALL SELECT DISTINCT 'claim', CAST(claim_id AS VARCHAR), 'packet not bound' FROM j WHERE worker IS NOT NULL AND worker NOT IN (SELECT worker FROM b)
UNION ALL SELECT DISTINCT 'claim', CAST(claim_id AS VARCHAR), 'claim repeated' FROM j WHERE n > 1
UNION ALL SELECT DISTINCT 'claim', CAST(claim_id AS VARCHAR), 'claim gone' FROM j WHERE NOT applied AND now IS NULL
UNION ALL SELECT DISTINCT 'claim', CAST(claim_id AS VARCHAR), 'excerpt stale' FROM j WHERE NOT applied AND now <> old_excerpt
UNION ALL SELECT 'packet', CAST(worker AS VARCHAR), CASE WHEN h.worker IS NULL THEN 'unknown packet' WHEN incompatible THEN 'incompatible revisions' WHEN b.packet_revision IS NULL THEN 'no revision' ELSE 'stale revision' END
 FROM b LEFT JOIN h USING (worker) WHERE h.worker IS NULL OR incompatible OR b.packet_revision IS DISTINCT FROM h.packet_revision
""", f=FAILURES, c=PRESENT, b=BOUND, h=HELD))  # fmt: skip
def report_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.report_defects(*(rows(spark, sf_dir, x) for x in (FAILURES, PRESENT, BOUND, HELD)))


RECORDS = """SELECT c_custkey AS work_id, CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'null' WHEN c_custkey % 11 = 0 THEN '" "' WHEN c_custkey % 7 = 0 THEN '7' ELSE '"' || c_name || '"' END AS title,
 CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN 'null' WHEN c_custkey % 9 = 0 THEN '[]' WHEN c_custkey % 8 = 0 THEN '["a", ""]' WHEN c_custkey % 6 = 0 THEN '"' || c_name || '"' WHEN c_custkey % 5 = 0 THEN '["a", 1]' ELSE '["' || c_name || '"]' END AS authors FROM {customer}"""


@query(duck("""
SELECT 'work' AS level, CAST(work_id AS VARCHAR) AS subject, 'title not stated' AS "check" FROM w WHERE title IS NULL UNION ALL SELECT 'work', CAST(work_id AS VARCHAR), 'authors not stated' FROM w WHERE authors IS NULL
UNION ALL SELECT 'work', CAST(work_id AS VARCHAR), 'title is no text' FROM w WHERE json_type(title) <> 'NULL' AND (json_type(title) <> 'VARCHAR' OR trim(title ->> '$') = '')
UNION ALL SELECT 'work', CAST(work_id AS VARCHAR), 'authors are no list' FROM w WHERE json_type(authors) <> 'NULL' AND (json_type(authors) <> 'ARRAY' OR json_array_length(authors) = 0)
UNION ALL SELECT DISTINCT 'work', CAST(work_id AS VARCHAR), 'an author is no text' FROM (SELECT work_id, unnest(from_json(authors, '["JSON"]')) AS a FROM w WHERE json_type(authors) = 'ARRAY') WHERE json_type(a) <> 'VARCHAR' OR trim(a ->> '$') = ''
""", w=RECORDS))  # fmt: skip
def work_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.map_filter(F.create_map(F.lit("title"), F.col("title"), F.lit("authors"), F.col("authors")), lambda _, x: x.isNotNull())
    return plan.bibliography_defects(rows(spark, sf_dir, RECORDS).select("work_id", given.alias("fields")))
