"""DuckDB SQL for the operators' queries, where SQL can say the same."""

from __future__ import annotations

from folioscan.llm.licences import KNOWN, NOTICE, SPELLINGS, whole_texts
from folioscan.llm.quality_rules import GRIDS

WORDS = r"list_filter(regexp_split_to_array({x}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAMS = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(x=ASCII_LOWER)} AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w WHERE len(w) > 0),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 75 * (x.n + y.n - k)),
 r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM r WHERE r.a = d.doc_id) AS component_id FROM documents d LEFT JOIN n USING (doc_id)
"""

LINK_COUNTS = f"""
WITH w AS (SELECT doc_id, {WORDS.format(x=ASCII_LOWER)} AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM w WHERE len(w) > 0),
 k AS (SELECT doc_id, md5(string_agg(g, chr(10) ORDER BY g)) AS class, count(*) AS n FROM s GROUP BY 1),
 r AS (SELECT class, min(doc_id) AS doc_id, min(n) AS n FROM k GROUP BY 1),
 e AS (SELECT r.class, r.n, s.g FROM r JOIN s USING (doc_id)),
 c AS (SELECT a.class AS a, b.class AS b, a.n AS m, b.n AS n, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.class <> b.class GROUP BY ALL),
 l AS (SELECT a AS class, count(*) AS n_links FROM c WHERE 100 * k >= 75 * (m + n - k) GROUP BY 1)
SELECT d.doc_id, coalesce(l.n_links, 0)::BIGINT AS n_links FROM documents d LEFT JOIN k USING (doc_id) LEFT JOIN l USING (class)
"""


def shards(limit: int) -> str:
    return f"""
WITH k AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS b FROM documents),
 s AS (SELECT d, b >> (60 - d)::INTEGER AS p, sum(n) AS n, count(DISTINCT b) AS k FROM k, range(0, 61) t(d) GROUP BY ALL),
 f AS (SELECT k.doc_id, k.n, k.b, min(s.d) AS d FROM k JOIN s ON k.b >> (60 - s.d)::INTEGER = s.p WHERE s.n <= {limit} OR s.k = 1 GROUP BY ALL)
SELECT doc_id, n AS n_bytes, d::INTEGER AS depth, CASE WHEN d = 0 THEN '' ELSE right(lpad(bin(b >> (60 - d)::INTEGER), 60, '0'), d::INTEGER) END AS shard, 0::BIGINT AS part FROM f
"""


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _spelt(form: str) -> str:
    unified = ", ".join(f"{_quoted(a)}: {_quoted(b)}" for a, b in SPELLINGS.items())
    return f"array_to_string(list_transform(string_split({form}, ' '), lambda w: coalesce(MAP {{{unified}}}[w], w)), ' ')"


CANON = r"regexp_replace(replace(replace(lower(coalesce(text, '')), '©', ' copyright '), '(c)', ' copyright '), '[^\p{L}\p{N}\n]+', ' ', 'g')"
FORM = "array_to_string(list_filter(list_transform(string_split({x}, chr(10)), lambda y: trim(y)), lambda y: y <> '' AND NOT starts_with(y, 'copyright ') AND y <> 'copyright'), ' ')"
GAP = r"regexp_split_to_array({x}, '\n ?\n[ \n]*')"
UNWRAPPED = f"array_to_string(list_filter(list_transform({GAP}, lambda y: trim(regexp_replace(y, '[ \\n]+', ' ', 'g'))), lambda y: y <> '' AND NOT ((starts_with(y, 'copyright ') OR y = 'copyright') AND len(string_split(y, ' ')) <= {NOTICE})), ' ')"
BOTH = f"list_distinct([{FORM}, {UNWRAPPED}])"
LICENCES = f"""
WITH v(licence, text) AS (VALUES {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in (*KNOWN, *whole_texts()))}),
 k AS (SELECT min(licence) AS licence, f FROM (SELECT licence, {_spelt("f")} AS f FROM (SELECT licence, unnest({BOTH.format(x=CANON)}) AS f FROM v)) WHERE f <> '' GROUP BY f),
 c AS (SELECT row_number() OVER () AS r, doc_id, {CANON} AS c FROM documents),
 p AS (SELECT r, doc_id, 'text' AS unit, [c] AS parts FROM c
  UNION ALL SELECT r, doc_id, 'line', string_split(c, chr(10)) FROM c WHERE contains(c, chr(10))
  UNION ALL SELECT r, doc_id, 'paragraph', {GAP.format(x="c")} FROM c WHERE contains(c, chr(10) || chr(10)) OR contains(c, chr(10) || ' ' || chr(10))),
 u AS (SELECT r, doc_id, unit, unnest(range(0, len(parts))) AS "at", unnest(parts) AS part FROM p),
 f AS (SELECT r, doc_id, unit, "at", unnest(CASE WHEN unit = 'line' THEN [{FORM.format(x="part")}] ELSE {BOTH.format(x="part")} END) AS f FROM u)
SELECT doc_id, unit, "at", min(licence) AS licence FROM f JOIN k ON {_spelt("f.f")} = k.f GROUP BY r, doc_id, unit, "at"
"""


def quality(risk: float, level: float, stratum: str = "coalesce(lang, '')") -> str:
    """The base counts, the holdout's counts, the binomial tails and the verdict."""
    scores = {
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
        "repeated_words": "n_repeat_words / greatest(n_words, 1)",
        "long_words": "word_chars / greatest(n_words, 1)",
        "short_words": "-word_chars / greatest(n_words, 1)",
    }
    rules = " UNION ALL ".join(f"SELECT doc_id, stratum, ok, {k} AS rule, {len(g)} AS size, len(list_filter([{', '.join(repr(float(x)) for x in g)}]::DOUBLE[], lambda y: y < x)) AS bin FROM (SELECT *, ({scores[name]})::DOUBLE AS x FROM b)" for k, (name, g) in enumerate(GRIDS.items()))
    p = risk / len(GRIDS)
    return f"""
WITH w AS (SELECT doc_id, {stratum} AS stratum, coalesce(text, '') AS text, {WORDS.format(x="coalesce(text, '')")} AS w FROM documents),
 v AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM w WHERE len(w) > 8),
 m AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i FROM v QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), range(0, 8) t(j) GROUP BY 1),
 f AS (SELECT w.doc_id, stratum, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls, coalesce(m.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN m ON m.doc_id = w.doc_id),
 b AS (SELECT *, len(ls) AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words AS ok FROM f),
 s AS ({rules}),
 h AS (SELECT stratum, rule, size, bin, count(*) AS n FROM s JOIN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY 1 HAVING min(quality) = 1) USING (doc_id) WHERE ok GROUP BY ALL),
 t AS (SELECT greatest(count(DISTINCT stratum), 1) * {len(GRIDS)} AS tests FROM h),
 j AS (SELECT stratum, rule, size, c, sum(n)::BIGINT AS n, coalesce(sum(n) FILTER (WHERE bin > c), 0)::BIGINT AS k FROM h, range(0, 65) r(c) WHERE c < size GROUP BY ALL),
 q AS (SELECT stratum, rule, size, c, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p!r}) + (n - i) * ln(1 - {p!r})))) <= {level!r} / (SELECT tests FROM t) AS refuted FROM j),
 z AS (SELECT stratum, rule, coalesce(max(c) FILTER (WHERE NOT refuted) + 1, 0) AS most FROM q GROUP BY ALL),
 bad AS (SELECT DISTINCT s.doc_id FROM s JOIN z USING (stratum, rule) WHERE s.bin > z.most)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, NOT ok AS base_failed, ok AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM b
"""


def url_rules(rules: dict[str, str]) -> str:
    """Host and path by regular expressions, rules joined by suffix and prefix, the longest one first."""
    rows = ", ".join(f"({_quoted(name)}, {_quoted(name.partition('/')[0])}, {_quoted('/' + name.partition('/')[2])}, {_quoted(verdict)})" for name, verdict in rules.items())
    return f"""
WITH r(rule, site, rest, verdict) AS (VALUES {rows}),
 p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
 f AS (SELECT page_id, max_by(r.rule, (length(r.rule), length(site), r.rule)) AS rule, max_by(verdict, (length(r.rule), length(site), r.rule)) AS verdict FROM p JOIN r ON (host = site OR ends_with(host, '.' || site)) AND starts_with(path, rest) GROUP BY 1)
SELECT page_id, host, path, rule, verdict FROM p LEFT JOIN f USING (page_id)
"""
