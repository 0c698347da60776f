"""DuckDB SQL for the registered queries of the operators, where SQL can express them."""

from __future__ import annotations

from gatelens.llm.queries import URL_RULES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"

SQL: dict[str, str] = {}

_rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
SQL["op1_url_filter"] = f"""
WITH rules(rh, rp, rv) AS (VALUES {_rules}),
urls AS (
    SELECT page_id, row_number() OVER () AS n,
           {_LOWER.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's')")} AS host,
           regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
    FROM pages),
hits AS (
    SELECT n, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS verdict
    FROM urls JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
    GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN hits USING (n)
"""

SQL["op3_line_dedup"] = f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM lines),
shared AS (
    SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
    SELECT doc_id, pos, line, coalesce(doc_id <> keeper, false) AS dropped
    FROM keyed LEFT JOIN shared ON keyed.key = shared.key AND length(keyed.key) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

SQL["op5_topk_search"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL["op12_lexical_search"] = f"""
WITH items AS (SELECT row_number() OVER () AS item, item_id, {_TERMS.format(_LOWER.format("text"))} AS terms FROM benchmark),
wanted AS (SELECT DISTINCT item, unnest(terms) AS term FROM items),
texts AS (SELECT row_number() OVER () AS place, doc_id, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} AS terms FROM documents),
corpus AS (SELECT count(*) FILTER (len(terms) > 0)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM texts),
held AS (
    SELECT place, term, count(*)::BIGINT AS tf
    FROM (SELECT place, unnest(terms) AS term FROM texts) WHERE term IN (SELECT term FROM wanted)
    GROUP BY place, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM held, corpus GROUP BY term, n_docs),
impacts AS (
    SELECT place, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(terms)::BIGINT * n_docs) // n_terms))) AS gain
    FROM held JOIN weights USING (term) JOIN texts USING (place), corpus),
scored AS (SELECT item, place, sum(gain)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY item, place),
ranked AS (
    SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank
    FROM scored JOIN texts USING (place) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (item) WHERE rank <= 10
"""
