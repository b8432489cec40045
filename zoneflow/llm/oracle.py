"""DuckDB SQL for the corpus queries that SQL can express, written apart from the operators.

No SQL: packing (dynamic program), HTML extraction (tree matching), quality classifier,
language identification and toxicity (fitted models), whitening (decomposition), and the
pipeline, which contains two of them.
"""

from __future__ import annotations

from zoneflow.llm.url_filter import BLOCK_PATTERNS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS "rank" FROM s)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 5
"""

_HOST_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def _rule_sql(rule: str) -> str:
    host, path = rule.split("/", 1)
    return f"(h = '{host}' OR ends_with(h, '.{host}')) AND starts_with(p, '/{path}')"


def _longest(rows, condition, value) -> str:
    whens = " ".join(f"WHEN {condition(r)} THEN {value(r)}" for r in sorted(rows, key=lambda r: (-len(r[0]), r[0])))
    return f"CASE {whens} END"


_PATTERNS = sorted(((p, "block") for p in BLOCK_PATTERNS), key=lambda r: (len(r[0]), r[0]), reverse=True)
_PATTERN_CASE = "CASE " + " ".join(f"WHEN regexp_matches(u, '(^|[^a-z0-9]){p.strip('^')}([^a-z0-9]|$)') THEN '{p}'" for p, _ in _PATTERNS) + " END"

OP3 = f"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest, {LOWER.format("coalesce(url, '')")} AS u FROM pages),
b AS (SELECT page_id, url, u, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS h, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS p FROM a),
c AS (SELECT page_id, url, h AS host, p AS path, {_longest(_HOST_RULES, lambda r: _rule_sql(r[0]), lambda r: f"'{r[0]}'")} AS rule, {_PATTERN_CASE} AS pat,
      {_longest(_HOST_RULES, lambda r: _rule_sql(r[0]), lambda r: f"'{r[1]}'")} AS ruled FROM b)
SELECT page_id, url, host, path, rule, CASE WHEN rule IS NULL THEN pat END AS pattern,
       coalesce(ruled, CASE WHEN pat IS NOT NULL THEN 'block' END, 'allow') AS verdict FROM c
"""

OP5 = """
WITH b AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM b),
g AS (SELECT page_id, payload_bytes, list_reduce(list_transform(range(0, 8), lambda i: list_reduce(list_transform(range(0, 4), lambda j:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * i::INTEGER, 5))::BIGINT >> (15 - 5 * j::INTEGER)) & 31)::INTEGER, 1)), lambda x, y: x || y)), lambda x, y: x || y) AS payload_digest FROM h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM g)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f
"""

OP6 = f"""
WITH d AS (SELECT doc_id, source, len({WORDS})::BIGINT AS size,
                  ('0x' || substr(md5('20240611|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (i - 1) % 3] AS w, source_size * 3 AS cap FROM s),
r AS (SELECT *, cap / w AS ratio, row_number() OVER (ORDER BY cap / w, i) AS n,
             sum(source_size) OVER ()::BIGINT - coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS left_over,
             sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weights FROM w),
l AS (SELECT *, left_over / weights AS level, min(CASE WHEN left_over / weights <= ratio THEN n END) OVER () AS f FROM r),
t AS (SELECT source, source_size, CASE WHEN n < f THEN cap::DOUBLE ELSE least(max(CASE WHEN n = f THEN level END) OVER () * w, cap::DOUBLE) END AS target FROM l),
p AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
             sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT - size AS seen
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - seen)))::BIGINT AS taken, source FROM p
"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS t FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.x = d.doc_id
"""

OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
i AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM d),
k AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM i),
rep AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM k WHERE c >= 2) GROUP BY rid),
x AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
y AS (SELECT rid, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM x),
dup AS (SELECT rid, sum(c - 1) AS n FROM (SELECT rid, line, count(*) AS c FROM y WHERE n > 0 GROUP BY rid, line) GROUP BY rid),
z AS (SELECT rid, regexp_replace(trim(regexp_replace(lower(line), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '), '[0-9]+', '0', 'g') AS l, sum(n) AS n FROM y WHERE n > 0 GROUP BY 1, 2),
hosts AS (SELECT source, count(DISTINCT t) AS docs FROM d GROUP BY source),
held AS (SELECT d.source, z.l, count(DISTINCT d.t) AS docs FROM z JOIN d USING (rid) GROUP BY 1, 2),
freq AS (SELECT held.source, l FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source WHERE held.docs > 10 AND held.docs > hosts.docs * 0.1),
rem AS (SELECT rid, sum(n) AS n FROM z JOIN d USING (rid) JOIN freq ON freq.l = z.l AND freq.source IS NOT DISTINCT FROM d.source GROUP BY rid),
o AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda v: len(v))), 0)::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
      coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(rem.n, 0)::BIGINT AS removed_words
      FROM d LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN rem USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM o)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT removed_words > 0.7 * n_words AS kept, removed_words FROM b
"""

_TERMS = "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents),
s AS (SELECT count(*) AS big_n, sum(len(w))::BIGINT AS big_l FROM d WHERE len(w) > 0),
q AS (SELECT row_number() OVER () AS qid, item_id, unnest({_TERMS}) AS t FROM benchmark),
p AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY rid, t),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
g AS (SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS wt FROM f, s),
h AS (SELECT p.rid, d.doc_id, p.t, wt * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(w) * big_n) // big_l))) AS v
      FROM p JOIN d ON p.rid = d.rid JOIN g ON g.t = p.t, s),
c AS (SELECT qid, item_id, rid, doc_id, sum(v)::BIGINT AS score FROM q JOIN h ON q.t = h.t GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS "rank" FROM c WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM r WHERE "rank" <= 20
"""

ORACLE = {"op1_topk": OP1, "op3_url_filters": OP3, "op5_warc": OP5, "op6_mixing": OP6, "op9_ngram_join": OP9, "op10_line_frequency": OP10, "op13_lexical": OP13}
