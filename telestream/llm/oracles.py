"""SQL (DuckDB) that gives the rows of the queries that SQL can express.

Components and covered words are found by definition here: by joining all pairs and by
counting windows, with neither suffix arrays nor hashes of sets.
"""

from __future__ import annotations

from .quality_rules import Limits
from .source_schedule import MODULUS, STEP

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_L = Limits()

RULES = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
 p AS (SELECT r, span, i, array_to_string(ws[i:i + span - 1], ' ') AS win FROM (SELECT r, span, ws, unnest(range(1, len(ws) - span + 2)) AS i FROM d, (VALUES ({_L.span}), ({_L.min_repeat}), ({_L.max_longest + 1})) v(span) WHERE len(ws) > span)),
 rep AS (SELECT r, span, unnest(list(i)) AS i FROM p GROUP BY r, span, win HAVING count(*) > 1),
 cov AS (SELECT r, span, count(DISTINCT i + j) AS n FROM rep, range({_L.max_longest + 1}) t(j) WHERE j < span GROUP BY 1, 2),
 lines AS (SELECT r, count(*) - count(DISTINCT l) AS dup FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
 x AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0)::BIGINT AS word_chars, (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
   coalesce(a.n, 0)::BIGINT AS n_repeat_words, coalesce(b.n, 0)::BIGINT AS covered_words, c.n IS NOT NULL AS too_long
  FROM d LEFT JOIN lines USING (r) LEFT JOIN cov a ON a.r = d.r AND a.span = {_L.min_repeat} LEFT JOIN cov b ON b.r = d.r AND b.span = {_L.span} LEFT JOIN cov c ON c.r = d.r AND c.span = {_L.max_longest + 1}),
 y AS (SELECT *, n_words < {_L.min_words} OR 100 * n_repeat_words > {_L.max_base_percent} * n_words AS base_failed FROM x)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, covered_words, NOT base_failed AND 100 * covered_words <= {_L.max_percent} * n_words AND NOT too_long AS kept FROM y"""

BASE32 = "array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (k // 4) * 5 + 1, 5))::INT >> (15 - 5 * (k % 4))) & 31) + 1)::BIGINT, 1)), '')"
WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages), l AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
 SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {BASE32} AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM l"""

VECTORS = """WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), u AS (SELECT * FROM e WHERE v IS NOT NULL AND list_max(list_transform(v, lambda x: abs(x))) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 k AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
 r AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, k.b FROM r JOIN k ON k.a = r.b),
 c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1), n AS (SELECT a AS vec_id, count(*) AS n_links FROM k GROUP BY 1)
 SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)"""

DUPLICATES = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM d)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 j AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS same FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 k AS (SELECT a, b FROM j JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * same >= 85 * (x.n + y.n - same)),
 r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, k.b FROM r JOIN k ON k.a = r.b), c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
 SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""

MIX = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, len({WORDS})::BIGINT AS size, md5('mix' || coalesce(doc_id::VARCHAR, md5(text), '')) AS place, md5(coalesce(text, '')) AS tie FROM documents),
 s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS no FROM d GROUP BY source),
 w AS (SELECT *, [5, 2, 1][no % 3 + 1]::DOUBLE AS w, sum(n) OVER ()::DOUBLE AS total FROM s),
 f AS (SELECT *, row_number() OVER (ORDER BY n / w, no) AS k FROM w),
 g AS (SELECT *, coalesce(sum(3.0 * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped, sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM f),
 m AS (SELECT coalesce(min(k), 1e9) AS free FROM g WHERE (total - capped) * w / rest <= 3.0 * n),
 h AS (SELECT (total - capped) AS left_over, rest AS left_weight FROM g, m WHERE k = free),
 t AS (SELECT no, source, n, CASE WHEN k < free THEN 3.0 * n ELSE (SELECT left_over FROM h) * w / (SELECT left_weight FROM h) END::DOUBLE AS target, CASE WHEN n = 0 THEN 0 ELSE greatest(1, (2 * n + 128) // 256) END::BIGINT AS blocks FROM g, m),
 q AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE floor(target * blocks / n * 1e6)::BIGINT END AS q FROM t),
 b AS (SELECT *, (sum(q) OVER (ORDER BY no) - q)::HUGEINT AS low, (sum(q) OVER (ORDER BY no))::HUGEINT AS high, greatest(1, sum(q) OVER ())::HUGEINT AS q_all FROM q),
 bounds AS (SELECT no, source, n, target, blocks, (low * {MODULUS} // q_all)::BIGINT AS low, (high * {MODULUS} // q_all)::BIGINT AS high, ((q_all + 500000) // 1000000)::BIGINT AS n_slots FROM b),
 slots AS (SELECT i, (i % {MODULUS}) * {STEP} % {MODULUS} AS point FROM range((SELECT coalesce(max(n_slots), 0)::BIGINT FROM bounds)) x(i)),
 ranked AS (SELECT no, blocks, row_number() OVER (PARTITION BY no ORDER BY i) - 1 AS place FROM slots JOIN bounds ON point >= low AND point < high),
 times AS (SELECT no, place % blocks AS block, count(*) AS k FROM ranked WHERE place < 3 * blocks GROUP BY 1, 2),
 p AS (SELECT d.r, d.doc_id, d.size, b.no, b.n, b.target, b.blocks, (coalesce(sum(d.size) OVER (PARTITION BY b.no ORDER BY place, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start FROM d JOIN bounds b ON b.source IS NOT DISTINCT FROM d.source),
 o AS (SELECT p.r, sum(greatest(0, least(start + size, (block + 1) * n // blocks) - greatest(start, block * n // blocks)) * k)::BIGINT AS taken FROM p JOIN times USING (no) WHERE size > 0 AND start < (block + 1) * n // blocks AND start + size > block * n // blocks GROUP BY 1)
 SELECT doc_id, size, n AS source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM p LEFT JOIN o USING (r)"""

ORACLES: dict[str, str] = {
    "op1_suffix_repetition": RULES,
    "op2_zip_warc": WARC,
    "op3_sorted_projections": VECTORS,
    "op6_tensored_minhash": DUPLICATES,
    "op7_source_schedule": MIX,
}
