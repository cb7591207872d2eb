"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from corposcope.llm.exact_dedup import OP5_SQL, op5_exact_dedup
from corposcope.llm.lang_id import op1_lang_id
from corposcope.llm.line_dedup import op9_line_dedup
from corposcope.llm.near_dedup import op8_near_dedup
from corposcope.llm.packing import op7_packing
from corposcope.llm.pii import op4_pii
from corposcope.llm.quality import op2_quality
from corposcope.llm.tokens import op10_byte_bpe
from corposcope.llm.vectors import op3_vectors
from corposcope.llm.warc import op6_warc

QUERIES = {
    f.__name__: f for f in (op1_lang_id, op2_quality, op3_vectors, op4_pii, op5_exact_dedup, op6_warc, op7_packing, op8_near_dedup, op9_line_dedup, op10_byte_bpe)
}

OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), n AS (SELECT *, sqrt(list_dot_product(e, e)) AS m FROM v),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.m * b.m) >= 0.98
), r(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x), k AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(k.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings e JOIN c ON c.x = e.vec_id LEFT JOIN k ON k.x = e.vec_id
"""

#: A SHA-1 in base 32: its hexadecimal digits as bits, five at a time.
OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
b AS (
  SELECT page_id, h, array_to_string(list_transform(range(1, 41), lambda i:
    list_extract(['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'], instr('0123456789abcdef', substr(sha1(h), i::BIGINT, 1)))), '') AS bits FROM p
), f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM b)
SELECT page_id, strlen(h) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(bits, 5 * i + 1, 1)::BIGINT + 8 * substr(bits, 5 * i + 2, 1)::BIGINT
         + 4 * substr(bits, 5 * i + 3, 1)::BIGINT + 2 * substr(bits, 5 * i + 4, 1)::BIGINT + substr(bits, 5 * i + 5, 1)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
b AS (SELECT doc_id, s, count(*) AS n FROM s GROUP BY doc_id, s), t AS (SELECT doc_id, sum(n) AS total FROM b GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.n, y.n)) AS n FROM b x JOIN b y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
l AS (SELECT a, b FROM o JOIN t p ON p.doc_id = a JOIN t q ON q.doc_id = b WHERE n / (p.total + q.total - n) >= 0.8),
e AS (SELECT a AS x, b AS y FROM l UNION ALL SELECT b, a FROM l),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT x AS doc_id, min(y) AS class_id, x = min(y) AS kept FROM r GROUP BY x
"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, unnest(ls) AS s, generate_subscripts(ls, 1) - 1 AS i FROM d),
c AS (
  SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS cum FROM (
    SELECT doc_id, i, s, trim(regexp_replace(s, '^\s+|\s+$', '', 'g')) AS t, len(list_filter(string_split_regex(s, '\s+'), lambda x: x <> '')) AS w FROM u)
), run AS (
  SELECT a.doc_id, a.i, min(b.i) AS j FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.cum - a.cum + a.w >= 5 WHERE a.w > 0 GROUP BY a.doc_id, a.i
  UNION SELECT b.doc_id, max(a.i), b.i FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.cum - a.cum + a.w >= 5 WHERE b.w > 0 GROUP BY b.doc_id, b.i
), body AS (
  SELECT run.doc_id, run.i, run.j, string_agg(c.t, chr(10) ORDER BY c.i) AS t FROM run JOIN c ON c.doc_id = run.doc_id AND c.i BETWEEN run.i AND run.j AND c.w > 0 GROUP BY run.doc_id, run.i, run.j
), placed AS (SELECT *, first_value(doc_id) OVER o AS fd, first_value(j) OVER o AS fj FROM body WINDOW o AS (PARTITION BY t ORDER BY doc_id, i, j)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i FROM placed WHERE doc_id > fd OR i > fj),
left_ AS (SELECT c.doc_id, count(*) FILTER (g.i IS NULL) AS n, count(g.i) AS n_removed, string_agg(CASE WHEN g.i IS NULL THEN c.s END, chr(10) ORDER BY c.i) AS t
  FROM c LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.i = c.i GROUP BY c.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE greatest(n, 1) END AS n_left_lines, n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d JOIN left_ USING (doc_id)
"""

SQL = {"op3_vectors": OP3_SQL, "op5_exact_dedup": OP5_SQL, "op6_warc": OP6_SQL, "op8_near_dedup": OP8_SQL, "op9_line_dedup": OP9_SQL}


def all_queries():
    import corpus_pipeline

    return QUERIES | {"pipeline": corpus_pipeline.run}


def all_sql():
    import corpus_pipeline

    return SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
