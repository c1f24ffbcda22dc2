"""SQL for the queries that SQL can express."""

from __future__ import annotations

from visitloom.llm.decontamination import WINDOW
from visitloom.llm.licenses import BLOCK_STEP, BLOCK_WORDS, PHRASES, TEMPLATES, THRESHOLD
from visitloom.llm.line_dedup import LEAST_WORDS
from visitloom.llm.near_dedup import PERCENT, SHINGLE

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lowered}, '{_WORD}')"


def _values(rows) -> str:
    quoted = ("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in row) + ")" for row in rows)
    return "VALUES " + ", ".join(quoted)


LICENSES = f"""
WITH d AS (SELECT doc_id, {_words("text")} AS w FROM documents),
r AS (SELECT row_number() OVER () AS row_id, doc_id, w, len(w) AS n FROM d),
phrases AS (
    SELECT label, {_words("phrase")} AS p FROM ({_values(PHRASES.items())}) v(phrase, label)),
starts AS (
    SELECT r.row_id, label, unnest(list_filter(range(n - len(p) + 1), lambda i: w[i + 1:i + len(p)] = p)) AS place
    FROM r, phrases WHERE list_has_all(w, p)),
base AS (
    SELECT row_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM starts GROUP BY row_id),
templates AS (
    SELECT label, list_distinct({_words("statement")}) AS t FROM ({_values(TEMPLATES)}) v(label, statement)),
blocks AS (
    SELECT row_id, w[b + 1:b + {BLOCK_WORDS}] AS block
    FROM (SELECT row_id, w, unnest(range(0, n, {BLOCK_STEP})) AS b FROM r) q),
joined AS (
    SELECT row_id, label, len(list_intersect(block, t)) / len(t) AS share FROM blocks, templates),
found AS (
    SELECT row_id, label, share FROM joined WHERE round(share - {THRESHOLD}, 9) >= 0
    UNION ALL SELECT row_id, label, 1.0 FROM starts),
labelled AS (
    SELECT row_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM found GROUP BY row_id)
SELECT doc_id, n AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM r LEFT JOIN base USING (row_id) LEFT JOIN labelled USING (row_id)"""

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, {_words("text")} AS w FROM documents),
items AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS size, w[i + 1:i + {WINDOW}] AS win
    FROM (SELECT item_id, w, unnest(range(greatest(len(w) - {WINDOW - 1}, 1))) AS i FROM items WHERE len(w) > 0) q),
distinct_windows AS (SELECT DISTINCT size, win FROM windows),
places AS (
    SELECT row_id, size, p, w[p + 1:p + size] AS win
    FROM (SELECT row_id, w, size, unnest(range(len(w) - size + 1)) AS p
          FROM d, (SELECT DISTINCT size FROM windows) s WHERE len(w) >= size) q),
hits AS (SELECT row_id, size, p, win FROM places SEMI JOIN distinct_windows USING (size, win)),
hit_words AS (
    SELECT row_id, count(DISTINCT word) AS n_hit
    FROM (SELECT row_id, unnest(range(p, p + size)) AS word FROM hits) q GROUP BY row_id),
hit_items AS (
    SELECT row_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT row_id, item_id::VARCHAR AS item_id FROM hits JOIN windows USING (size, win)
          WHERE item_id IS NOT NULL) q GROUP BY row_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (row_id) LEFT JOIN hit_items USING (row_id)"""

NEAR_DEDUP = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS row_id, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT row_id, w[i + 1:i + {SHINGLE}] AS s
    FROM (SELECT row_id, w, unnest(range(greatest(len(w) - {SHINGLE - 1}, 1))) AS i FROM d WHERE len(w) > 0) q),
sizes AS (SELECT row_id, count(*) AS n FROM shingles GROUP BY row_id),
pairs AS (
    SELECT a.row_id AS a, b.row_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.row_id <> b.row_id GROUP BY 1, 2),
links AS (
    SELECT da.doc_id AS a, db.doc_id AS b FROM pairs p JOIN sizes x ON p.a = x.row_id JOIN sizes y ON p.b = y.row_id
    JOIN d da ON p.a = da.row_id JOIN d db ON p.b = db.row_id WHERE 100 * common >= {PERCENT} * (x.n + y.n - common)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least ON d.doc_id = least.a LEFT JOIN sizes USING (row_id)"""

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, string_split(text, chr(10)) AS lines FROM documents),
l AS (
    SELECT row_id, doc_id, i AS line_no,
        regexp_split_to_array(trim(translate(lines[i], chr(9) || chr(11) || chr(12) || chr(13), '    '), ' '), ' +') AS w
    FROM (SELECT row_id, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM d WHERE doc_id IS NOT NULL) q),
firsts AS (SELECT w, min(row(doc_id, line_no)) AS first FROM l WHERE w[1] <> '' GROUP BY w),
whole AS (SELECT w, first, len(w) AS n FROM firsts WHERE len(w) >= {LEAST_WORDS}),
without AS (
    SELECT w, first, n, i, w[:i - 1] || w[i + 1:] AS rest
    FROM (SELECT w, first, n, unnest(range(1, n + 1)) AS i FROM whole) q),
near AS (
    SELECT w FROM (SELECT w, first, min(first) OVER (PARTITION BY n, i, rest) AS least FROM without) q WHERE least < first
    UNION SELECT a.w FROM whole a JOIN without b ON a.w = b.rest WHERE b.first < a.first
    UNION SELECT b.w FROM whole a JOIN without b ON a.w = b.rest WHERE a.first < b.first),
gone AS (
    SELECT row_id, line_no FROM l JOIN firsts USING (w) WHERE row(doc_id, line_no) > first
    UNION SELECT row_id, line_no FROM l JOIN near USING (w)),
removed AS (SELECT row_id, list(line_no) AS places FROM gone GROUP BY row_id)
SELECT doc_id, coalesce(len(places), 0)::INTEGER AS lines_removed, CASE WHEN lines IS NULL THEN NULL ELSE array_to_string(
    list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(coalesce(places, []), i)),
        lambda i: lines[i]), chr(10)) END AS text
FROM d LEFT JOIN removed USING (row_id)"""

TOP_K = """
WITH v AS (
    SELECT row_number() OVER () AS row_id, vec_id,
        list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
queries AS (SELECT DISTINCT vec_id AS query_id, q AS query FROM v WHERE vec_id % 100 = 0),
scored AS (
    SELECT query_id, query, vec_id,
        coalesce(list_sum(list_transform(range(1, len(q) + 1), lambda i: q[i] * query[i])), 0)::BIGINT AS score
    FROM queries JOIN v ON v.vec_id <> query_id AND len(q) = len(query)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

ORACLE: dict[str, str] = {
    "op1_license_scan": LICENSES,
    "op2_exact_top_k": TOP_K,
    "op5_line_dedup": LINES,
    "op7_decontamination": DECONTAMINATION,
    "op9_near_dedup": NEAR_DEDUP,
}
