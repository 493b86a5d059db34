"""DuckDB statements for the operators that SQL can express; quick up to some thousand documents."""

from __future__ import annotations

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({_LOWERED}, '{_ALNUM}') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
  FROM b, LATERAL unnest(range(1, greatest(len(w) - 9, 1) + 1)) g(i) WHERE len(w) > 0),
doc_windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
  FROM (SELECT * FROM d, (SELECT DISTINCT k FROM item_windows)), LATERAL unnest(range(1, len(w) - k + 2)) g(i)),
hits AS (SELECT doc_id, i, k, item FROM doc_windows JOIN item_windows USING (k, t)),
places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(places.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       coalesce(digest, sha256('')) AS items_sha256, places.n IS NOT NULL AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS t FROM d, LATERAL unnest(range(1, len(w) - 48)) g(i)),
repeats AS (SELECT t, min(doc_id) AS low FROM windows GROUP BY t HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM windows JOIN repeats USING (t) WHERE low < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

NEAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '{_ALNUM}') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM d, LATERAL unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b, shared.n = p.n AND shared.n = q.n AS same
  FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE shared.n::DOUBLE / (p.n + q.n - shared.n) >= 0.8),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
classes AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
degrees AS (SELECT a, count(*) AS n, min(b) FILTER (same) AS first FROM links GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id, least(doc_id, coalesce(first, doc_id)) AS copy_of,
       coalesce(n, 0)::BIGINT AS n_links
FROM d LEFT JOIN classes ON classes.a = doc_id LEFT JOIN degrees ON degrees.a = doc_id
"""

_FINITE = ("embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 "
           "AND len(embedding) = (SELECT len(embedding) AS l FROM embeddings WHERE embedding IS NOT NULL "
           "GROUP BY l ORDER BY count(*) DESC, l DESC LIMIT 1)")


def _whole(scale: int) -> str:
    return f"list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT)"


def _round(number: int, books: str) -> str:
    """Entries of the parts by ``books``, and the codebooks that follow from them."""
    return f"""
near{number} AS (
  SELECT r, part, first(entry ORDER BY d, entry) AS entry, min(d) AS d
  FROM (SELECT r, part, entry, list_sum(list_transform(list_zip(p, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM parts JOIN {books} USING (part))
  GROUP BY r, part),
books{number} AS (
  SELECT part, entry, coalesce(m, e) AS e
  FROM {books} LEFT JOIN (
    SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY i) AS m
    FROM (SELECT part, entry, i, sum(x)::BIGINT AS total, count(*) AS n
          FROM (SELECT part, entry, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM near{number} JOIN parts USING (r, part))
          GROUP BY part, entry, i)
    GROUP BY part, entry) USING (part, entry))"""


CODES = f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, {_whole(256)} AS c FROM embeddings
           WHERE {_FINITE}),
parts AS (SELECT r, part, c[part * w + 1:part * w + w] AS p
          FROM (SELECT r, c, len(c) // 16 AS w FROM v), LATERAL unnest(range(16)) g(part)),
books0 AS (SELECT part, r - 1 AS entry, p AS e FROM parts WHERE r <= 64),{_round(1, "books0")},{_round(2, "books1")},{_round(3, "books2")},
digest AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books2),
coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near3 GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN coded USING (r), digest
"""

NEGATIVES = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_whole(256)} AS c
           FROM embeddings WHERE {_FINITE} AND vec_id IS NOT NULL AND label IS NOT NULL),
scored AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, list_dot_product(a.c::DOUBLE[], x.c::DOUBLE[])::BIGINT AS s
  FROM v a JOIN v x ON a.vec_id % 100 = 0 AND a.vec_id <> x.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, s AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score
QUALIFY rank <= 10
"""

PRODUCTS = f"""
WITH v AS (SELECT vec_id, {_whole(64)} AS c FROM embeddings WHERE {_FINITE} AND vec_id IS NOT NULL)
SELECT q.vec_id AS query_id, (row_number() OVER (PARTITION BY q.vec_id ORDER BY s DESC, x.vec_id))::INTEGER AS rank, x.vec_id, s AS score
FROM v q JOIN v x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id,
     LATERAL (SELECT list_dot_product(q.c::DOUBLE[], x.c::DOUBLE[])::BIGINT AS s)
QUALIFY rank <= 20
"""
