"""DuckDB SQL with the results of those operators that SQL can express."""

from .sql_clusters import clusters

# The inner products of all pairs of a query and a candidate, in integers.
TOP_PRODUCTS = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.ints, c.ints), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.ints) = len(c.ints)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# Base 32 is taken 20 bits, five hexadecimal digits, at a time.
WARC_CAPTURES = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, payload, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
    max(page_id) OVER (PARTITION BY payload) AS top
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31 AS BIGINT) + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""

COLLOCATIONS = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang
), grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
  FROM worded CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS size)
), f AS (
  SELECT lang, size, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 30
), cuts AS (
  SELECT lang, size, phrase, a, w, unnest(range(1, size)) AS k FROM f WHERE size > 1
), scores AS (
  SELECT cuts.lang, cuts.size, cuts.phrase, cuts.a, cuts.w, k, l.a AS l, r.a AS r,
    CAST(CAST(2000000 AS HUGEINT) * cuts.a // (l.a + r.a) AS BIGINT) AS score
  FROM cuts
    JOIN f l ON l.lang = cuts.lang AND l.phrase = array_to_string(cuts.w[1 : k], ' ')
    JOIN f r ON r.lang = cuts.lang AND r.phrase = array_to_string(cuts.w[k + 1 : cuts.size], ' ')
), candidates AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_parts AS (
  SELECT lang, a, array_to_string(w[i : i + s - 1], ' ') AS phrase
  FROM candidates, (SELECT unnest([2, 3]) AS s), (SELECT unnest([1, 2, 3]) AS i)
  WHERE s < size AND i + s - 1 <= size
), kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM inner_parts p WHERE p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.a >= 80 * c.a)
)
SELECT kept.lang AS lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) kept
  JOIN sizes ON sizes.lang = kept.lang
WHERE rank <= 2000
"""

ORACLES = {
    "op3_top_products": TOP_PRODUCTS,
    "op11_bisector_clusters": clusters(),
    "op12_collocations": COLLOCATIONS,
    "op13_warc_captures": WARC_CAPTURES,
}
