"""DuckDB SQL with the result of the centroid clustering."""

START = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row_no,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), x) - 1 AS INTEGER) AS cluster, x AS c
  FROM v QUALIFY cluster < 16
)"""

NEAREST = """, near{n} AS (
  SELECT row_no, arg_min(cluster, distance * 16 + cluster) AS cluster, min(distance) AS distance FROM (
    SELECT row_no, cluster,
      CAST(list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
    FROM v CROSS JOIN c{n}
  ) GROUP BY row_no
)"""

MOVED = """, sums{n} AS (
  SELECT cluster, place, sum(value) AS total, count(*) AS members
  FROM (SELECT cluster, unnest(x) AS value, unnest(range(64)) AS place FROM v JOIN near{n} USING (row_no))
  GROUP BY cluster, place
), moved{n} AS (
  SELECT cluster, list(CAST((total - (total % members + members) % members) // members AS BIGINT) ORDER BY place) AS m
  FROM sums{n} GROUP BY cluster
), c{next} AS (
  SELECT c{n}.cluster, coalesce(m, c) AS c FROM c{n} LEFT JOIN moved{n} ON c{n}.cluster = moved{n}.cluster
)"""

RESULT = """, held AS (SELECT cluster, sum(distance) AS inertia FROM near{n} GROUP BY cluster)
SELECT vec_id, near{n}.cluster AS cluster, distance, CAST(held.inertia AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(inertia) FROM held) AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{n} JOIN v USING (row_no) JOIN held ON held.cluster = near{n}.cluster
  JOIN c{n} ON c{n}.cluster = near{n}.cluster
"""


def clusters(rounds: int = 3) -> str:
    each = "".join(NEAREST.format(n=n) + MOVED.format(n=n, next=n + 1) for n in range(rounds))
    return START + each + NEAREST.format(n=rounds) + RESULT.format(n=rounds)
