"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs),
keyed AS (SELECT *, {ASCII_LOWER.format(f"trim(line, {SPACES})")} AS k FROM lines),
frequent AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent AS f USING (k) GROUP BY r, doc_id
"""

# Texts as hexadecimal digits of their bytes, so that a byte is two characters.
SUFFIX_DEDUP = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT r, h, unnest(range(0, length(h) // 2 - 399)) AS p FROM docs WHERE length(h) >= 800),
strings AS (SELECT r, p, md5(substr(h, CAST(2 * p + 1 AS BIGINT), 800)) AS s FROM starts),
repeated AS (SELECT s FROM strings GROUP BY s HAVING count(*) > 1),
hits AS (SELECT r, p FROM strings SEMI JOIN repeated USING (s)),
runs AS (
  SELECT r, p, sum(fresh) OVER (PARTITION BY r ORDER BY p) AS run
  FROM (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 400 THEN 0 ELSE 1 END AS fresh FROM hits)),
spans AS (SELECT r, min(p) AS a, max(p) + 400 AS b FROM runs GROUP BY r, run),
gaps AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM spans),
kept AS (
  SELECT r, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, CAST(2 * since + 1 AS BIGINT), CAST(2 * (a - since) AS BIGINT)), '' ORDER BY a)
           || substr(any_value(h), CAST(2 * max(b) + 1 AS BIGINT)) AS rest
  FROM gaps JOIN docs USING (r) GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""



def _round(i: int) -> str:
    """Nearest centroids ``n<i>`` of the vectors, and the centroids ``c<i + 1>`` after them."""
    return f"""
d{i} AS (SELECT r, c, sum((cells.x - c{i}.x) * (cells.x - c{i}.x)) AS dist FROM cells JOIN c{i} USING (d) GROUP BY r, c),
n{i} AS MATERIALIZED (SELECT r, c, dist FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, c) = 1),
s{i} AS (SELECT c, d, sum(x) AS s, count(*) AS n FROM n{i} JOIN cells USING (r) GROUP BY c, d),
c{i + 1} AS MATERIALIZED (SELECT c, d, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{i} LEFT JOIN s{i} USING (c, d))"""


CENTROIDS = f"""
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = 64),
cells AS MATERIALIZED (SELECT r, CAST(unnest(v) AS HUGEINT) AS x, generate_subscripts(v, 1) AS d FROM whole),
first AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM whole QUALIFY c < 40),
c0 AS MATERIALIZED (SELECT c, CAST(unnest(v) AS HUGEINT) AS x, generate_subscripts(v, 1) AS d FROM first),
{",".join(_round(i) for i in range(6))},
shas AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS sha FROM c5 GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
       CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
FROM n5 JOIN whole USING (r) JOIN shas USING (c)
"""

ORACLES = {"op1_suffix_dedup": SUFFIX_DEDUP, "op7_line_dedup": LINE_DEDUP, "op11_centroids": CENTROIDS}
