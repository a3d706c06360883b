"""SQL for DuckDB with the rows of those queries that SQL can express."""

from __future__ import annotations

_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Lower case for A-Z alone.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(text: str, pattern: str, lower: bool) -> str:
    value = f"coalesce({text}, '')"
    return f"regexp_extract_all({_LOWER.format(value) if lower else value}, '{pattern}')"


def product_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every part compared with every entry, round after round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, p, min({{'d': d, 'e': e}}) AS m FROM (SELECT r, x.p, e,
  CAST(list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM x JOIN b{i} b ON x.p = b.p) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.v, b.v) AS v FROM b{i} b LEFT JOIN (SELECT p, e, list(c ORDER BY pos) AS v FROM (
  SELECT p, e, pos, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS c FROM (SELECT x.p, m.e AS e, pos, sum(v[pos]) AS s, count(*) AS n
  FROM x JOIN a{i} a ON x.r = a.r AND x.p = a.p, unnest(range(1, len(v) + 1)) AS u(pos) GROUP BY ALL)) GROUP BY p, e) n ON n.p = b.p AND n.e = b.e)""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (SELECT r, p, list_transform(embedding[p * (len(embedding) // {parts}) + 1:(p + 1) * (len(embedding) // {parts})],
  lambda c: CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM kept, range({parts}) AS t(p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM x WHERE r <= {entries}),
{", ".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN kept USING (r), book
"""


ORACLES = {
    "op3_url_automaton": """
WITH parts AS (SELECT page_id, translate(regexp_extract(u, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(u, '://[^/?#]*([^?#]*)', 1) AS path FROM (SELECT page_id, coalesce(url, '') AS u FROM pages)),
ruled AS (SELECT *, CASE
  WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
  WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
  WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
  WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN ('.' || host) LIKE '%.cheap-pills.%' OR ('.' || host) LIKE '%.spam-farm.%' THEN 'block' ELSE 'allow' END AS verdict FROM ruled
""",
    "op5_parity_sketch_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {words('text', _SPACED, True)} AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM
  (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * ((SELECT n FROM n WHERE doc_id = a.doc_id) + (SELECT n FROM n WHERE doc_id = b.doc_id) - count(*))),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS r FROM ways UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON reach.r = ways.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.r, d.doc_id) AS component_id FROM documents d
LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
""",
    "op6_relative_lz_dedup": f"""
WITH w AS (SELECT doc_id, {words('text', _SPACED, False)} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM hit),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.p) AS t, count(*) AS k FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
""",
    "op10_benchmark_decontamination": f"""
WITH w AS (SELECT doc_id, {words('text', _ALNUM, True)} AS ws FROM documents),
b AS (SELECT item_id, {words('text', _ALNUM, True)} AS ws FROM benchmark),
item AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM
  (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
win AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM
  (SELECT doc_id, ws, n, unnest(range(1, greatest(len(ws) - n + 2, 1))) AS i FROM w, (SELECT DISTINCT n FROM item))),
hit AS (SELECT doc_id, i, win.n AS n, item_id FROM win JOIN item ON win.g = item.g AND win.n = item.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN words ON words.doc_id = w.doc_id LEFT JOIN items ON items.doc_id = w.doc_id
""",
    "op12_ball_kmeans_codes": product_codes(),
}
