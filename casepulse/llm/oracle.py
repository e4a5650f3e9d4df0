"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WORDS = "regexp_extract_all(lower_ascii, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

def _assigned(k: int) -> str:
    return f"""
gaps{k} AS (
  SELECT vec_id, place, v, n, c, (list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c))::BIGINT AS d
  FROM held, centroids{k}),
assigned{k} AS MATERIALIZED (SELECT * FROM gaps{k} QUALIFY row_number() OVER (PARTITION BY place ORDER BY d, n) = 1)"""


def _moved(k: int) -> str:
    return f"""
means{k} AS (
  SELECT n, list(((s - ((s % m) + m) % m) // m)::DOUBLE ORDER BY i) AS c
  FROM (SELECT n, i, SUM(v[i])::BIGINT AS s, COUNT(*) AS m
        FROM (SELECT n, v, unnest(range(1, 65)) AS i FROM assigned{k - 1}) GROUP BY n, i) GROUP BY n),
centroids{k} AS MATERIALIZED (SELECT o.n, coalesce(m.c, o.c) AS c FROM centroids{k - 1} o LEFT JOIN means{k} m USING (n))"""


ORACLE: dict[str, str] = {
    "op10_decontamination": f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w
  FROM (SELECT doc_id, {_LOWER} AS lower_ascii FROM documents)),
items AS (
  SELECT item_id, {_WORDS} AS w FROM (SELECT item_id, {_LOWER} AS lower_ascii FROM benchmark)),
item_windows AS (
  SELECT item_id, len(w[i:i + least(len(w), 13) - 1]) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0)),
doc_windows AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
hits AS (SELECT d.rid, d.i, d.n, b.item_id FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.words = b.words),
hit_words AS (
  SELECT rid, COUNT(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS place FROM hits) GROUP BY rid),
hit_items AS (
  SELECT rid, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)""",
    "op11_resampling": f"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, 0 AS target, doc_id, {_WORDS} AS w
  FROM (SELECT doc_id, {_LOWER} AS lower_ascii FROM documents)
  UNION ALL
  SELECT row_number() OVER (), 1, NULL, {_WORDS}
  FROM (SELECT {_LOWER} AS lower_ascii FROM benchmark)),
runs AS (
  SELECT rid, target, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT rid, target, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n)),
counted AS MATERIALIZED (SELECT rid, target, run, COUNT(*) AS k FROM runs GROUP BY ALL),
table_of AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
    FROM (SELECT unnest(range(256)) AS b))),
hexed AS (SELECT run, hex(encode(run)) AS h FROM (SELECT DISTINCT run FROM counted)),
hashed AS MATERIALIZED (
  SELECT run, xor(list_reduce(list_transform(range(1, len(h), 2), lambda p: 16 * (instr('0123456789ABCDEF', h[p]) - 1) + instr('0123456789ABCDEF', h[p + 1]) - 1),
                          lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM hexed, table_of),
of_bucket AS (
  SELECT bucket, coalesce(SUM(k) FILTER (target = 0), 0)::DOUBLE AS s, coalesce(SUM(k) FILTER (target = 1), 0)::DOUBLE AS t
  FROM counted JOIN hashed USING (run) GROUP BY bucket),
gain_of AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (SUM(s) OVER () + 10000) / ((s + 1) * (SUM(t) OVER () + 10000)))) AS gain FROM of_bucket),
weighed AS (
  SELECT rid, SUM(k)::BIGINT AS n_features, SUM(k * gain)::BIGINT AS weight
  FROM counted JOIN hashed USING (run) JOIN gain_of USING (bucket) WHERE target = 0 GROUP BY rid),
scored AS (
  SELECT rid, doc_id, len(w) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM texts LEFT JOIN weighed USING (rid) WHERE target = 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, COUNT(*) OVER (PARTITION BY able) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * n // 100 THEN place END AS rank FROM placed""",
    "op12_topk": """
WITH held AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM held q JOIN held c ON q.place <> c.place AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 10""",
    "op13_centroids": f"""
WITH held AS MATERIALIZED (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
centroids0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS n, v AS c FROM held ORDER BY sha256('1:' || vec_id), v LIMIT 16),
{_assigned(0)},{_moved(1)},{_assigned(1)},{_moved(2)},{_assigned(2)},{_moved(3)},{_assigned(3)}
SELECT vec_id, n::INTEGER AS cluster, d AS distance, (SUM(d) OVER (PARTITION BY n))::BIGINT AS cluster_inertia, (SUM(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM assigned3""",
}
