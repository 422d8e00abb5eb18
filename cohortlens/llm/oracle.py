"""DuckDB SQL of the registered queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op1_host_quality"] = r"""
WITH words AS (
  SELECT doc_id, source,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         coalesce(text, '') AS text
  FROM documents
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY doc_id
), grams AS (
  SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM words)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, unnest(range(0, 5)) AS k FROM repeated) GROUP BY doc_id
), base AS (
  SELECT words.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM base
), hosts AS (
  SELECT source, count(*) AS n, sum(CAST(base_failed AS INTEGER)) AS f FROM judged GROUP BY source
), total AS (
  SELECT sum(n) AS n, sum(f) / sum(n) AS m, count(*) AS h FROM hosts
), spread AS (
  SELECT greatest(0, (sum(hosts.n * (f / hosts.n - m) ** 2) - any_value(m * (1 - m) * h)) / any_value(total.n)) AS v,
         any_value(m) AS m
  FROM hosts, total
), prior AS (
  SELECT m, CASE WHEN v > 0 THEN least(1e6, greatest(1.0, m * (1 - m) / v - 1)) ELSE 1e6 END AS s FROM spread
), rates AS (
  SELECT source, (f + s * m) / (n + s) AS rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND rate <= 0.5) AS kept
FROM judged JOIN rates ON judged.source IS NOT DISTINCT FROM rates.source
"""

ORACLE["op2_voronoi"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""

ORACLE["op4_warc"] = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

ORACLE["op5_replytrees"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(len('<|im_start|>') + len(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + 1
                + len(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + len('<|im_end|>') + 1) AS BIGINT)
         AS formatted_chars
FROM t GROUP BY conv_id
"""

ORACLE["op11_divergence"] = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
           lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w,
         row_number() OVER () AS row
  FROM documents
), t AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT row) AS docs
  FROM (SELECT lang, source, row, unnest(w) AS term FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, term, sum(n) AS total FROM t GROUP BY ALL HAVING sum(docs) >= 30
), langs AS (
  SELECT lang, count(term) AS v, CAST(coalesce(sum(total), 0) AS HUGEINT) AS n_lang
  FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang
), groups AS (
  SELECT g.lang, g.source, v, n_lang, CAST(coalesce(sum(t.n) FILTER (kept.term IS NOT NULL), 0) AS HUGEINT) AS n_source
  FROM (SELECT DISTINCT lang, source FROM d) g JOIN langs USING (lang)
       LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
       LEFT JOIN kept ON kept.lang = t.lang AND kept.term = t.term
  GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(t.n, 0) AS n,
         CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(t.n, 0) + 5)) // (n_source + 5 * v) AS BIGINT) AS p,
         CAST(1 + (CAST(1000000000 AS HUGEINT) * (total + 5)) // (n_lang + 5 * v) AS BIGINT) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang
       LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
       LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
), own AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own))
WHERE part = 'pair' OR rank <= 50
"""

#: parts, entries and rounds of ``veccodes``
_PARTS, _ENTRIES, _ROUNDS = 8, 16, 6


def _nearest(round_: int) -> str:
    return f"""near{round_} AS MATERIALIZED (
  SELECT row, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS best
  FROM (SELECT row, parts.p, x, e,
               CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM parts JOIN books{round_} b ON b.p = parts.p)
  GROUP BY row, p
)"""


def _refined(round_: int) -> str:
    return f"""sums{round_} AS (
  SELECT p, e, j, sum(x[j]) AS s, count(*) AS n
  FROM (SELECT p, best.e AS e, x, unnest(range(1, len(x) + 1)) AS j FROM near{round_}) GROUP BY p, e, j
), means{round_} AS (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM sums{round_} GROUP BY p, e
), books{round_ + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM books{round_} b LEFT JOIN means{round_} m ON m.p = b.p AND m.e = b.e
)"""


ORACLE["op12_veccodes"] = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding, label) AS row,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT row, p, v[p * (len(v) // {_PARTS}) + 1:(p + 1) * (len(v) // {_PARTS})] AS x
  FROM (SELECT row, v, unnest(range({_PARTS})) AS p FROM v)
), books0 AS MATERIALIZED (
  SELECT p, e, x AS c FROM parts
  JOIN (SELECT row, row_number() OVER (ORDER BY vec_id, row) - 1 AS e FROM v WHERE vec_id IS NOT NULL) USING (row)
  WHERE e < {_ENTRIES}
), {", ".join(f"{_nearest(r)}, {_refined(r)}" for r in range(_ROUNDS))}, {_nearest(_ROUNDS)},
digest AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS j FROM books{_ROUNDS})
), coded AS (
  SELECT row, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{_ROUNDS} GROUP BY row
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (row) CROSS JOIN digest
"""
