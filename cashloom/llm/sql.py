"""SQL twins of queries whose text needs parts of its own, such as CRC-32."""

from __future__ import annotations

_UPPER = "".join(map(chr, range(65, 91)))


OP11 = rf"""
WITH t AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i::BIGINT)) AS crc),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
lists AS (
  SELECT side, r, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts),
w AS (SELECT side, r, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM lists),
n AS (SELECT *, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY side, r ORDER BY i)),
features AS (
  SELECT side, r, w1 AS f FROM n UNION ALL SELECT side, r, w1 || ' ' || w2 FROM n WHERE w2 IS NOT NULL
  UNION ALL SELECT side, r, w1 || ' ' || w2 || ' ' || w3 FROM n WHERE w3 IS NOT NULL),
distinct_features AS (
  SELECT f, list_transform(range(1, 2 * octet_length(encode(f)), 2), lambda i: ('0x' || substr(hex(encode(f)), i, 2))::BIGINT) AS octets
  FROM (SELECT DISTINCT f FROM features)),
buckets AS (
  SELECT f, xor(list_reduce(octets, lambda c, b: xor(t.crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket
  FROM distinct_features, t),
placed AS (SELECT side, r, bucket FROM features JOIN buckets USING (f)),
counts AS (
  SELECT bucket, (count(*) FILTER (side = 'd'))::DOUBLE AS s, (count(*) FILTER (side = 'b'))::DOUBLE AS t FROM placed GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
  FROM counts, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts)),
weights AS (
  SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
  FROM texts JOIN lists USING (side, r) LEFT JOIN weights USING (r) WHERE side = 'd'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= 20 AND place <= 5 * (SELECT count(*) FROM scored WHERE n_words >= 20) // 100 THEN place END::BIGINT AS rank
FROM ranked"""

OP12 = r"""
WITH t AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, i::BIGINT)) AS crc),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
      lambda c, b: xor(t.crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM documents, t),
plan AS (
  SELECT *, len(words) AS n, CASE WHEN h % 10 = 0 AND len(words) > 0 THEN (h // 10) % len(words) END AS a FROM docs),
shape AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM plan),
original AS (SELECT r, generate_subscripts(words, 1) - 1 AS i, unnest(words) AS w FROM docs),
w AS MATERIALIZED (
  SELECT s.r, x.i, o.w
  FROM (SELECT r, a, p, unnest(range(n)) AS i FROM shape) AS x JOIN shape AS s USING (r)
  JOIN original AS o ON o.r = x.r AND o.i = CASE WHEN x.a IS NOT NULL AND x.i >= x.a THEN x.a + (x.i - x.a) % x.p ELSE x.i END),
lags AS (SELECT r, n, unnest(range(1, n // 4 + 1)) AS q FROM shape),
anchors AS MATERIALIZED (
  SELECT c.r, q, x, w FROM (SELECT r, q, unnest(range(0, n - q, q)) AS x FROM lags) AS c JOIN w ON w.r = c.r AND w.i = c.x),
later AS MATERIALIZED (SELECT c.r, q, x, c.w, w.w AS w2 FROM anchors AS c JOIN w ON w.r = c.r AND w.i = c.x + q),
hits AS MATERIALIZED (SELECT r, q, x FROM later WHERE w = w2),
candidates AS MATERIALIZED (
  SELECT DISTINCT a.r, a.q FROM hits AS a JOIN hits AS b ON b.r = a.r AND b.q = a.q AND b.x = a.x + a.q
  JOIN hits AS c ON c.r = a.r AND c.q = a.q AND c.x = a.x + 2 * a.q),
here AS MATERIALIZED (SELECT c.r, q, i, w FROM candidates AS c JOIN w USING (r)),
ahead AS MATERIALIZED (SELECT c.r, q, c.i, c.w, w.w AS w2 FROM here AS c JOIN w ON w.r = c.r AND w.i = c.i + q),
matches AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM ahead WHERE w = w2),
stretches AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length FROM matches GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
best AS (
  SELECT r, start, length, period FROM runs
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, start, period) = 1),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY r),
dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS collapsed FROM w ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
  (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)"""

ORACLES = {"op11_importance_resampling": OP11, "op12_periodic_runs": OP12}
