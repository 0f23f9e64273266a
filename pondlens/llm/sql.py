"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

HOST_QUALITY = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT rid, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS p FROM docs WHERE len(w) >= 3)),
again AS (SELECT rid, p FROM windows QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) >= 2),
repeated AS (
  SELECT rid, count(DISTINCT q) AS n
  FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM again) GROUP BY rid),
m AS (
  SELECT doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(repeated.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN repeated USING (rid)),
ruled AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         base_failed OR n_symbols > n_words * 1.0 OR n_dup_lines > n_lines * 0.7 AS failed
  FROM m),
hosts AS (
  SELECT source AS h, count(*)::DOUBLE AS docs, count(*) FILTER (WHERE failed)::DOUBLE AS fails
  FROM ruled GROUP BY source),
sums AS (
  SELECT avg(fails / docs) AS mean_all, count(*) FILTER (WHERE docs > 1) AS k,
         avg(fails / docs) FILTER (WHERE docs > 1) AS mean_two, var_samp(fails / docs) FILTER (WHERE docs > 1) AS spread,
         avg(CASE WHEN docs > 1 THEN fails / docs * (1 - fails / docs) / (docs - 1) END) AS chance FROM hosts),
prior AS (
  SELECT coalesce(mean_two, mean_all) AS mean,
         CASE WHEN k > 1 AND spread > chance
              THEN least(20.0, greatest(1.0, mean_two * (1 - mean_two) / (spread - chance) - 1)) ELSE 20.0 END::DOUBLE AS strength
  FROM sums),
rated AS (SELECT h, (fails + mean * strength) / (docs + strength) AS rate FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR rate > 0.8) AS kept, round(rate, 9) AS host_rate
FROM ruled JOIN rated ON source IS NOT DISTINCT FROM h
"""

#: Exact containment of every item in every document.
CONTAMINATION = r"""
WITH lowered AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
words AS (
  SELECT DISTINCT side, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM lowered),
kinds AS (SELECT DISTINCT least(5, len(w)) AS k FROM words WHERE side = 'i' AND len(w) > 0),
shingles AS (
  SELECT DISTINCT side, id, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM (SELECT side, id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p
        FROM words JOIN kinds ON len(w) >= k AND (side = 'd' OR k = least(5, len(w))))),
sizes AS (SELECT id, count(*) AS n_item FROM shingles WHERE side = 'i' GROUP BY id),
shared AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
  FROM shingles d JOIN shingles i ON d.side = 'd' AND i.side = 'i' AND d.s = i.s GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM shared JOIN sizes ON item_id = sizes.id
WHERE n_shared >= 0.75 * n_item
"""

#: All links by an exact self-join on shingles, components by reachability.
NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS p FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach AS (
  SELECT a AS doc_id, a AS other FROM links
  UNION SELECT doc_id, b FROM reach JOIN links ON other = a),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       coalesce(component_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""

IMPORTANCE = r"""
WITH nibbles AS (
  SELECT list_transform(generate_series(0, 15), lambda i: list_reduce(generate_series(1, 4),
           lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
words AS (
  SELECT 'd' AS part, row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), NULL,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
spots AS (SELECT part, rid, unnest(generate_series(1, len(w))) AS p, w FROM words),
runs AS (
  SELECT part, rid, w[p] AS f FROM spots
  UNION ALL SELECT part, rid, w[p] || ' ' || w[p + 1] FROM spots WHERE p < len(w)
  UNION ALL SELECT part, rid, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] FROM spots WHERE p + 1 < len(w)),
each AS (SELECT part, rid, f, count(*) AS n FROM runs GROUP BY ALL),
names AS (SELECT f, lower(hex(encode(f))) AS x FROM (SELECT DISTINCT f FROM each)),
coded AS (
  SELECT f, xor(list_reduce(list_transform(generate_series(1, length(x)),
                  lambda k: ascii(x[k + CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END])),
                lambda c, h: xor(c >> 4, t[(xor(c % 16, CASE WHEN h > 57 THEN h - 87 ELSE h - 48 END) + 1)::BIGINT]),
                4294967295), 4294967295) % 10000 AS bucket
  FROM names, nibbles),
counted AS (
  SELECT bucket, sum(n) FILTER (WHERE part = 'd') AS s, sum(n) FILTER (WHERE part = 'b') AS t
  FROM each JOIN coded USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counted),
gained AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + 10000)
                                 / ((coalesce(s, 0)::DOUBLE + 1) * (t_all + 10000))))::BIGINT AS gain
  FROM counted, totals),
weights AS (
  SELECT rid, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM each JOIN coded USING (f) JOIN gained USING (bucket) WHERE part = 'd' GROUP BY rid),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (rid) WHERE part = 'd'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) FILTER (WHERE n_words >= 20) OVER () AS ready
  FROM scored)
SELECT doc_id, n_words, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * ready // 100 THEN place END AS rank
FROM placed
"""
