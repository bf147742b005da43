"""SQL twins of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

#: The table of the reflected CRC-32, one entry per byte.
CRC = """
crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
)"""


def crc(octets: str) -> str:
    """The CRC-32 of a list of bytes, where ``t`` is the table."""
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


OP11 = f"""
WITH RECURSIVE {CRC},
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS octets
  FROM conversations
),
marked AS (SELECT conv_id, turn, role, text, {crc('octets')} % 20 AS kind FROM keyed, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM hurt
),
judged AS (
  SELECT conv_id, turn, role, text, n,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1 WHEN nth > 1 THEN 2
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 3 ELSE 0 END AS fault,
         substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM placed
),
moves(state, initial, led) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
path AS (
  SELECT conv_id, 0::BIGINT AS n, 0 AS state, {{'cost': 0::BIGINT, 'audit': ''}} AS best FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, n, state, min(best) FROM (
    SELECT p.conv_id, p.n + 1 AS n, e.led AS state, {{'cost': p.best.cost + e.cost, 'audit': p.best.audit || e.letter}} AS best
    FROM path p JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.n = p.n + 1,
    LATERAL (
      SELECT 'D' AS letter, 2 AS cost, p.state AS led
      UNION ALL SELECT 'K', CASE WHEN j.fault = 3 THEN 5 ELSE 0 END, m.led FROM moves m WHERE m.state = p.state AND m.initial = j.initial AND j.fault NOT IN (1, 2)
      UNION ALL SELECT 'R', CASE WHEN j.fault = 3 THEN 6 ELSE 1 END, m.led FROM moves m WHERE m.state = p.state AND m.initial <> 's' AND j.fault NOT IN (1, 2)
    ) e
  ) GROUP BY ALL
),
facts AS (
  SELECT c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, coalesce(max(n), 0) AS n_rows
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id
),
chosen AS (
  SELECT f.*, min(p.best) AS best FROM facts f JOIN path p ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.n = f.n_rows AND p.state IN (0, 3) GROUP BY ALL
),
kept AS (
  SELECT c.conv_id, j.n, j.role, j.text, c.best.audit[j.n] AS letter, row_number() OVER (PARTITION BY c.conv_id ORDER BY j.n) AS spot,
         max(CASE WHEN c.best.audit[j.n] = 'K' AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id) AS shifted
  FROM chosen c JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id WHERE c.best.audit[j.n] <> 'D'
),
texts AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (spot - shifted) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY n)) AS sha
  FROM kept GROUP BY conv_id
)
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, c.best.cost AS cost, c.best.audit AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM chosen c LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
"""

OP13 = f"""
WITH {CRC},
texts AS (SELECT 0 AS target, row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
          UNION ALL SELECT 1, -row_number() OVER (), NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
words AS MATERIALIZED (SELECT target, r, doc_id, list_filter(regexp_split_to_array(text, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM texts),
grams AS MATERIALIZED (
  SELECT target, r, gram, count(*) AS n FROM (
    SELECT target, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                                         list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS gram FROM words
  ) GROUP BY ALL
),
octets AS (SELECT gram, hex(encode(gram)) AS h FROM (SELECT DISTINCT gram FROM grams)),
hashed AS MATERIALIZED (
  SELECT gram, {crc("list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)")} % 10000 AS bucket FROM octets, crc_table
),
counted AS (SELECT bucket, sum(n) FILTER (target = 0) AS s, sum(n) FILTER (target = 1) AS t FROM grams JOIN hashed USING (gram) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM counted),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + 10000) / ((coalesce(s, 0)::DOUBLE + 1) * (all_t + 10000))))::BIGINT AS gain FROM counted, totals),
weights AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM grams JOIN hashed USING (gram) JOIN gains USING (bucket) WHERE target = 0 GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weights USING (r) WHERE target = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= n * 5 // 100 THEN place END AS rank, n_words::BIGINT AS n_words FROM ranked
"""

WORDS = "list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

OP5 = f"""
WITH words AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS key FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words)),
again AS (SELECT r, i FROM windows QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, r, i) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 20)) AS at_word FROM again),
kept AS (
  SELECT r, sha256(string_agg(word, ' ' ORDER BY at_word)) AS digest FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at_word FROM words)
  ANTI JOIN gone USING (r, at_word) GROUP BY r
),
removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, coalesce(digest, sha256('')) AS kept_sha256
FROM words LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
"""

OP6 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents
),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words
),
items AS MATERIALIZED (SELECT doc_id, len(s) AS n, md5_number(unnest(s)) AS x FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
reached AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) USING (doc_id)
"""

OP10 = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
latest AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM payloads)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, 5 * (k // 4) + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM latest
"""

#: The queries left out fit models, search approximately or call a tokenizer; tests hold them against brute force or held-out rows.
SQL = {"op5_substrings": OP5, "op6_jaccard": OP6, "op10_warc": OP10, "op11_conversations": OP11, "op13_resampling": OP13}
