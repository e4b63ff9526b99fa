"""DuckDB statements for the queries that SQL can express; columns are named as in the queries.

The others learn a model, or need edit distances, encrypted values or 64-bit shingle hashes;
``tests/llm`` holds them against brute force.
"""

from __future__ import annotations

ORACLES = {
    "op2_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    length(regexp_replace(text, '\\', '\\\\', 'g'))
      + len(regexp_extract_all(text, '</?s>|</?SYS>|\[/?INST\]|\[/?ROLE\]|\[TEXT\]'))
      + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
             ELSE 19 + length(role) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
                WHEN before IN ('system', 'assistant') THEN role = 'user'
                WHEN before = 'user' THEN role = 'assistant' ELSE false END) AS in_order
FROM marked GROUP BY conv_id
""",
    "op5_warc": r"""
WITH sized AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY sha1(payload), octet_length(payload)) AS first_id,
    upper(sha1(payload)) AS hex
  FROM sized
), bits AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, first_id,
    list_transform(range(32), lambda k: CAST(
      CAST(('0x' || substr(hex, CAST(k * 5 // 4 + 1 AS BIGINT), 1)) AS INTEGER) * 16
      + CAST(('0x' || coalesce(nullif(substr(hex, CAST(k * 5 // 4 + 2 AS BIGINT), 1), ''), '0')) AS INTEGER)
      AS INTEGER) // CAST(power(2, 3 - (k * 5) % 4) AS INTEGER) % 32) AS fives
  FROM firsts
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(fives, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v + 1 AS BIGINT), 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM bits
""",
    "op7_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, md5(concat('mix:7:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS k,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS place
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS cap
  FROM sources
), levels AS (
  SELECT *, row_number() OVER o AS step,
    (1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT)
      - CAST(coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
      / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM weighed WINDOW o AS (ORDER BY cap::DOUBLE / weight, place)
), targets AS (
  SELECT source, source_size,
    coalesce(least(cap::DOUBLE, weight * (SELECT arg_min(level, step) FROM levels
      WHERE level <= cap::DOUBLE / weight)), cap::DOUBLE) AS target
  FROM levels
), budgets AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS budget,
    CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM targets
)
SELECT d.doc_id, d.size, b.source_size, b.target,
  CAST(b.epochs * d.size + greatest(0, least(d.size, b.budget - b.epochs * b.source_size
    - (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size ROWS UNBOUNDED PRECEDING) - d.size)))
    AS BIGINT) AS taken
FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
""",
    "op8_substring_dedup": r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS listed FROM documents
), placed AS (
  SELECT doc_id, len(listed) AS n, unnest(listed) AS word, generate_subscripts(listed, 1) AS place FROM texts
), windows AS (
  SELECT *, string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS said
  FROM placed
), judged AS (
  SELECT doc_id, place, word,
    place <= n - 19 AND row_number() OVER (PARTITION BY said ORDER BY doc_id, place) > 1 AS again
  FROM windows
), covered AS (
  SELECT doc_id, place, word, bool_or(again) OVER (
    PARTITION BY doc_id ORDER BY place ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM judged
)
SELECT t.doc_id, count(word) AS n_words, count(*) FILTER (gone) AS n_removed,
  sha256(coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM texts t LEFT JOIN covered c ON t.doc_id = c.doc_id GROUP BY t.doc_id
""",
    "op11_fill_in_middle": r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents
), numbers AS (
  SELECT doc_id, text, units, len(units) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM drawn
), cut AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(units[1 : least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
    array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1 : greatest(h1 % (n + 1), h2 % (n + 1))], '')
      AS middle,
    array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1 :], '') AS suffix
  FROM numbers
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
""",
    "op12_hard_negatives": """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
""",
}
