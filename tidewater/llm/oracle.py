"""Expected results of the operators that SQL can express, for DuckDB."""

from __future__ import annotations

_BLANK = r"[^\x20\x09-\x0D]"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_RULES = rf"""WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_BLANK}+') AS words FROM documents
),
grams AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d)
),
repeats AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM repeats CROSS JOIN (SELECT unnest(range(5)) AS k) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, host, text, line, len(regexp_extract_all(line, '{_BLANK}+')) AS n,
         regexp_replace(translate(trim(line, {_TRIM}), {_UPPER}), '[0-9]', '0', 'g') AS norm
  FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '{_BLANK}')
),
frequent AS (
  SELECT host, norm FROM lines WHERE n >= 3 GROUP BY host, norm HAVING count(DISTINCT text) > 10
),
by_document AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(frequent.norm) AS gone, coalesce(sum(CASE WHEN frequent.norm IS NOT NULL THEN n END), 0) AS gone_words
  FROM lines LEFT JOIN frequent USING (host, norm) GROUP BY doc_id
),
facts AS (
  SELECT doc_id, len(words) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         coalesce(gone, 0) AS n_removed_lines, CAST(coalesce(gone_words, 0) AS BIGINT) AS n_removed_words
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN by_document USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND n_words - n_removed_words >= 10 AND 2 * (n_words - n_removed_words) >= n_words AS kept
FROM facts"""

_ESCAPED = r"regexp_replace({}, '(<|\[)(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')"

CHAT_WINDOWS = rf"""WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
shown AS (
  SELECT *, '<s>[INST] ' || {_ESCAPED.format("role")} || ' [/INST] '
            || {_ESCAPED.format("text")} || '</s>' AS shown,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM given
),
counted AS (
  SELECT *, len(regexp_extract_all(shown, '\p{{L}}{{1,6}}|\p{{N}}{{1,3}}|[^\s\p{{L}}\p{{N}}]')) AS n,
         length(shown) AS size, pos = 0 AND role = 'system' AS leads FROM shown
),
summed AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY pos) AS till,
         coalesce(max(CASE WHEN leads THEN n END) OVER (PARTITION BY conv_id), 0) AS lead_n FROM counted
),
plain AS (
  SELECT conv_id, pos, n, size, lead_n, till - lead_n AS till,
         greatest(64, (1024 - 128 - lead_n) // 2) AS stride FROM summed WHERE NOT leads
),
blocked AS (
  SELECT *, (till - 1) // stride AS block,
         CASE WHEN n > stride THEN (till - 1) // stride END AS long_block FROM plain
),
placed AS (
  SELECT *, 2 * block + CASE WHEN max(long_block) OVER (
           PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
         ) = block THEN 1 ELSE 0 END AS win FROM blocked
),
starts AS (
  SELECT conv_id, win, min(pos) AS first, min(till - n) AS first_till, sum(n) + max(lead_n) AS used
  FROM placed GROUP BY conv_id, win
),
again AS (
  SELECT p.conv_id, sum(p.size) AS size FROM starts AS s
  JOIN placed AS p ON p.conv_id = s.conv_id AND p.pos IN (s.first - 1, s.first - 2)
  WHERE s.used + 128 <= 1024 AND s.first_till - (p.till - p.n) <= 128 GROUP BY p.conv_id
),
windows AS (SELECT conv_id, count(*) AS n FROM starts GROUP BY conv_id),
digests AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
         CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
         sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY pos), ''))
           AS loss_sha256,
         sum(CASE WHEN NOT leads THEN size ELSE 0 END) AS plain_size,
         sum(CASE WHEN leads THEN size ELSE 0 END) AS lead_size
  FROM summed GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
       CAST(plain_size + coalesce(again.size, 0) + lead_size * coalesce(windows.n, 1) AS BIGINT)
         AS formatted_chars
FROM digests LEFT JOIN again USING (conv_id) LEFT JOIN windows USING (conv_id)"""

REPEATED_PASSAGES = """WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
),
w AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM d)
),
firsts AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, p FROM w JOIN firsts USING (s) WHERE first < doc_id),
spans AS (
  SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM (
    SELECT doc_id, p, sum(is_new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM (
      SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50
                             THEN 0 ELSE 1 END AS is_new FROM gone))
  GROUP BY doc_id, span
),
gaps AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans
),
cut AS (
  SELECT d.doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head
  FROM gaps JOIN d USING (doc_id) GROUP BY d.doc_id
),
sums AS (
  SELECT doc_id, sum(b - a) AS removed, count(*) AS n, max(b) AS last FROM spans GROUP BY doc_id
)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       coalesce(n, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN cut USING (doc_id)"""

_FIELDS = " || ".join(
    f"coalesce(strlen({value}) || ':' || {value}, '-')"
    for value in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "{text}")
)

# The CRC-32 of doc_id's digits bit by bit: each byte is mixed in, then eight shifts (-1 is
# a shift alone).
MERKLE_MANIFEST = f"""WITH RECURSIVE given AS (
  SELECT *, list_reduce(
      list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, b: xor(xor(c, greatest(b, 0)) >> 1, 3988292384 * (xor(c, greatest(b, 0)) & 1))) AS state
  FROM documents
),
leaves AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
         sha256({_FIELDS.format(text="text")}) AS leaf,
         sha256({_FIELDS.format(text="CASE WHEN xor(state, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")}) AS now
  FROM given
),
tree AS (
  SELECT source, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY source) AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM tree WHERE n > 1 GROUP BY source, level, pos // 3
),
subroots AS (
  SELECT source, level AS height, node AS subroot,
         row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS place, count(*) OVER () AS n
  FROM tree WHERE n = 1
),
top AS (
  SELECT 0 AS level, place AS pos, subroot AS node, n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3
  FROM top WHERE n > 1 GROUP BY level, pos // 3
),
steps AS (
  SELECT source, level, pos, false AS above,
         coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM tree WHERE n > 1 WINDOW w AS (PARTITION BY source, level, pos // 3 ORDER BY pos)
  UNION ALL
  SELECT s.source, s.height + t.level, s.place // power(3, t.level)::BIGINT, true, t.before, t.after
  FROM subroots AS s JOIN (
    SELECT level, pos,
           coalesce(string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM top WHERE n > 1 WINDOW w AS (PARTITION BY level, pos // 3 ORDER BY pos)
  ) AS t ON t.pos = s.place // power(3, t.level)::BIGINT
),
path AS (
  SELECT l.doc_id, s.level, s.before, s.after
  FROM leaves AS l JOIN steps AS s
    ON s.source IS NOT DISTINCT FROM l.source
   AND (s.above OR s.pos = l.pos // power(3, s.level)::BIGINT)
),
folded AS (
  SELECT doc_id, 0 AS level, now AS node FROM leaves
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(p.before || f.node || p.after)
  FROM folded AS f JOIN path AS p ON p.doc_id = f.doc_id AND p.level = f.level
),
proofs AS (
  SELECT doc_id, string_agg(before || after, '' ORDER BY level) AS proof, count(*) AS height
  FROM path GROUP BY doc_id
)
SELECT l.doc_id, l.leaf, s.subroot, r.node AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
       f.node AS folded_root, f.node = r.node AS verified
FROM leaves AS l
JOIN subroots AS s ON s.source IS NOT DISTINCT FROM l.source
JOIN (SELECT node FROM top WHERE n = 1) AS r ON true
LEFT JOIN proofs AS p ON p.doc_id = l.doc_id
JOIN folded AS f ON f.doc_id = l.doc_id AND f.level = coalesce(p.height, 0)"""


# Integers as doubles: their products and sums here are far below 2^53.
_VECTORS = """
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

TOP_K = f"""WITH vectors AS ({_VECTORS.format(scale=1024)}
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vectors AS q JOIN vectors AS c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM numbered WHERE rank <= 10"""

HARD_NEGATIVES = f"""WITH vectors AS ({_VECTORS.format(scale=256)} AND label IS NOT NULL
),
labelled AS (
  SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM vectors
),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_dot_product(a.v, c.v)::BIGINT AS score
  FROM labelled AS a JOIN labelled AS c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
negatives AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 10"""
