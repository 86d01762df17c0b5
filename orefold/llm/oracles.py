"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from orefold.llm import rules

_STOPS = ", ".join(f"'{word}', '{word.capitalize()}'" for word in rules.STOP_WORDS)

OP9 = rf"""
WITH parts AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), windows AS (
  SELECT doc_id, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS window3
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM parts)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, window3) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM repeated) GROUP BY doc_id
), counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({_STOPS})))::BIGINT AS n_stop_words,
         len(ls)::BIGINT AS n_lines
  FROM parts LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
), named AS (
  SELECT *, CASE WHEN base_failed THEN 'base'
                 WHEN 100 * word_chars > 1500 * n_words THEN 'long_words'
                 WHEN 100 * word_chars < 250 * n_words THEN 'short_words'
                 WHEN 100 * n_symbols > 20 * n_words THEN 'symbols'
                 WHEN 100 * n_stop_words < 5 * n_words THEN 'stop_words'
                 WHEN 100 * n_dup_lines > 50 * n_lines THEN 'dup_lines' END AS failed_rule
  FROM judged
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_lines, base_failed, failed_rule,
       failed_rule IS NULL AS kept
FROM named
"""

# The digest is spelled in base32 from its bits: 160 bits are 32 groups of five.
OP8 = """
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), spelled AS (
  SELECT page_id, payload_bytes, hex,
         list_reduce(list_transform(range(0, 32), lambda g:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             (list_sum(list_transform(range(0, 5), lambda k:
                (('0x' || substr(hex, (5 * g + k) // 4 + 1, 1))::INTEGER >> (3 - (5 * g + k) % 4) & 1) * (16 >> k)))
             + 1)::INTEGER, 1)), lambda a, b: a || b) AS payload_digest,
         min(page_id) OVER (PARTITION BY hex) AS response_id
  FROM digests
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = response_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response_id THEN NULL ELSE response_id END AS refers_to
FROM spelled
"""

OP11 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM lines
), common AS (
  SELECT line_key FROM keyed WHERE line_key <> '' GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT *, line_key IN (SELECT line_key FROM common) AS gone FROM keyed
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# crc32 is a fold over the characters of the decimal conv_id: eight shifts of the polynomial per character.
OP13 = r"""
WITH told AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), lengths AS (
  SELECT conv_id, turns,
         xor(list_reduce(
           list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
           lambda crc, byte: list_reduce(
             range(8), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(crc, byte)),
           4294967295), 4294967295) % 6 AS h
  FROM told
), paths AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS path
  FROM lengths a LEFT JOIN told b ON b.conv_id = a.conv_id - a.conv_id % 100
), begun AS (
  SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM paths
), nodes AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
  FROM begun GROUP BY path[1:depth], depth
), children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), valued AS (
  SELECT node, depth, coalesce(n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(node[depth].t) END AS saved
  FROM nodes LEFT JOIN children USING (node)
), subtrees AS (
  SELECT node[1:above] AS node, count_if(n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS above FROM valued) GROUP BY node[1:above]
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, v.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN valued v USING (node) JOIN subtrees s USING (node)
LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1]
"""
