"""SQL twins of the text queries, where SQL can say the same."""

from __future__ import annotations

OP5 = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP9 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), marked AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
         max(page_id) OVER (PARTITION BY payload) AS keep_id
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep_id THEN keep_id END AS refers_to
FROM marked
"""

OP11 = r"""
WITH rows AS (
  SELECT row_number() OVER () AS id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), tokens AS (
  SELECT id, lang, source,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM rows
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM tokens GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), sizes AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM rows),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v) AS lang_p
  FROM totals JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN counts USING (lang, source, term)
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - lang_p FROM shares WHERE n > 0 AND p > lang_p
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM placed
WHERE part = 'pair' OR rank <= 50
"""

# The hash of the ids is CRC-32, spelled out bit by bit.
OP12 = """
WITH ids AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS written FROM conversations WHERE conv_id IS NOT NULL
), taken AS (
  SELECT conv_id, conv_id - conv_id % 5 AS first, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(length(written)), lambda i: ascii(substr(written, i + 1, 1))::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))
  )) % 9 AS h
  FROM ids
), keyed AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key, coalesce(strlen(text), 0) AS bytes
  FROM conversations
), turns AS (
  SELECT conv_id, key, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos FROM keyed
), rebuilt AS (
  SELECT taken.conv_id, pos, key, bytes FROM taken JOIN turns ON turns.conv_id = first AND pos <= h
  UNION ALL
  SELECT taken.conv_id, pos, key, bytes FROM taken JOIN turns ON turns.conv_id = taken.conv_id AND pos > h
), prefixes AS MATERIALIZED (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(key, '') OVER w AS prefix, bytes FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM ids
), nodes AS MATERIALIZED (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes, left(prefix, greatest(0, 32 * (depth - 1))) AS parent
  FROM prefixes GROUP BY prefix, depth
), children AS (
  SELECT parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent
), leaves AS (
  SELECT p.prefix, count(*) AS n FROM nodes u LEFT JOIN children ON children.parent = u.prefix JOIN prefixes p ON p.conv_id = u.conv_id
  WHERE children.n IS NULL AND p.depth <= u.depth GROUP BY p.prefix
), saved AS (
  SELECT p.prefix, sum((u.n_convs - 1) * u.bytes) AS n FROM nodes u JOIN prefixes p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.prefix
), lasts AS (
  SELECT conv_id, arg_max(prefix, depth) AS prefix FROM prefixes GROUP BY conv_id
), ends AS (
  SELECT prefix, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS hash FROM lasts GROUP BY prefix
)
SELECT nodes.conv_id, nodes.depth, above.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children, leaves.n AS n_leaves,
       CAST(saved.n AS BIGINT) AS saved_tokens, coalesce(ends.hash, sha256('')) AS ends_sha256
FROM nodes JOIN leaves USING (prefix) JOIN saved USING (prefix) LEFT JOIN children ON children.parent = nodes.prefix LEFT JOIN ends USING (prefix)
LEFT JOIN nodes above ON above.prefix = nodes.parent AND nodes.depth > 0
"""

SQL = {"op5_exact_dedup": OP5, "op9_warc": OP9, "op11_source_divergence": OP11, "op12_prefix_trie": OP12}
