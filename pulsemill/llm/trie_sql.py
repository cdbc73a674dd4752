"""SQL twin of the conversation trie."""

from __future__ import annotations

_CRC32 = """xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c.conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
  lambda a, x: list_reduce(list_concat([xor(a, x)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                           lambda b, y: xor(b >> 1, 3988292384::BIGINT * (b & 1)))))"""

OP13_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, max(place) AS n, conv_id - conv_id % 5 AS base FROM t GROUP BY conv_id
), h AS (
  SELECT c.conv_id, c.base, {_CRC32} % 9 AS h, coalesce(b.n, 0) AS base_n
  FROM c LEFT JOIN c b ON b.conv_id = c.base
), turns AS (
  SELECT h.conv_id, place AS depth, role, text FROM h JOIN t ON t.conv_id = h.base AND place <= h
  UNION ALL
  SELECT h.conv_id, least(h, base_n) + place - h, role, text FROM h JOIN t ON t.conv_id = h.conv_id AND place > h
), p AS (
  SELECT conv_id, depth, octet_length(encode(text)) AS bytes,
         string_agg(md5(role || chr(0) || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), n AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(bytes) AS saves
  FROM p GROUP BY path
), k AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT a.path, sum(n.saves) AS saved_tokens, count_if(k.n_children IS NULL) AS n_leaves
  FROM n LEFT JOIN k ON k.path = n.path JOIN p a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.path
), ends AS (
  SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(path, depth) AS path FROM p GROUP BY conv_id) GROUP BY path
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs,
       CAST(coalesce(k.n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM n LEFT JOIN n up ON n.depth > 0 AND up.path = left(n.path, length(n.path) - 32)
LEFT JOIN k ON k.path = n.path JOIN below ON below.path = n.path LEFT JOIN ends ON ends.path = n.path
"""
