"""What the queries return, as SQL over the same tables."""

from __future__ import annotations

from leadmill.llm.chat import BEGIN, END
from leadmill.llm.placement import SHARDS, Tree, plain_tree, weight

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CASE WHEN embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS e
  FROM embeddings
), link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS x, vec_id AS y FROM v
  UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), n AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT v.vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.y) AS component_id, v.vec_id = min(r.y) AS kept
FROM v JOIN reach r ON r.x = v.vec_id LEFT JOIN n ON n.x = v.vec_id GROUP BY v.vec_id
"""

OP5 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS k
  FROM (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 99, 0))) AS p FROM d)
), again AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM w) WHERE nth > 1
), runs AS (
  SELECT doc_id, p, sum(CASE WHEN p - before <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM again)
), spans AS (
  SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM runs GROUP BY doc_id, run
), cuts AS (
  SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS past FROM spans
), gone AS (
  SELECT d.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * past + 1, 2 * (a - past)), '' ORDER BY a) || any_value(substr(h, 2 * past_all + 1)) AS kept
  FROM d JOIN cuts USING (doc_id) JOIN (SELECT doc_id, max(b) AS past_all FROM spans GROUP BY doc_id) USING (doc_id)
  GROUP BY d.doc_id
)
SELECT d.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""

OP6 = f"""
WITH own AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 AS odd, turn, role, text FROM conversations
), turns AS (
  SELECT pair_id, turn, role, text, bool_or(odd = 0) AS a, bool_or(odd = 1) AS b FROM own GROUP BY ALL
), apart AS (
  SELECT pair_id, min(turn) AS split FROM turns WHERE NOT (a AND b) GROUP BY pair_id
), parts AS (
  SELECT t.*, s.split IS NULL OR t.turn < s.split AS shared FROM turns t LEFT JOIN apart s USING (pair_id)
), named AS (
  SELECT pair_id, 'prompt' AS part, turn, role, text FROM parts WHERE shared
  UNION ALL SELECT pair_id, 'chosen', turn, role, text FROM parts WHERE NOT shared AND a
  UNION ALL SELECT pair_id, 'rejected', turn, role, text FROM parts WHERE NOT shared AND b
), shown AS (
  SELECT *, '{BEGIN}' || role || chr(10) || text || '{END}' || chr(10) AS rendered FROM named
)
SELECT pair_id, part, turn, role, CAST(part <> 'prompt' AND role = 'assistant' AS INT) AS loss,
  length(rendered) AS n_chars, md5(rendered) AS rendered_md5 FROM shown
"""


def _shard(tree: Tree, path: str = "") -> str:
    """The descent of a key through a tree of shards."""

    def draw(name: str, of: float) -> str:
        bits = f"CAST(('0x' || substr(md5('{path}/{name}|' || key), 1, 13)) AS BIGINT)"
        return f"{{'draw': ln(({bits} + 1) / 4503599627370496.0) / {of!r}, 'name': '{name}'}}"

    children = sorted(tree.items())
    best = f"list_max([{', '.join(draw(name, float(weight(child))) for name, child in children)}])['name']"
    if all(isinstance(child, (int, float)) for _, child in children):
        return f"CAST({best} AS INT)"
    whens = " ".join(f"WHEN '{name}' THEN {_shard(child, f'{path}/{name}')}" for name, child in children)
    return f"CASE {best} {whens} END"


OP9 = f"""
WITH steps AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), n)) AS t
), own AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key, coalesce(text, '') AS text FROM documents
), sized AS (
  SELECT doc_id, key, octet_length(encode(text)) + 1 AS size, hex(encode(text)) AS h FROM own
), summed AS (
  SELECT doc_id, key, size, xor(4294967295, list_reduce(
    list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS text_crc32
  FROM sized, steps
), placed AS (
  SELECT *, {_shard(plain_tree())} AS shard, {_shard(plain_tree(SHARDS + 1))} AS grown_shard FROM summed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(key), doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM placed
"""

OP13 = """
WITH steps AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), n)) AS t
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), sized AS (
  SELECT conv_id, max(p) AS own, conv_id - conv_id % 5 AS donor, hex(encode(CAST(conv_id AS VARCHAR))) AS x FROM turns GROUP BY conv_id
), convs AS (
  SELECT conv_id, own, donor, xor(4294967295, list_reduce(
    list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) % 9 AS h
  FROM sized, steps
), built AS (
  SELECT c.conv_id, t.p AS pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.donor AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(d.own, 0)) + t.p - c.h, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h LEFT JOIN sized d ON d.conv_id = c.donor
), keyed AS (
  SELECT conv_id, pos, octet_length(encode(text)) AS bytes,
    md5(string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY pos)) AS key
  FROM built
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), linked AS (
  SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY pos) AS up, lead(key) OVER (PARTITION BY conv_id ORDER BY pos) IS NULL AS last FROM keyed
), nodes AS (
  SELECT key, pos, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n, max(bytes) AS bytes,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '') AS ends
  FROM linked GROUP BY key, pos
), kids AS (
  SELECT up AS key, count(*) AS n_children FROM nodes WHERE pos > 0 GROUP BY up
), below AS (
  SELECT DISTINCT a.key, b.key AS other FROM keyed a JOIN keyed b ON a.conv_id = b.conv_id AND b.pos >= a.pos
), sums AS (
  SELECT b.key, count(*) FILTER (WHERE k.key IS NULL) AS n_leaves, sum((n.n - 1) * n.bytes) AS saved
  FROM below b JOIN nodes n ON n.key = b.other LEFT JOIN kids k ON k.key = b.other GROUP BY b.key
)
SELECT n.conv_id, n.pos AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.n_children, 0) AS n_children,
  s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums s USING (key) LEFT JOIN kids k USING (key) LEFT JOIN nodes p ON p.key = n.up
"""

_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
OP12 = f"""
WITH d AS (
  SELECT doc_id, unnest({_TERMS}) AS term FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term
), n AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id
), al AS (
  SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM n
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, al GROUP BY term
), q AS (
  SELECT item_id, term, count(*) AS k FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
), s AS (
  SELECT q.item_id, tf.doc_id, CAST(sum(q.k * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * n.n * al.big_n) // al.big_l)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN n USING (doc_id), al GROUP BY q.item_id, tf.doc_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 10
"""
