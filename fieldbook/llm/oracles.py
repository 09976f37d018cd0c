"""DuckDB SQL for corpus queries that it can express on whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = r"'[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'"
_BLANKS = r"'[\x{20}\x{09}-\x{0D}]+'"


def _words(table: str, key: str, gap: str) -> str:
    return (
        f"SELECT {key}, list_filter(regexp_split_to_array({_LOWER}, {gap}), lambda x: x <> '') AS w "
        f"FROM {table}"
    )


BENCHMARK_OVERLAP = f"""
WITH b AS ({_words('benchmark', 'item_id', _LETTERS)}),
d AS ({_words('documents', 'doc_id', _LETTERS)}),
tests AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS size,
               unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
found AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM tests) WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, size, item_id FROM found JOIN tests USING (size, win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

SHINGLE_JOIN = f"""
WITH RECURSIVE d AS ({_words('documents', 'doc_id', _BLANKS)}),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared_counts AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared_counts JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(a, b) AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON r.b = e.a),
least_of AS (SELECT a AS doc_id, min(b) AS least_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
       least(doc_id, coalesce(least_id, doc_id))::BIGINT AS component_id
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)"""

# Bytes as pairs of hexadecimal digits; a window is a hundred of them.
REPEATED_BYTES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS win
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d WHERE length(h) >= 100)),
gone AS (
  SELECT doc_id, i FROM windows
  JOIN (SELECT win, min(doc_id) AS least_id FROM windows GROUP BY win) USING (win)
  WHERE least_id < doc_id),
marked AS (
  SELECT doc_id, i,
         CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens
  FROM gone),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (
  SELECT doc_id, span, min(i) AS first_byte, max(i) + 50 AS end_byte FROM numbered GROUP BY 1, 2),
gaps AS (
  SELECT doc_id, first_byte, end_byte,
         coalesce(lag(end_byte) OVER (PARTITION BY doc_id ORDER BY first_byte), 0) AS from_byte
  FROM spans),
pieces AS (
  SELECT doc_id, string_agg(substr(h, 2 * from_byte + 1, 2 * (first_byte - from_byte)), '' ORDER BY first_byte) AS kept,
         max(end_byte) AS last_byte, sum(end_byte - first_byte) AS n_removed, count(*) AS n_spans
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept || substr(h, 2 * last_byte + 1), h))) AS kept_sha256
FROM d LEFT JOIN pieces USING (doc_id)"""

RANKED_SEARCH = f"""
WITH d AS ({_words('documents', 'doc_id', _LETTERS)}),
q AS ({_words('benchmark', 'item_id', _LETTERS)}),
sizes AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(w) AS term FROM q) GROUP BY ALL),
found AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM found, sizes GROUP BY term),
scores AS (
  SELECT item_id, doc_id,
    sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN found USING (term), sizes GROUP BY item_id, doc_id),
ordered AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ordered WHERE rank <= 10"""

NEAREST_VECTORS = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS p FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.p, v.p)::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.p) = len(v.p) WHERE q.vec_id % 100 = 0),
ordered AS (
  SELECT query_id, vec_id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ordered WHERE rank <= 10"""

# The sum of polynomial division by the reversed CRC-32 polynomial, byte after byte.
_CRC32 = """xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)))"""

CONVERSATION_TRIE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, k, length(text)::BIGINT AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS place FROM turns),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS family, {_CRC32} % 6 AS h FROM (SELECT DISTINCT conv_id FROM own)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, o.place, o.k, o.size FROM convs c JOIN own o ON o.conv_id = c.family AND o.place <= c.h
  UNION ALL SELECT c.conv_id, 1, o.place, o.k, o.size FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.place > c.h),
prefixes AS (
  SELECT conv_id, size, row_number() OVER w AS depth, string_agg(k, '') OVER w AS p
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
members AS (
  SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS ended FROM prefixes),
nodes AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
    CASE WHEN depth > 0 THEN left(p, length(p) - 32) END AS parent,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '') AS ids
  FROM members GROUP BY p, depth),
children AS (SELECT parent AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (p)),
above AS (SELECT left(p, 32 * unnest(range(depth + 1))) AS p, saved, n_children = 0 AS leaf FROM counted),
sums AS (SELECT p, sum(saved) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves FROM above GROUP BY p)
SELECT c.conv_id, c.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, c.n_convs::BIGINT AS n_convs,
  c.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
  sha256(c.ids) AS ends_sha256
FROM counted c JOIN sums s USING (p) LEFT JOIN nodes up ON up.p = c.parent"""
