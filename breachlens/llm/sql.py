"""DuckDB SQL of the queries that SQL can express."""

_QUALITY = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
often AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM often CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_text_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
measured AS (
  SELECT t.doc_id, len(w.w)::BIGINT AS n_words,
    length(regexp_replace(t.text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t.text) - length(regexp_replace(t.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(l.n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(p.n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(l.n_text_lines, 0)::BIGINT AS n_text_lines,
    (length(t.text) - length(regexp_replace(t.text, '[A-Za-z]|[^\x00-\x7F]', '', 'g')))::BIGINT AS n_letters,
    (length(t.text) - length(regexp_replace(t.text, '[A-Z]', '', 'g')))::BIGINT AS n_upper
  FROM texts t JOIN words w USING (r) LEFT JOIN lines l USING (r) LEFT JOIN repeats p USING (r)),
judged AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN n_text_lines >= 4 AND 2 * n_dup_lines > n_text_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN 2 * n_letters < word_chars THEN 64 ELSE 0 END)
    + (CASE WHEN n_letters > 0 AND 10 * n_upper > 7 * n_letters THEN 128 ELSE 0 END) AS failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed::BIGINT AS failed
FROM judged
"""

_DECONTAMINATION = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id::VARCHAR AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM lowered CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item FROM places JOIN windows USING (n, win)),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM lowered LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

_LINE_DEDUP = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS place, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, place, i, parts[i] AS line,
    translate(regexp_replace(parts[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT r, doc_id, place, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT r, doc_id, place, string_split(text, chr(10)) AS parts FROM texts))),
repeated AS (
  SELECT key, min(place) AS first_place FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT place) > 1)
SELECT any_value(l.doc_id) AS doc_id, count(*)::BIGINT AS n_lines,
  count(first_place) FILTER (l.place <> first_place)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (first_place IS NULL OR l.place = first_place), '')) AS kept_sha256
FROM lines l LEFT JOIN repeated USING (key) GROUP BY r
"""


def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Every part is compared with every entry in each round."""
    steps = [
        f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, embedding AS x FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda c: c IS NOT NULL AND isfinite(c::DOUBLE)))),
pieces AS MATERIALIZED (
  SELECT r, (i - 1) * {parts} // len(x) AS part, (i - 1) % (len(x) // {parts}) AS place, floor(1024 * x[i]::DOUBLE)::BIGINT AS c
  FROM (SELECT r, x, unnest(range(1, len(x) + 1)) AS i FROM kept)),
books0 AS MATERIALIZED (SELECT r AS entry, part, place, c FROM pieces WHERE r < {entries})"""
    ]
    for n in range(rounds + 1):
        steps.append(f"""
coded{n} AS MATERIALIZED (
  SELECT r, part, min(d) AS d, arg_min(entry, d * {entries} + entry) AS entry
  FROM (SELECT p.r, p.part, b.entry, sum((p.c - b.c) * (p.c - b.c))::BIGINT AS d
        FROM pieces p JOIN books{n} b USING (part, place) GROUP BY ALL) GROUP BY r, part)""")
        if n < rounds:
            steps.append(f"""
books{n + 1} AS MATERIALIZED (
  SELECT b.entry, b.part, b.place, coalesce(m.c, b.c) AS c
  FROM books{n} b LEFT JOIN (
    SELECT entry, part, place, floor((sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) / count(*))::BIGINT AS c
    FROM pieces JOIN coded{n} USING (r, part) GROUP BY entry, part, place) m USING (entry, part, place))""")
    steps.append(f"""
found AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM kept JOIN coded{rounds} USING (r) GROUP BY r, vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place), '')) FROM books{rounds}) AS codebooks_sha256
FROM found
""")
    return ",".join(steps)


_PREFIX_TRIE = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(0, 8),
      lambda acc, k: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END) AS v FROM range(256) r(i))),
ordered AS (
  SELECT conv_id, id, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id, size) - 1 AS p
  FROM (SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
          sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS id
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS block,
    xor(list_reduce([4294967295] || list_transform(range(1, len(conv_id::VARCHAR) + 1), lambda j: ascii((conv_id::VARCHAR)[j])),
      lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL) CROSS JOIN crc_table),
rebuilt AS (
  SELECT conv_id, id, size, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS depth FROM (
    SELECT c.conv_id, 0 AS own, p, id, size FROM convs c JOIN ordered o ON o.conv_id = c.block AND o.p < c.h
    UNION ALL SELECT c.conv_id, 1, p, id, size FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND o.p >= c.h)),
paths AS MATERIALIZED (
  SELECT conv_id, 0 AS depth, '' AS key, 0 AS size FROM convs
  UNION ALL SELECT conv_id, depth, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY depth), size FROM rebuilt),
nodes AS MATERIALIZED (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n, any_value(size) AS size,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = last) AS ends
  FROM paths JOIN (SELECT conv_id, max(depth) AS last FROM paths GROUP BY conv_id) USING (conv_id) GROUP BY key, depth),
children AS (SELECT key[1:-33] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
sums AS (
  SELECT p.key, count(*) FILTER (c.key IS NULL) AS n_leaves, sum((u.n - 1) * u.size) AS saved_tokens
  FROM nodes u LEFT JOIN children c USING (key) JOIN paths p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.key)
SELECT v.conv_id, v.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, v.n::BIGINT AS n_convs,
  coalesce(c.n_children, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
  sha256(coalesce(v.ends, '')) AS ends_sha256
FROM nodes v JOIN sums s USING (key) LEFT JOIN children c USING (key)
LEFT JOIN nodes a ON v.depth > 0 AND a.depth = v.depth - 1 AND a.key = v.key[1:-33]
"""

ORACLE_SQL = {
    "op1_decontamination": _DECONTAMINATION, "op7_quality": _QUALITY, "op9_line_dedup": _LINE_DEDUP,
    "op12_prefix_trie": _PREFIX_TRIE, "op13_vector_codes": _vector_codes(),
}
