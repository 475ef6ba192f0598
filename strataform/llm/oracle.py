"""DuckDB statements for the queries of this subpackage that SQL can express."""

from .license_scan import BLOCK_END, PHRASES, TEMPLATES, THRESHOLD

MINHASH_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3),
                                      lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w),
u AS (SELECT doc_id, unnest(s) AS g FROM s),
n AS (SELECT doc_id, len(s) AS n FROM s),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)),
m AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (
  SELECT doc_id, doc_id AS c FROM n
  UNION SELECT m.b, r.c FROM r JOIN m ON m.a = r.doc_id)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.c) AS component_id, n.doc_id = min(r.c) AS kept
FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n
"""

EXACT_DEDUP = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)
"""

CHAT_TREES = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
l AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), ''
                      ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
             FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length(replace(replace(role, '\', '\\'), '<|', '<\|'))
        + (length(role) - length(replace(role, chr(10), '')))
        + length(replace(replace(text, '\', '\\'), '<|', '<\|'))
        + length('<|im_start|>') + length('<|im_end|>') + 2)::BIGINT AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars
FROM l
"""

_PHRASE_ROWS = ", ".join(f"('{p}', '{label}')" for p, label in PHRASES.items())
_TEMPLATE_ROWS = ", ".join(f"('{label}', '{t}')" for label, t in TEMPLATES.items())

LICENSE_SCAN = rf"""
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t),
p(phrase, label) AS (VALUES {_PHRASE_ROWS}),
k AS (SELECT string_split(phrase, ' ') AS k, label FROM p),
places AS (
  SELECT doc_id, label, i - 1 AS place
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w) JOIN k
    ON w[i] = k[1] AND w[i:i + len(k) - 1] = k),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY doc_id),
m(label, template) AS (VALUES {_TEMPLATE_ROWS}),
s AS (SELECT label, list_distinct(string_split(template, ' ')) AS s FROM m),
b AS (
  SELECT doc_id, list_distinct(regexp_extract_all(
           block, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS b
  FROM (SELECT doc_id, unnest(string_split_regex(t, '{BLOCK_END}')) AS block FROM t)),
c AS (
  SELECT doc_id, label, max(len(list_intersect(s, b)) / len(s)) AS c
  FROM b, s GROUP BY ALL),
found AS (
  SELECT doc_id, list(label) AS labels, max(c) AS c FROM c
  WHERE c >= {THRESHOLD} - 1e-9 GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(coalesce(base.labels, []), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(
         coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(c, 0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
"""

TOPK_SEARCH = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT
         AS rank, vec_id, score
  FROM s)
SELECT * FROM r WHERE rank <= 5
"""

#: crc32 of the decimal digits, bit by bit from its polynomial.
_CRC32 = """
  xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
      lambda x, i: xor(x >> 1, (x & 1) * 3988292384))))"""

PERIODIC_RUNS = rf"""
WITH h AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         {_CRC32} AS h FROM documents),
g AS (SELECT *, h // 10 AS g, len(w) AS n FROM h),
a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM g),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
t AS (
  SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(
    range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM p),
k AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS i, unnest(w) AS word FROM t),
same AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i,
         x.i - row_number() OVER (PARTITION BY x.doc_id, y.i - x.i ORDER BY x.i) AS island
  FROM k x JOIN k y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i),
stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM same
  GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(12, 2 * q)),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretch GROUP BY ALL),
listed AS (
  SELECT doc_id, count(*) AS n_runs,
         min(struct_pack(l := -length, s := start, p := period)) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), ''
                    ORDER BY start, period) AS runs
  FROM runs GROUP BY doc_id),
kept AS (
  SELECT doc_id, i, word FROM k WHERE NOT EXISTS (
    SELECT 1 FROM runs r WHERE r.doc_id = k.doc_id AND k.i >= r.start + r.period
      AND k.i < r.start + r.length)),
joined AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM kept GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, -best.l AS length,
       best.p AS period, (1000 * -best.l) // best.p AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(joined.text, '')) AS collapsed_sha256
FROM t LEFT JOIN listed USING (doc_id) LEFT JOIN joined USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_minhash_dedup": MINHASH_DEDUP,
        "op4_exact_dedup": EXACT_DEDUP,
        "op6_chat_trees": CHAT_TREES,
        "op7_license_scan": LICENSE_SCAN,
        "op10_topk_search": TOPK_SEARCH,
        "op12_periodic_runs": PERIODIC_RUNS,
    }
