"""DuckDB statements of the numbered queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
  ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
classes AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM sets WHERE len(s) > 0 GROUP BY 1),
terms AS (SELECT rep, len(s) AS n, hash(t) AS t FROM (SELECT rep, s, unnest(s) AS t FROM classes)),
pairs AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS inter
  FROM terms a JOIN terms b ON a.t = b.t AND a.rep < b.rep AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80 GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE inter * 100 >= (na + nb - inter) * 80),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (SELECT rep, rep FROM classes UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
least_of AS (SELECT node, min(other) AS component FROM reach GROUP BY 1)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(l.component, d.doc_id) AS component_id,
  d.doc_id = coalesce(l.component, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN least_of l ON l.node = c.rep"""

OP3 = """
WITH sound AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""

# Checksums by a table of 256 entries, made by its rule; ``crc`` of bytes as text.
_CRC = """
crc_table AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    """crc32 of a column's UTF-8 bytes, with ``t`` of ``crc_table`` at hand."""
    byte_list = (f"list_transform(range(octet_length(encode({text}))), "
                 f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)")
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, {byte_list}), "
            "lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])))")


OP12 = rf"""
WITH {_CRC},
texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, true AS own FROM documents
  UNION ALL SELECT NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), false FROM benchmark),
seen AS (SELECT own, w, count(*) AS n FROM (SELECT own, unnest(w) AS w FROM texts) GROUP BY 1, 2),
words AS (SELECT w, {_crc32("w")} % 10000 AS b FROM (SELECT DISTINCT w FROM seen), crc_table),
counted AS (SELECT b, coalesce(sum(n) FILTER (own), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT own), 0)::DOUBLE AS t FROM seen JOIN words USING (w) GROUP BY 1),
gains AS (SELECT b, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS g FROM counted),
each AS (SELECT doc_id, n, g FROM (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM texts WHERE own) GROUP BY 1, 2) JOIN words USING (w) JOIN gains USING (b)),
means AS (SELECT doc_id, floor(sum(n * g) / sum(n)::DOUBLE)::BIGINT AS weight FROM each GROUP BY 1),
scored AS (SELECT d.doc_id, len(d.w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM texts d LEFT JOIN means USING (doc_id) WHERE own),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r END::BIGINT AS rank FROM placed"""

OP13 = rf"""
WITH RECURSIVE {_CRC},
runs AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents) GROUP BY 1, 2),
hashed AS (SELECT w, n, {_crc32("(doc_id || ':' || w)")} AS h FROM runs, crc_table WHERE len(w) >= 6),
edited AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % len(w)) || substr(w, h % len(w) + 2) ELSE w END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM edited GROUP BY 1 HAVING len(word) >= 6 AND sum(n) >= 5),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY 1),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chain(word, root) AS (SELECT word, word FROM forms UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""

ORACLE_SQL = {"op1_minmax_near_dedup": OP1, "op3_exact_top_k": OP3,
              "op12_importance_resampling": OP12, "op13_spelling_variants": OP13}
