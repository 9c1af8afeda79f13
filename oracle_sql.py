"""DuckDB oracle statements, one per key of ``revlens.plans.queries``.

The driver registers the parquet tables as views; each statement rebuilds
the stand-in review tables with CTEs (FIXTURES.md part B) and computes the
same result independently of Spark.
"""

from __future__ import annotations

REVIEWS_CTE = """
reviews AS (
  SELECT d.doc_id AS id, d.text AS review_body, d.lang AS product_category,
         d.source || '/' || d.lang AS fine_category,
         CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 5
              WHEN l.quality = 1 AND l.toxic = 1 THEN 3
              WHEN l.quality = 0 AND l.toxic = 0 THEN 2
              WHEN l.quality = 0 AND l.toxic = 1 THEN 1 END AS star_rating
  FROM documents d LEFT JOIN labels l USING (doc_id)
),
labelled AS (
  SELECT id, review_body, product_category, fine_category,
         CASE WHEN star_rating IN (1, 2) THEN -1 WHEN star_rating = 3 THEN 0
              WHEN star_rating IN (4, 5) THEN 1 END AS sentiment
  FROM reviews
  WHERE star_rating IS NOT NULL AND review_body IS NOT NULL AND product_category IS NOT NULL
),
clean AS (
  SELECT id, sentiment, review_body, product_category FROM labelled
  WHERE product_category IN (SELECT product_category FROM labelled GROUP BY 1 HAVING count(*) > 10)
)"""

ORDERS_CTE = """
order_reviews AS (
  SELECT o.o_orderkey AS id, c.c_mktsegment AS product_category,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS star_rating
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
olabelled AS (
  SELECT id, product_category,
         CASE WHEN star_rating IN (1, 2) THEN -1 WHEN star_rating = 3 THEN 0
              WHEN star_rating IN (4, 5) THEN 1 END AS sentiment
  FROM order_reviews WHERE star_rating IS NOT NULL AND product_category IS NOT NULL
),
oclean AS (
  SELECT id, sentiment, product_category FROM olabelled
  WHERE product_category IN (SELECT product_category FROM olabelled GROUP BY 1 HAVING count(*) > 10)
)"""


def with_reviews(body: str) -> str:
    return "WITH " + REVIEWS_CTE + "\n" + body


def with_orders(body: str) -> str:
    return "WITH " + ORDERS_CTE + "\n" + body


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["count_by_category_sentiment"] = with_reviews("""
SELECT product_category, sentiment, count(*) AS count_reviews
FROM clean GROUP BY product_category, sentiment
ORDER BY product_category ASC NULLS LAST, sentiment DESC NULLS LAST, count_reviews""")

ORACLE_SQL["count_by_category_sentiment_orders"] = with_orders("""
SELECT product_category, sentiment, count(*) AS count_reviews
FROM oclean GROUP BY product_category, sentiment
ORDER BY product_category ASC NULLS LAST, sentiment DESC NULLS LAST, count_reviews""")

# Split CTE: per-class validation quota from the train allocation
# (largest remainder, ties by smaller label), then the first quota rows per
# class in md5(id:42) order are the validation part.
SPLIT_CTE = """,
cls AS (SELECT sentiment, count(*) AS n_c FROM clean WHERE sentiment IS NOT NULL GROUP BY sentiment),
tot AS (SELECT CAST(sum(n_c) AS BIGINT) AS n FROM cls),
ntrain AS (SELECT n, n - CAST(ceil(0.1e0 * CAST(n AS DOUBLE)) AS BIGINT) AS n_train FROM tot),
alloc AS (
  SELECT sentiment, n_c,
         CAST(n_c AS DOUBLE) / CAST(n AS DOUBLE) * CAST(n_train AS DOUBLE) AS cont
  FROM cls, ntrain),
fl AS (SELECT sentiment, n_c, floor(cont) AS f, cont - floor(cont) AS rem FROM alloc),
need AS (SELECT (SELECT n_train FROM ntrain) - CAST(sum(f) AS BIGINT) AS k FROM fl),
quota AS (
  SELECT sentiment,
         n_c - CAST(f AS BIGINT)
             - CASE WHEN row_number() OVER (ORDER BY rem DESC, sentiment) <= (SELECT k FROM need)
                    THEN 1 ELSE 0 END AS vq
  FROM fl),
ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.sentiment
                                 ORDER BY md5(CAST(c.id AS VARCHAR) || ':42'), c.id) AS rn
  FROM clean c WHERE c.sentiment IS NOT NULL),
split AS (
  SELECT r.id, r.sentiment, r.review_body, r.product_category,
         CASE WHEN r.rn <= q.vq THEN 'validation' ELSE 'train' END AS split
  FROM ranked r JOIN quota q ON r.sentiment = q.sentiment)"""

BALANCE_CTE = """,
bal_input AS (SELECT * FROM {src} WHERE product_category IS NOT NULL AND sentiment IS NOT NULL),
bal_cells AS (SELECT product_category, sentiment, count(*) AS n FROM bal_input GROUP BY ALL),
bal_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY product_category, sentiment
                               ORDER BY md5(CAST(id AS VARCHAR) || ':42'), id) AS rn
  FROM bal_input),
balanced AS (SELECT * EXCLUDE (rn) FROM bal_ranked WHERE rn <= (SELECT min(n) FROM bal_cells))"""

# Tokeniser in RE2 syntax (same rule list as the Spark side, written for DuckDB).
_TOKEN_RULES_RE2 = [
    (r"\.\.\.", " ... "),
    (r"--", " -- "),
    (r"([;@#$%&?!()\[\]{}<>])", r" \1 "),
    (r":([^0-9]|$)", r" : \1"),
    (r"([^.\s])\.(\s|$)", r"\1 . \2"),
    (r"$", " "),
    (r"([^''\s])(''s|''m|''d|''ll|''re|''ve|n''t|'')\s", r"\1 \2 "),
    (r"\b(can)(not)\b", r"\1 \2"),
    (r"\s+", " "),
]


def norm_sql(x: str) -> str:
    return f"""lower(regexp_replace({x}, '[,"]', '', 'g'))"""


def tok_sql(x: str) -> str:
    s = norm_sql(x)
    for pattern, repl in _TOKEN_RULES_RE2:
        s = f"regexp_replace({s}, '{pattern}', '{repl}', 'g')"
    return f"trim({s})"


def tokens_sql(t: str) -> str:
    return f"list_filter(string_split({t}, ' '), lambda x: x <> '')"


SAMPLES_VALUES = """(VALUES (-1, 'I''m not a fan of this product!'), (-2, 'I don''t like this product!'),
        (-3, 'this product is ok'), (-4, 'I do like this product!'),
        (-5, 'This product is great!'), (-6, 'OK, but not great.'),
        (-7, 'This is not the right product.')) AS s(id, review_body)"""

TEXTS_CTE = f""",
texts AS (
  SELECT doc_id AS id, text AS review_body FROM documents
  UNION ALL SELECT CAST(id AS BIGINT), review_body FROM {SAMPLES_VALUES})"""


def bias_sql(src: str, facet: str = "product_category") -> str:
    return f""",
bd AS (SELECT {facet} AS f, sentiment AS y FROM {src}
       WHERE sentiment IS NOT NULL AND {facet} IS NOT NULL),
blabels AS (SELECT y, CAST(count(*) AS DOUBLE) AS t FROM bd GROUP BY y),
bfacets AS (SELECT DISTINCT f FROM bd),
bcounts AS (SELECT f, y, count(*) AS n FROM bd GROUP BY f, y),
bgrid AS (
  SELECT bf.f, bl.y, bl.t, CAST(coalesce(bc.n, 0) AS DOUBLE) AS nd
  FROM bfacets bf CROSS JOIN blabels bl
  LEFT JOIN bcounts bc ON bc.f = bf.f AND bc.y = bl.y),
bsides AS (
  SELECT f, y, nd, t - nd AS na,
         sum(nd) OVER (PARTITION BY f) AS n_d,
         sum(t) OVER (PARTITION BY f) - sum(nd) OVER (PARTITION BY f) AS n_a
  FROM bgrid),
bp AS (
  SELECT *, CASE WHEN n_d > 0 THEN nd / n_d END AS pd,
            CASE WHEN n_a > 0 THEN na / n_a END AS pa FROM bsides),
bm AS (SELECT *, (pa + pd) / 2 AS pm FROM bp)
SELECT CAST(f AS VARCHAR) AS facet_value,
  round(CASE WHEN max(n_a) + max(n_d) > 0 THEN (max(n_a) - max(n_d)) / (max(n_a) + max(n_d)) END, 6) AS ci,
  round(CASE WHEN max(n_a) > 0 THEN sum(CASE WHEN y = 1 THEN na ELSE 0 END) / max(n_a) END
        - sum(CASE WHEN y = 1 THEN nd ELSE 0 END) / max(n_d), 6) AS dpl,
  round(sum(CASE WHEN pa IS NULL OR pd IS NULL THEN NULL WHEN pa = 0 THEN 0
                 WHEN pd = 0 THEN CAST('inf' AS DOUBLE) ELSE pa * ln(pa / pd) END), 6) AS kl,
  round((sum(CASE WHEN pa IS NULL OR pm IS NULL THEN NULL WHEN pa = 0 THEN 0
                  WHEN pm = 0 THEN CAST('inf' AS DOUBLE) ELSE pa * ln(pa / pm) END)
       + sum(CASE WHEN pd IS NULL OR pm IS NULL THEN NULL WHEN pd = 0 THEN 0
                  WHEN pm = 0 THEN CAST('inf' AS DOUBLE) ELSE pd * ln(pd / pm) END)) / 2, 6) AS js,
  round(sqrt(sum((pa - pd) * (pa - pd))), 6) AS lp,
  round(sum(abs(pa - pd)) / 2, 6) AS tvd,
  round(max(abs(pa - pd)), 6) AS ks
FROM bm GROUP BY f"""


# ----------------------------------------------------------------- cleaning
ORACLE_SQL["rating_to_sentiment"] = with_reviews("""
SELECT id, star_rating,
       CASE WHEN star_rating IN (1, 2) THEN -1 WHEN star_rating = 3 THEN 0
            WHEN star_rating IN (4, 5) THEN 1 END AS sentiment
FROM reviews""")

ORACLE_SQL["clean_raw_csv"] = with_reviews(
    "SELECT sentiment, review_body, product_category FROM clean")

ORACLE_SQL["clean_raw_csv_splits"] = ORACLE_SQL["clean_raw_csv"]

ORACLE_SQL["clean_reviews"] = with_reviews("SELECT id, sentiment, review_body, product_category FROM clean")

ORACLE_SQL["rare_category_filter"] = with_reviews("""
SELECT id, fine_category, sentiment FROM labelled
WHERE fine_category IN (SELECT fine_category FROM labelled WHERE fine_category IS NOT NULL
                        GROUP BY 1 HAVING count(*) > 10)""")

ORACLE_SQL["stage_shapes"] = with_reviews("""
SELECT 'raw' AS stage, count(*) AS n_rows, 5 AS n_cols FROM reviews
UNION ALL SELECT 'dropna', count(*), 3 FROM labelled
UNION ALL SELECT 'final', count(*), 3 FROM clean""")

ORACLE_SQL["preview_reviews"] = with_reviews("""
SELECT id, sentiment, review_body, product_category FROM clean ORDER BY id LIMIT 5""")

# ---------------------------------------------------------------- profiling
ORACLE_SQL["count_by_sentiment"] = with_reviews("""
SELECT sentiment, count(sentiment) AS count_sentiment FROM clean
GROUP BY sentiment ORDER BY sentiment NULLS LAST""")

ORACLE_SQL["count_sentiment_by_category"] = with_reviews("""
SELECT product_category, count(sentiment) AS count_sentiment FROM clean
GROUP BY product_category ORDER BY count_sentiment DESC""")

ORACLE_SQL["avg_sentiment_by_category"] = with_reviews("""
SELECT product_category, round(avg(sentiment), 6) AS avg_sentiment FROM clean
GROUP BY product_category ORDER BY avg_sentiment DESC""")

ORACLE_SQL["avg_sentiment_by_category_orders"] = with_orders("""
SELECT product_category, round(avg(sentiment), 6) AS avg_sentiment FROM oclean
GROUP BY product_category ORDER BY avg_sentiment DESC""")

ORACLE_SQL["count_reviews_by_category"] = with_reviews("""
SELECT product_category, count(*) AS count_reviews FROM clean
GROUP BY product_category ORDER BY count_reviews DESC""")

ORACLE_SQL["max_category_count"] = with_reviews("""
SELECT max(c) AS max_count_reviews FROM (SELECT count(*) AS c FROM clean GROUP BY product_category)""")

ORACLE_SQL["sentiment_totals"] = with_reviews(""",
breakdown AS (SELECT product_category, sentiment, count(*) AS count_reviews FROM clean GROUP BY ALL)
SELECT sentiment, CAST(sum(count_reviews) AS BIGINT) AS count_reviews,
       grouping(sentiment) = 1 AS is_total
FROM breakdown GROUP BY ROLLUP (sentiment)""")

_PCT = """
SELECT product_category,
  round(CAST(count(*) FILTER (WHERE sentiment = 1) AS DOUBLE) / count(*) * 100, 6) AS pct_positive,
  round(CAST(count(*) FILTER (WHERE sentiment = 0) AS DOUBLE) / count(*) * 100, 6) AS pct_neutral,
  round(CAST(count(*) FILTER (WHERE sentiment = -1) AS DOUBLE) / count(*) * 100, 6) AS pct_negative
FROM {src} WHERE sentiment IS NOT NULL GROUP BY product_category"""
ORACLE_SQL["sentiment_pct_by_category"] = with_reviews(_PCT.format(src="clean"))
ORACLE_SQL["sentiment_pct_by_category_orders"] = with_orders(_PCT.format(src="oclean"))

_CROSSCOUNT = """
SELECT s.sentiment, c.product_category, count(x.id) AS count_reviews
FROM (SELECT DISTINCT sentiment FROM {src} WHERE sentiment IS NOT NULL) s
CROSS JOIN (SELECT DISTINCT product_category FROM {src} WHERE sentiment IS NOT NULL) c
LEFT JOIN {src} x ON x.sentiment = s.sentiment
                 AND x.product_category IS NOT DISTINCT FROM c.product_category
GROUP BY ALL
UNION ALL
SELECT sentiment, product_category, count(*) FROM {src} WHERE sentiment IS NULL GROUP BY ALL"""
ORACLE_SQL["sentiment_pct_by_fine_category"] = with_reviews(
    _PCT.format(src="labelled").replace("product_category", "fine_category"))
ORACLE_SQL["crosscount_unbalanced"] = with_reviews(_CROSSCOUNT.format(src="clean"))

_MIN_CELL = """
SELECT min(n) AS min_cell_size, count(*) AS n_cells FROM (
  SELECT count(*) AS n FROM {src} WHERE product_category IS NOT NULL AND sentiment IS NOT NULL
  GROUP BY product_category, sentiment)"""
ORACLE_SQL["min_cell_size"] = with_reviews(_MIN_CELL.format(src="clean"))
ORACLE_SQL["min_cell_size_orders"] = with_orders(_MIN_CELL.format(src="oclean"))

ORACLE_SQL["review_word_counts"] = with_reviews("""
SELECT id, len(string_split(review_body, ' ')) AS num_words FROM reviews""")

ORACLE_SQL["word_count_describe"] = with_reviews(""",
w AS (SELECT len(string_split(review_body, ' ')) AS x FROM reviews)
SELECT count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
       CAST(min(x) AS DOUBLE) AS min,
       round(quantile_cont(x, 0.1e0), 6) AS p10, round(quantile_cont(x, 0.2e0), 6) AS p20,
       round(quantile_cont(x, 0.3e0), 6) AS p30, round(quantile_cont(x, 0.4e0), 6) AS p40,
       round(quantile_cont(x, 0.5e0), 6) AS p50, round(quantile_cont(x, 0.6e0), 6) AS p60,
       round(quantile_cont(x, 0.7e0), 6) AS p70, round(quantile_cont(x, 0.8e0), 6) AS p80,
       round(quantile_cont(x, 0.9e0), 6) AS p90, round(quantile_cont(x, 1.0e0), 6) AS p100,
       CAST(max(x) AS DOUBLE) AS max
FROM w""")

ORACLE_SQL["word_count_histogram"] = with_reviews(""",
w AS (SELECT len(string_split(review_body, ' ')) AS x FROM reviews),
b AS (SELECT CAST(least(floor(x * 100 / 256), 99) AS INTEGER) AS bin, count(*) AS c
      FROM w WHERE x BETWEEN 0 AND 256 GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(100))
SELECT g.bin, round(CAST(g.bin AS DOUBLE) * 256 / 100, 6) AS bin_start,
       round(CAST(g.bin + 1 AS DOUBLE) * 256 / 100, 6) AS bin_end,
       CAST(coalesce(b.c, 0) AS BIGINT) AS frequency
FROM g LEFT JOIN b ON g.bin = b.bin ORDER BY g.bin""")

# --------------------------------------------------------------------- bias
ORACLE_SQL["bias_report"] = with_reviews(bias_sql("clean"))
ORACLE_SQL["bias_report_orders"] = with_orders(bias_sql("oclean"))
ORACLE_SQL["bias_from_config"] = with_reviews(
    bias_sql("clean").replace("SELECT CAST(f AS VARCHAR) AS facet_value,",
                              "SELECT 'product_category' AS facet, CAST(f AS VARCHAR) AS facet_value, "
                              "'report' AS report,"))
ORACLE_SQL["bias_from_config_balanced"] = with_reviews(
    BALANCE_CTE.format(src="clean")
    + bias_sql("balanced").replace("SELECT CAST(f AS VARCHAR) AS facet_value,",
                                   "SELECT 'product_category' AS facet, CAST(f AS VARCHAR) AS facet_value, "
                                   "'report' AS report,"))
ORACLE_SQL["bias_from_config_groups"] = "SELECT * FROM (" + with_reviews(
    bias_sql("clean", "CASE WHEN product_category IN ('en', 'de') THEN 'en,de' "
                      "WHEN product_category IS NOT NULL THEN 'rest' END")
    .replace("SELECT CAST(f AS VARCHAR) AS facet_value,",
             "SELECT 'product_category' AS facet, CAST(f AS VARCHAR) AS facet_value, "
             "'report' AS report,")) + ") WHERE facet_value = 'en,de'"
# The sketches' random choices are free; what must hold is their stated error.
ORACLE_SQL["word_count_quantile_errors"] = with_reviews("""
SELECT product_category, level, true AS kept
FROM (SELECT DISTINCT product_category FROM reviews WHERE review_body IS NOT NULL),
     (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9, 0.99])::DOUBLE AS level)""")
ORACLE_SQL["stream_scored_once"] = "SELECT doc_id AS id, count(DISTINCT doc_id) AS times FROM documents GROUP BY doc_id"

ORACLE_SQL["bias_report_fine_category"] = with_reviews(bias_sql("labelled", "fine_category"))

# ----------------------------------------------------------------- sampling
ORACLE_SQL["balanced_reviews"] = with_reviews(BALANCE_CTE.format(src="clean") + """
SELECT id, sentiment, review_body, product_category FROM balanced""")

ORACLE_SQL["balanced_orders"] = with_orders(BALANCE_CTE.format(src="oclean") + """
SELECT id, sentiment, product_category FROM balanced""")

ORACLE_SQL["crosscount_fine_category"] = with_reviews(
    _CROSSCOUNT.format(src="labelled").replace("product_category", "fine_category"))
ORACLE_SQL["crosscount_balanced"] = with_reviews(BALANCE_CTE.format(src="clean")
                                                 + _CROSSCOUNT.format(src="balanced"))

ORACLE_SQL["bias_report_balanced"] = with_reviews(BALANCE_CTE.format(src="clean") + bias_sql("balanced"))
ORACLE_SQL["bias_report_balanced_orders"] = with_orders(
    BALANCE_CTE.format(src="oclean") + bias_sql("balanced"))

ORACLE_SQL["training_projection"] = with_reviews(BALANCE_CTE.format(src="clean") + """
SELECT sentiment, review_body FROM balanced""")

ORACLE_SQL["stratified_split"] = with_reviews(SPLIT_CTE + """
SELECT id, sentiment, split FROM split""")

ORACLE_SQL["stratified_split_orders"] = with_orders(
    SPLIT_CTE.replace("FROM clean", "FROM oclean").replace("r.review_body, ", "") + """
SELECT id, sentiment, split FROM split""")

ORACLE_SQL["split_sizes"] = with_reviews(SPLIT_CTE + """
SELECT split, count(*) AS n_rows,
       round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 1) AS pct
FROM split GROUP BY split ORDER BY split""")

# --------------------------------------------------------------------- text
ORACLE_SQL["normalize_text"] = "WITH " + TEXTS_CTE.lstrip(",") + f"""
SELECT id, {norm_sql('review_body')} AS normalized FROM texts"""

ORACLE_SQL["tokenize_reviews"] = "WITH " + TEXTS_CTE.lstrip(",") + f"""
SELECT id, {tok_sql('review_body')} AS tokens_text FROM texts"""

ABBREVIATION_CTE = "WITH " + TEXTS_CTE.lstrip(",") + r""",
seen AS (SELECT unnest(regexp_split_to_array(lower(review_body), '\s+')) AS t FROM texts),
parts AS (SELECT regexp_extract(t, '^[^\p{L}]*(\p{L}+(?:\.\p{L}+)*)(\.?)[^\p{L}.]*$', 1) AS word,
                 regexp_extract(t, '^[^\p{L}]*(\p{L}+(?:\.\p{L}+)*)(\.?)[^\p{L}.]*$', 2) = '.' AS period FROM seen),
counted AS (SELECT word, count(*) FILTER (period) AS n_period, count(*) FILTER (NOT period) AS n_plain
            FROM parts WHERE word <> '' GROUP BY word),
shares AS (SELECT sum(n_period)::DOUBLE / sum(n_period + n_plain) AS p FROM counted),
abbr AS (
  SELECT word, n_period, n_plain, length(replace(word, '.', ''))::DOUBLE AS letters,
         CASE WHEN p < 1 THEN
         -2 * ((n_period * ln(p) + n_plain * ln(1 - p)) - (n_period * ln(0.99::DOUBLE) + n_plain * ln(1 - 0.99::DOUBLE)))
         * exp(-letters) * (length(word) - letters + 1) * pow(letters, -n_plain::DOUBLE) END AS score
  FROM counted, shares WHERE n_period > 0)"""

ORACLE_SQL["abbreviation_scores"] = ABBREVIATION_CTE + """
SELECT word, n_period, n_plain, round(score, 6) AS score FROM abbr"""

ORACLE_SQL["tokenize_abbreviations"] = ABBREVIATION_CTE + f""",
found AS (SELECT coalesce(list(word), []) AS known FROM abbr WHERE score >= 0.3),
toks AS (SELECT id, {tokens_sql(tok_sql('review_body'))} AS tokens FROM texts)
SELECT id, array_to_string(list_filter(list_transform(tokens, lambda t, i:
    CASE WHEN i < len(tokens) - 1 AND tokens[i + 1] = '.' AND list_contains(known, t) THEN t || '.'
         WHEN t = '.' AND i > 1 AND i < len(tokens) AND list_contains(known, tokens[i - 1]) THEN NULL
         ELSE t END), lambda x: x IS NOT NULL), ' ') AS tokens_text
FROM toks, found"""

ORACLE_SQL["label_prefix"] = with_reviews(""",
lab AS (SELECT id, CAST(sentiment AS VARCHAR) AS label FROM clean
        UNION ALL SELECT * FROM (VALUES (-1, '__label__1'), (-2, 'able'), (-3, '__label__able')) v(id, label)),
pre AS (SELECT id, label, '__label__' || replace(label, '__label__', '') AS prefixed FROM lab)
SELECT id, label, prefixed, regexp_replace(prefixed, '^__label__', '') AS stripped FROM pre""")

ORACLE_SQL["prepare_training_rows"] = with_reviews(f""",
src AS (SELECT id, sentiment, review_body FROM clean
        UNION ALL SELECT * FROM (VALUES (-1, -1, 'I don''t like this product!'),
                                        (-2, 0, 'this product is ok'),
                                        (-3, 1, 'I do like this product!')) v(id, sentiment, review_body))
SELECT id, '__label__' || replace(CAST(sentiment AS VARCHAR), '__label__', '') AS sentiment,
       {tok_sql('review_body')} AS review_body
FROM src""")

ORACLE_SQL["labelled_text_lines"] = with_reviews(SPLIT_CTE + f"""
SELECT id, split,
       concat_ws(' ', '__label__' || replace(CAST(sentiment AS VARCHAR), '__label__', ''),
                 {tok_sql('review_body')}) AS value
FROM split""")

TOKENS_CTE = f""",
toks AS (SELECT id, sentiment, {tokens_sql(tok_sql('review_body'))} AS tokens FROM clean)"""

ORACLE_SQL["vocabulary_min_count"] = with_reviews(TOKENS_CTE + """
SELECT token, count(*) AS token_count FROM (SELECT unnest(tokens) AS token FROM toks)
GROUP BY token HAVING count(*) >= 2""")

ORACLE_SQL["word_ngrams"] = with_reviews(TOKENS_CTE + """,
grams AS (
  SELECT n, unnest(list_transform(range(1, len(tokens) - n + 2),
                                  lambda i: array_to_string(tokens[i:i + n - 1], ' '))) AS ngram
  FROM toks, (VALUES (1), (2), (3)) v(n))
SELECT n, ngram, count(*) AS ngram_count FROM grams GROUP BY n, ngram""")

ORACLE_SQL["frequent_ngrams"] = ORACLE_SQL["word_ngrams"] + " HAVING count(*) >= 2"

ORACLE_SQL["frequent_tokens"] = with_reviews(TOKENS_CTE + """,
each AS (SELECT id, unnest(tokens) AS token FROM toks),
often AS (SELECT token FROM each GROUP BY token HAVING count(*) >= 2),
kept AS (SELECT id, count(*) AS n FROM each JOIN often USING (token) GROUP BY id)
SELECT t.id, len(t.tokens)::BIGINT AS n_tokens, coalesce(k.n, 0)::BIGINT AS n_kept
FROM toks t LEFT JOIN kept k USING (id)""")

# -------------------------------------------------------------- naive Bayes
NB_CTE = SPLIT_CTE + f""",
ntoks AS (SELECT id, sentiment, split, {tokens_sql(tok_sql('review_body'))} AS tokens FROM split),
nbtrain AS (SELECT * FROM ntoks WHERE split = 'train'),
tex AS (SELECT sentiment, unnest(tokens) AS token FROM nbtrain),
tc AS (SELECT token, sentiment, count(*) AS c FROM tex GROUP BY ALL),
vocab AS (SELECT token FROM tc GROUP BY token HAVING sum(c) >= 2),
nlabels AS (SELECT sentiment, count(*) AS docs FROM nbtrain GROUP BY sentiment),
ngrid AS (
  SELECT v.token, l.sentiment, CAST(coalesce(tc.c, 0) AS BIGINT) AS c
  FROM vocab v CROSS JOIN nlabels l
  LEFT JOIN tc ON tc.token = v.token AND tc.sentiment = l.sentiment),
ntot AS (SELECT sentiment, sum(c) AS n_c FROM ngrid GROUP BY sentiment),
vsize AS (SELECT count(*) AS v FROM vocab),
weights AS (
  SELECT g.token, g.sentiment, g.c AS token_count,
         ln((g.c + 1.0e0) / (CAST(n.n_c AS DOUBLE) + 1.0e0 * vs.v)) AS log_prob
  FROM ngrid g JOIN ntot n ON g.sentiment = n.sentiment CROSS JOIN vsize vs),
nval AS (SELECT * FROM ntoks WHERE split = 'validation'),
vex AS (SELECT id, unnest(tokens) AS token FROM nval),
vsums AS (
  SELECT vex.id, w.sentiment AS label, sum(w.log_prob) AS s
  FROM vex JOIN weights w ON w.token = vex.token GROUP BY ALL),
tdocs AS (SELECT sum(docs) AS total FROM nlabels),
nscores AS (
  SELECT v.id, v.sentiment, l.sentiment AS label,
         ln(CAST(l.docs AS DOUBLE) / CAST(t.total AS DOUBLE)) + coalesce(s.s, 0) AS score
  FROM nval v CROSS JOIN nlabels l CROSS JOIN tdocs t
  LEFT JOIN vsums s ON s.id = v.id AND s.label = l.sentiment),
npred AS (
  SELECT id, sentiment, label AS prediction,
         row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS rn
  FROM nscores),
predictions AS (SELECT id, sentiment, prediction FROM npred WHERE rn = 1)"""

ORACLE_SQL["nb_token_weights"] = with_reviews(NB_CTE + """
SELECT token, sentiment, token_count, round(log_prob, 6) AS log_prob FROM weights""")

ORACLE_SQL["nb_predictions"] = with_reviews(NB_CTE + """
SELECT id, sentiment, prediction FROM predictions""")

ORACLE_SQL["nb_confusion_matrix"] = with_reviews(NB_CTE + """
SELECT sentiment, prediction, count(*) AS n FROM predictions GROUP BY ALL ORDER BY ALL""")

ORACLE_SQL["nb_accuracy"] = with_reviews(NB_CTE + """
SELECT count(*) AS n,
       round(avg(CASE WHEN sentiment = prediction THEN 1.0e0 ELSE 0.0e0 END), 6) AS accuracy
FROM predictions""")

# ------------------------------------------------------- catalog / CSV / SQL
ORACLE_SQL["csv_roundtrip"] = ORACLE_SQL["clean_reviews"]
ORACLE_SQL["catalog_count_by_sentiment"] = ORACLE_SQL["count_by_sentiment"]
ORACLE_SQL["catalog_avg_sentiment_by_category"] = ORACLE_SQL["avg_sentiment_by_category"]
ORACLE_SQL["catalog_count_by_category_sentiment"] = ORACLE_SQL["count_by_category_sentiment"]
ORACLE_SQL["catalog_num_words"] = with_reviews("""
SELECT len(string_split(review_body, ' ')) AS num_words FROM clean""")
ORACLE_SQL["sql_count_sentiment_by_category"] = ORACLE_SQL["count_sentiment_by_category"]

# ------------------------------------------------------- order_reviews variants
ORACLE_SQL["count_by_sentiment_orders"] = with_orders("""
SELECT sentiment, count(sentiment) AS count_sentiment FROM oclean
GROUP BY sentiment ORDER BY sentiment NULLS LAST""")

ORACLE_SQL["sentiment_totals_orders"] = with_orders(""",
breakdown AS (SELECT product_category, sentiment, count(*) AS count_reviews FROM oclean GROUP BY ALL)
SELECT sentiment, CAST(sum(count_reviews) AS BIGINT) AS count_reviews,
       grouping(sentiment) = 1 AS is_total
FROM breakdown GROUP BY ROLLUP (sentiment)""")

ORACLE_SQL["crosscount_orders"] = with_orders(_CROSSCOUNT.format(src="oclean"))

ORACLE_SQL["split_sizes_orders"] = with_orders(
    SPLIT_CTE.replace("FROM clean", "FROM oclean").replace("r.review_body, ", "") + """
SELECT split, count(*) AS n_rows,
       round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 1) AS pct
FROM split GROUP BY split ORDER BY split""")
