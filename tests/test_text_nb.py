import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revlens.operators import naive_bayes as nb, text as T
from revlens.sources.csv_io import write_labelled_text


@pytest.fixture
def corpus(spark):
    rows = [(1, 1, "Great dress, love it. Great fit!"),
            (2, 1, "love love this"),
            (3, -1, "I don't like it at all"),
            (4, -1, "do not buy, bad fit"),
            (5, 0, "it is ok I guess"),
            (6, 0, "ok fit, ok price"),
            (7, 1, "")]
    return spark.createDataFrame(rows, "id bigint, sentiment int, review_body string")


def test_vocabulary_is_corpus_count_not_document_frequency(spark):
    df = spark.createDataFrame([(["x", "x", "y"],), (["z"],)], "tokens array<string>")
    vocab = {r.token: r.token_count for r in T.vocabulary_min_count(df).collect()}
    assert vocab == {"x": 2}


def test_ngram_counts_brute_force(spark, corpus):
    toks = T.with_tokens(corpus)
    got = {(r.n, r.ngram): r.ngram_count for r in T.ngram_counts(toks, min_count=1).collect()}
    exp = Counter()
    for r in toks.collect():
        w = r.tokens
        for n in (1, 2, 3):
            for i in range(len(w) - n + 1):
                exp[(n, " ".join(w[i:i + n]))] += 1
    assert got == dict(exp)


def test_prepare_training_rows_sample(spark):
    rows = [(s, t) for s, t in T.SAMPLE_PREPARATION_ROWS]
    df = spark.createDataFrame(rows, "sentiment int, review_body string")
    out = T.prepare_training_rows(df).collect()
    assert [(r.sentiment, r.review_body) for r in out] == [
        ("__label__-1", "i do n't like this product !"),
        ("__label__0", "this product is ok"),
        ("__label__1", "i do like this product !")]


def test_labelled_text_written_without_quotes(spark, corpus, tmp_dir):
    prepared = T.prepare_training_rows(corpus.where("id = 1"))
    path = os.path.join(tmp_dir, "train")
    write_labelled_text(prepared, path, prefixed=True)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["__label__1 great dress love it . great fit !"]


def brute_nb(train_rows, test_rows, min_count=2, alpha=1.0):
    labels = sorted({y for y, _ in train_rows})
    corpus = Counter(t for _, toks in train_rows for t in toks)
    vocab = {t for t, c in corpus.items() if c >= min_count}
    counts = {y: Counter(t for yy, toks in train_rows if yy == y for t in toks if t in vocab) for y in labels}
    n_c = {y: sum(counts[y].values()) for y in labels}
    prior = {y: math.log(sum(1 for yy, _ in train_rows if yy == y) / len(train_rows)) for y in labels}
    preds = []
    for toks in test_rows:
        scores = {y: prior[y] + sum(math.log((counts[y][t] + alpha) / (n_c[y] + alpha * len(vocab)))
                                    for t in toks if t in vocab) for y in labels}
        best = max(scores.values())
        preds.append(min(y for y in labels if scores[y] == best))
    return preds


@pytest.mark.parametrize("max_bytes", [10**6, 0])  # broadcast, then the salted path
def test_naive_bayes_matches_brute_force(spark, corpus, max_bytes):
    data = T.with_tokens(corpus)
    model = nb.fit_naive_bayes(data)
    pred = nb.predict_naive_bayes(model, data, keep=("sentiment",), max_broadcast_bytes=max_bytes)
    got = {r.id: r.prediction for r in pred.collect()}
    rows = data.orderBy("id").collect()
    exp = brute_nb([(r.sentiment, r.tokens) for r in rows], [r.tokens for r in rows])
    assert [got[r.id] for r in rows] == exp
    assert pred.count() == corpus.count()  # the empty review is scored by its prior


def test_long_weights_shape(spark, corpus):
    model = nb.fit_naive_bayes(T.with_tokens(corpus))
    w = model.long_weights()
    assert w.count() == model.vocab_size * 3
    sums = w.groupBy("sentiment").agg(F.sum(F.exp("log_prob")).alias("p")).collect()
    for r in sums:
        assert r.p == pytest.approx(1.0)


def test_nb_probabilities_sum_to_one_and_agree_with_prediction(spark, corpus):
    data = T.with_tokens(corpus)
    model = nb.fit_naive_bayes(data)
    pred = nb.with_probabilities(nb.predict_naive_bayes(model, data), 3).collect()
    for r in pred:
        assert sum(r.probability) == pytest.approx(1.0)
        assert model.labels[max(range(3), key=lambda i: (r.probability[i], -i))] == r.prediction


def test_score_with_naive_bayes_candidate(spark, corpus):
    from revlens.models.candidates import CandidateResult, score_with_candidate
    model = nb.fit_naive_bayes(T.with_tokens(corpus))
    out = score_with_candidate(CandidateResult("naive_bayes", 1.0, model), corpus.select("id", "review_body"))
    assert out.columns == ["id", "review_body", "prediction", "sentiment_name", "probability"]
    assert out.count() == corpus.count()
