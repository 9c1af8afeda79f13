"""Edge tables: empty input, single category, null keys."""

import pytest

from revlens.operators import bias, cleaning, naive_bayes as nb, profile, sampling, text as T

SCHEMA = "id bigint, sentiment int, review_body string, product_category string"


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_input_everywhere(spark, empty):
    assert cleaning.rare_category_filter(empty).count() == 0
    assert profile.count_by_category_sentiment(empty).count() == 0
    assert profile.sentiment_pct_by_category(empty).count() == 0
    assert profile.min_cell_size(empty).first().min_cell_size is None
    d = profile.word_count_describe(empty).first()
    assert d["count"] == 0 and d["mean"] is None
    assert sum(r.frequency for r in profile.word_count_histogram(empty).collect()) == 0
    assert bias.bias_report(empty).count() == 0
    assert sampling.balance_by_downsampling(empty).count() == 0
    assert sampling.stratified_split(empty).count() == 0
    assert T.vocabulary_min_count(T.with_tokens(empty)).count() == 0


def test_single_category_balance_and_pct(spark):
    rows = [(i, s, "w", "only") for i, s in enumerate([1, 1, 1, 0, -1, -1])]
    df = spark.createDataFrame(rows, SCHEMA)
    bal = sampling.balance_by_downsampling(df)
    assert sorted(r.sentiment for r in bal.collect()) == [-1, 0, 1]
    pct = profile.sentiment_pct_by_category(df).first()
    assert pct.pct_positive == pytest.approx(50.0)


def test_null_sentiment_excluded_from_split_and_bias(spark):
    rows = [(i, None if i % 7 == 0 else i % 2, "w", "c" if i % 3 else "d") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    split = sampling.stratified_split(df)
    assert split.count() == sum(1 for r in rows if r[1] is not None)
    total = sum(1 for r in rows if r[1] is not None)
    val = split.where("split = 'validation'").count()
    import math
    assert val == math.ceil(0.1 * total)


def test_naive_bayes_single_label(spark):
    rows = [(1, 1, "good good", "c"), (2, 1, "good", "c")]
    data = T.with_tokens(spark.createDataFrame(rows, SCHEMA))
    m = nb.fit_naive_bayes(data)
    assert [r.prediction for r in nb.predict_naive_bayes(m, data).collect()] == [1, 1]
