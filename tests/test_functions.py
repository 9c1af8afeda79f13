from pyspark.sql import functions as F

from revlens.functions import (
    add_label_prefix, rating_to_sentiment, seeded_hash, strip_label_prefix, tokenize_text,
    tokens_of, word_count, word_ngrams,
)
from revlens.functions.sentiment import sentiment_name


def test_rating_to_sentiment_edges(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (5.0,), (0.0,), (6.0,), (4.5,), (None,)],
                               "r double")
    got = [r[0] for r in df.select(rating_to_sentiment("r")).collect()]
    assert got == [-1, -1, 0, 1, 1, None, None, None, None]
    assert dict(df.select(rating_to_sentiment("r").alias("s")).dtypes)["s"] == "int"


def test_sentiment_names(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (None,)], "s int")
    assert [r[0] for r in df.select(sentiment_name("s")).collect()] == [
        "Negative", "Neutral", "Positive", None]


def test_word_count_literal_single_space_split(spark):
    w256 = " ".join(["w"] * 256)
    w257 = " ".join(["w"] * 257)
    df = spark.createDataFrame([("",), ("a  b ",), (None,), ("one",), (w256,), (w257,)], "t string")
    got = [r[0] for r in df.select(word_count("t")).collect()]
    assert got == [1, 4, None, 1, 256, 257]
    same = df.select(F.size(F.split("t", " ", -1)).cast("bigint")).collect()
    assert [r[0] for r in same][:2] == [1, 4]


def test_tokenizer_golden_sentences(spark):
    cases = {
        "I'm not a fan of this product!": "i 'm not a fan of this product !",
        "I don't like this product!": "i do n't like this product !",
        "OK, but not great.": "ok but not great .",
        "this product is ok": "this product is ok",
        'He said "hi"... then -- left; (really)': "he said hi ... then -- left ; ( really )",
        "I cannot do it: now": "i can not do it : now",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = dict(df.select("t", tokenize_text("t").alias("tok")).collect())
    assert got == cases


def test_tokens_of_empty_and_null(spark):
    df = spark.createDataFrame([("",), ("a b",), (None,)], "t string")
    got = [r[0] for r in df.select(tokens_of("t")).collect()]
    assert got == [[], ["a", "b"], None]


def test_word_ngrams_short_arrays(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    got = [r[0] for r in df.select(word_ngrams("w", 2)).collect()]
    assert got == [["a b", "b c"], [], []]
    got3 = [r[0] for r in df.select(word_ngrams("w", 3)).collect()]
    assert got3 == [["a b c"], [], []]


def test_label_prefix_idempotent_and_true_prefix(spark):
    df = spark.createDataFrame([("1",), ("__label__1",), ("able",), ("-1",)], "y string")
    out = df.select(add_label_prefix("y").alias("p")).select(
        "p", add_label_prefix("p").alias("pp"), strip_label_prefix("p").alias("s")).collect()
    assert [r.p for r in out] == ["__label__1", "__label__1", "__label__able", "__label__-1"]
    assert all(r.p == r.pp for r in out)
    assert [r.s for r in out] == ["1", "1", "able", "-1"]


def test_seeded_hash_matches_python_md5(spark):
    import hashlib
    df = spark.createDataFrame([(12,), (7,)], "id bigint")
    got = [r[0] for r in df.select(seeded_hash("id", 42)).collect()]
    assert got == [hashlib.md5(f"{i}:42".encode()).hexdigest() for i in (12, 7)]
