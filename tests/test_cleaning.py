import os

import pytest
from pyspark.sql import functions as F

from revlens.operators import cleaning
from revlens.sources.csv_io import read_raw_reviews

RAW_HEADER = (",Clothing ID,Age,Title,Review Text,Rating,Recommended IND,"
              "Positive Feedback Count,Division Name,Department Name,Class Name\n")


def write_raw_csv(path, rows):
    with open(path, "w") as fh:
        fh.write(RAW_HEADER)
        for i, (text, rating, cls) in enumerate(rows):
            fh.write(f'{i},1,30,t,{text},{rating},1,0,D,Dep,{cls}\n')


def test_raw_csv_quotes_newlines_and_na(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw.csv")
    write_raw_csv(path, [
        ('"Fits well, love it"', "5", "Dresses"),
        ('"He said ""wow"""', "4", "Dresses"),
        ('"line one\nline two"', "3", "Knits"),
        ("NA", "2", "Knits"),
        ("None", "1", "Knits"),
        ('""', "5", "Knits"),
        ("plain", "NA", "Knits"),
    ])
    raw = read_raw_reviews(spark, path)
    assert raw.count() == 7
    assert "_c0" not in raw.columns and raw.columns[0] == "Clothing ID"
    rows = raw.select("Review Text", "Rating").collect()
    assert rows[0][0] == "Fits well, love it"
    assert rows[1][0] == 'He said "wow"'
    assert rows[2][0] == "line one\nline two"
    assert rows[3][0] is None and rows[4][0] is None and rows[5][0] is None
    assert rows[6][1] is None
    clean = cleaning.clean_raw_reviews(raw.union(raw).union(raw).union(raw))
    # complete rows per copy: Dresses 2, Knits 1 -> 8 and 4 rows, both <= 10
    assert clean.count() == 0
    many = raw
    for _ in range(5):
        many = many.union(raw)
    out = cleaning.clean_raw_reviews(many)
    assert out.columns == ["sentiment", "review_body", "product_category"]
    # six copies: Dresses 12 rows (kept), Knits 6 rows (dropped)
    assert sorted(r[0] for r in out.groupBy("product_category").count().collect()) == ["Dresses"]
    assert out.count() == 12


def test_missing_drop_column_is_an_error(spark):
    df = spark.createDataFrame([(1, "x")], "`Clothing ID` int, `Review Text` string")
    with pytest.raises(ValueError):
        cleaning.rename_raw_columns(df)


def test_rare_filter_strictly_more_than_ten(spark):
    rows = ([("ten", i) for i in range(10)] + [("eleven", i) for i in range(11)]
            + [(None, i) for i in range(20)])
    df = spark.createDataFrame(rows, "product_category string, id int")
    out = cleaning.rare_category_filter(df)
    assert [r[0] for r in out.select("product_category").distinct().collect()] == ["eleven"]
    assert out.count() == 11


def test_null_sentiment_rows_are_kept_and_counted(spark):
    rows = [(6, "x", "c")] * 3 + [(5, "y", "c")] * 8
    df = spark.createDataFrame(rows, "star_rating int, review_body string, product_category string")
    out = cleaning.clean_reviews(df)
    assert out.count() == 11
    assert out.where(F.col("sentiment").isNull()).count() == 3


def test_rare_filter_plan_shuffles_only_counts(spark):
    from revlens.sources.tables import reviews
    df = cleaning.rare_category_filter(reviews(spark, "/root/testdata/sf0.001"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_stage_shapes_and_preview(spark):
    from revlens.sources.tables import reviews
    r = reviews(spark, "/root/testdata/sf0.01")
    shapes = {row.stage: (row.n_rows, row.n_cols) for row in cleaning.stage_shapes(r).collect()}
    assert shapes["raw"] == (1000, 5)
    assert shapes["dropna"] == (399, 3)
    assert shapes["final"][0] <= 399
    prev = cleaning.preview(cleaning.clean_reviews(r, keep_columns=["id"]), "id").collect()
    assert len(prev) == 5 and [p.id for p in prev] == sorted(p.id for p in prev)


def test_rare_filter_large_path(spark):
    rows = [("ten", i) for i in range(10)] + [("eleven", i) for i in range(11)]
    df = spark.createDataFrame(rows, "product_category string, id int")
    out = cleaning.rare_category_filter(df, max_broadcast_rows=0)
    assert out.count() == 11
