"""Bias configuration: facets by name or number, string labels, thresholds."""

import pytest

from revlens.operators.bias import bias_report, bias_report_from_config, column_of
from revlens.session import scratch_path
from revlens.sources.config import BiasConfig, read_bias_config, write_bias_config

ROWS = [("yes", "a", 1.0, 1), ("no", "a", 2.0, 2), ("yes", "b", 3.0, 3), ("yes", "b", 4.0, 1),
        ("no", "c", 5.0, 2), ("yes", None, 6.0, 3), (None, "a", 7.0, 1), ("no", "c", None, 1)]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "answer string, shop string, price double, stars int")


def config(spark, **own):
    made = {"label": "answer", "label_values_or_threshold": ["yes"], "facet": [{"name_or_index": "shop"}],
            "methods": {"pre_training_bias": {"methods": ["CI", "DPL"]}}} | own
    return read_bias_config(spark, write_bias_config(spark, scratch_path(spark, "config"), made))


def rows_of(report):
    return {(r["facet"], r["facet_value"]): (r["ci"], r["dpl"]) for r in report.collect()}


def test_string_label(spark, df):
    want = {(r["facet_value"]): (r["ci"], r["dpl"]) for r in
            bias_report(df, "answer", "shop", ["yes"], ["CI", "DPL"]).collect()}
    got = rows_of(bias_report_from_config(df, config(spark)))
    assert got == {("shop", k): v for k, v in want.items()} and len(got) == 3
    assert got[("shop", "b")] == ((4 - 2) / 6, 1 / 4 - 1)  # counted by hand: others are yes, no, no, no


def test_facet_and_label_by_number_in_data_and_headers(spark, df):
    want = rows_of(bias_report_from_config(df, config(spark)))
    assert rows_of(bias_report_from_config(df, config(spark, label="0", facet=[{"name_or_index": 1}]))) == want
    named = config(spark, headers=["stars", "shop", "answer"], label="2", facet=[{"name_or_index": 1}])
    assert rows_of(bias_report_from_config(df, named)) == want
    with pytest.raises(ValueError, match="no column"):
        column_of(df, 9)
    assert column_of(df.withColumnRenamed("stars", "1"), "1") == "1"


def test_integer_labels_are_spelled_or_numbers(spark, df):
    a = rows_of(bias_report_from_config(df, config(spark, label="stars", label_values_or_threshold=[1, 3])))
    b = rows_of(bias_report_from_config(df, config(spark, label="stars", label_values_or_threshold=["1", "3"])))
    plain = {("shop", r["facet_value"]): (r["ci"], r["dpl"]) for r in
             bias_report(df, "stars", "shop", [1, 3], ["CI", "DPL"]).collect()}
    assert a == b == plain


def test_fractional_label_takes_a_threshold(spark, df):
    got = rows_of(bias_report_from_config(df, config(spark, label="price", label_values_or_threshold=[2.5])))
    # Shop a: 1, 2, 7 (one above); the others with a shop and a price: 3, 4, 5 (all above).
    assert got[("shop", "a")] == (0.0, pytest.approx(1 - 1 / 3))
    with pytest.raises(ValueError, match="one threshold"):
        bias_report_from_config(df, config(spark, label="price", label_values_or_threshold=[1, 2]))


def test_facet_values_and_thresholds_make_one_group(spark, df):
    several = config(spark, facet=[{"name_or_index": "shop", "value_or_threshold": ["a", "b"]},
                                   {"name_or_index": "price", "value_or_threshold": [3.5]},
                                   {"name_or_index": "stars", "value_or_threshold": [1]}])
    got = rows_of(bias_report_from_config(df, several))
    assert set(got) == {("shop", "a,b"), ("price", ">3.5"), ("stars", "1")}
    assert got[("shop", "a,b")] == ((2 - 4) / 6, 0 - 3 / 4)
    # Above 3.5: yes, no, yes; at most 3.5: yes, no, yes; null prices and answers take no part.
    assert got[("price", ">3.5")] == (0.0, 0.0)
    assert got[("stars", "1")] == ((4 - 3) / 7, 2 / 4 - 2 / 3)


def test_no_facets_empty_table_and_label_as_facet(spark, df):
    assert bias_report_from_config(df, BiasConfig("answer", ["yes"], [], ["CI"])).count() == 0
    assert bias_report_from_config(df.limit(0), config(spark)).count() == 0
    with pytest.raises(ValueError, match="label and a facet"):
        bias_report_from_config(df, config(spark, facet=[{"name_or_index": "answer"}]))


def test_all_facets_from_one_read(spark):
    """Equal to a report per facet; the rows are read once for all."""
    data = [(i, i % 2, f"c{i % 5}", i % 3, "x" if i % 7 else None) for i in range(200)]
    df = spark.createDataFrame(data, "id int, sentiment int, product_category string, kind int, odd string")
    read = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            read.add(len(part))
            yield part

    facets = ["product_category", "kind", "odd"]
    cfg = BiasConfig(**{**vars(config(spark)), "label": "sentiment", "positive_values": [1], "headers": [],
                        "facets": facets, "facet_values": [None] * 3})
    got = {(r.facet, r.facet_value): r for r in bias_report_from_config(df.mapInPandas(count, df.schema), cfg).collect()}
    assert read.value == len(data)
    want = {(f, r.facet_value): r for f in facets for r in bias_report(df, "sentiment", f, [1], cfg.methods).collect()}
    assert set(got) == set(want)
    for k, r in want.items():
        assert {m: v for m, v in got[k].asDict().items() if m in r.asDict()} == r.asDict()
