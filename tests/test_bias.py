import json
import math
import os

import pytest

from revlens.operators import bias, sampling
from revlens.sources.config import DEFAULT_BIAS_CONFIG as CONFIG, read_bias_config

def brute_force(rows, facet_value, positive=(1,)):
    d = [y for f, y in rows if f == facet_value]
    a = [y for f, y in rows if f != facet_value]
    labels = sorted({y for _, y in rows})
    pd_ = {y: d.count(y) / len(d) for y in labels}
    pa_ = {y: a.count(y) / len(a) for y in labels}
    ci = (len(a) - len(d)) / (len(a) + len(d))
    dpl = sum(a.count(y) for y in positive) / len(a) - sum(d.count(y) for y in positive) / len(d)

    def kl(p, q):
        s = 0.0
        for y in labels:
            if p[y] > 0:
                s += math.inf if q[y] == 0 else p[y] * math.log(p[y] / q[y])
        return s
    m = {y: (pa_[y] + pd_[y]) / 2 for y in labels}
    diffs = [pa_[y] - pd_[y] for y in labels]
    return {"ci": ci, "dpl": dpl, "kl": kl(pa_, pd_), "js": (kl(pa_, m) + kl(pd_, m)) / 2,
            "lp": math.sqrt(sum(x * x for x in diffs)), "tvd": sum(abs(x) for x in diffs) / 2,
            "ks": max(abs(x) for x in diffs)}


@pytest.fixture
def rows():
    return ([("a", 1)] * 30 + [("a", 0)] * 5 + [("a", -1)] * 5 + [("b", 1)] * 10 + [("b", -1)] * 10
            + [("c", 1)] * 4 + [("c", 0)] * 1)


def test_metrics_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "product_category string, sentiment int")
    out = {r.facet_value: r.asDict() for r in bias.bias_report(df).collect()}
    for f in ("a", "b", "c"):
        exp = brute_force(rows, f)
        for k, v in exp.items():
            assert out[f][k] == pytest.approx(v, rel=1e-12, abs=1e-12), (f, k)


def test_invariants(spark, rows):
    df = spark.createDataFrame(rows, "product_category string, sentiment int")
    for r in bias.bias_report(df).collect():
        assert -1 <= r.ci <= 1
        assert 0 <= r.js <= math.log(2) + 1e-12
        assert r.ks <= r.tvd + 1e-12
        assert r.kl >= 0 and r.lp >= 0


def test_kl_infinite_when_facet_lacks_a_label(spark):
    rows = [("a", 1)] * 5 + [("a", 0)] * 5 + [("b", 1)] * 4
    df = spark.createDataFrame(rows, "product_category string, sentiment int")
    out = {r.facet_value: r for r in bias.bias_report(df).collect()}
    assert out["b"].kl == math.inf          # P_a(0) > 0 = P_d(0)
    assert math.isfinite(out["a"].kl)       # a has every label b has


def test_single_category_gives_null_distances(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0)], "product_category string, sentiment int")
    r = bias.bias_report(df).first()
    assert r.ci == -1.0 and r.dpl is None and r.kl is None and r.ks is None


def test_empty_input(spark):
    df = spark.createDataFrame([], "product_category string, sentiment int")
    assert bias.bias_report(df).count() == 0


def test_balanced_data_has_zero_distances(spark):
    rows = []
    for f, n in (("a", 40), ("b", 17), ("c", 9)):
        for y in (-1, 0, 1):
            rows += [(f, y)] * (n + y + 1)
    df = spark.createDataFrame([(i, f, y) for i, (f, y) in enumerate(rows)],
                               "id bigint, product_category string, sentiment int")
    bal = sampling.balance_by_downsampling(df)
    k = 3
    for r in bias.bias_report(bal).collect():
        assert r.ci == pytest.approx((k - 2) / k)
        for m in ("dpl", "kl", "js", "lp", "tvd", "ks"):
            assert getattr(r, m) == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("pretty", [True, False])
def test_config_driven_report(spark, tmp_dir, rows, pretty):
    path = os.path.join(tmp_dir, "config.json")
    with open(path, "w") as fh:
        json.dump(CONFIG, fh, indent=4 if pretty else None)
    cfg = read_bias_config(spark, path)
    assert cfg.label == "sentiment" and cfg.facets == ["product_category"]
    assert cfg.positive_values == [1] and cfg.methods == bias.ALL_METHODS
    cfg.methods = ["CI", "KS"]
    df = spark.createDataFrame(rows, "product_category string, sentiment int")
    rep = bias.bias_report_from_config(df, cfg)
    assert rep.columns == ["facet", "facet_value", "ci", "ks", "report"]
    out_path = os.path.join(tmp_dir, "report", "unbalanced")
    rep.write.mode("overwrite").json(out_path)
    assert spark.read.json(out_path).count() == 3


def test_fixture_values(spark):
    from revlens.plans.datasets import clean_fixture_reviews
    r = {x.facet_value: x for x in bias.bias_report(
        clean_fixture_reviews(spark, "/root/testdata/sf0.01")).collect()}["de"]
    assert round(r.ci, 6) == 0.769424 and round(r.dpl, 6) == 0.060722
    assert round(r.kl, 6) == 0.011844 and round(r.js, 6) == 0.003079
    assert round(r.lp, 6) == 0.083266 and round(r.tvd, 6) == 0.060722


def test_bias_large_path_equals_small_path(spark, rows):
    df = spark.createDataFrame(rows, "product_category string, sentiment int")
    a = sorted(bias.bias_report(df).collect())
    b = sorted(bias.bias_report(df, max_local_rows=0).collect())
    assert a == b
