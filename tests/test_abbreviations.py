"""Abbreviation scores against the formula; planted ones are found and kept."""

import math
import re
from collections import Counter

import pytest

from revlens.operators import abbreviations as ab, text as T

TEXTS = [f"Dr. Smith met Mr. Jones at {i} p.m. on the road. It was late. The road was wet, they said." for i in range(30)]
TEXTS += ["The end... is near. They met late", "see the Dr.", None, "", "... 12. 3.5", "they late wet said near end it was road on"]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, review_body string")


def plain():
    n = {True: Counter(), False: Counter()}
    for t in TEXTS:
        for token in re.split(r"\s+", (t or "").lower()):
            m = re.match(r"^[^a-z]*([a-z]+(?:\.[a-z]+)*)(\.?)[^a-z.]*$", token)
            if m:
                n[m[2] == "."][m[1]] += 1
    p = sum(n[True].values()) / (sum(n[True].values()) + sum(n[False].values()))
    out = {}
    for w, a in n[True].items():
        b, letters = n[False][w], len(w.replace(".", ""))
        ll = -2 * ((a * math.log(p) + b * math.log(1 - p)) - (a * math.log(0.99) + b * math.log(1 - 0.99)))
        out[w] = (a, b, ll * math.exp(-letters) * (w.count(".") + 1) * letters ** -float(b))
    return out


def test_scores_equal_the_formula(corpus):
    got = {r.word: (r.n_period, r.n_plain, r.score) for r in ab.abbreviation_scores(corpus.repartition(3)).collect()}
    want = plain()
    assert got.keys() == want.keys()
    for w in want:
        assert got[w][:2] == want[w][:2] and got[w][2] == pytest.approx(want[w][2], rel=1e-9, abs=1e-12)


def test_planted_abbreviations_keep_their_period(corpus):
    found = ab.abbreviations(ab.abbreviation_scores(corpus))
    assert {"dr", "mr", "p.m"} <= set(found) and not {"road", "late", "said"} & set(found)
    rows = {r.id: r.tokens for r in ab.keep_abbreviation_periods(T.with_tokens(corpus), found).collect()}
    assert rows[0] == "dr. smith met mr. jones at 0 p.m. on the road . it was late . the road was wet they said .".split()
    assert rows[31] == ["see", "the", "dr", "."]  # it ends the text
    assert rows[32] is None and rows[33] == []


def test_without_abbreviations_nothing_changes(spark, corpus):
    tokens = T.with_tokens(corpus)
    assert ab.keep_abbreviation_periods(tokens, []) is tokens
    assert ab.abbreviation_scores(corpus.limit(0)).collect() == []
    only = spark.createDataFrame([("a. b.",)], "review_body string")
    assert {r.score for r in ab.abbreviation_scores(only).collect()} == {None}
    with pytest.raises(ValueError):
        ab.abbreviations(ab.abbreviation_scores(corpus), most=0)
