"""Spelling variants against plain edits and SQL."""

import random
import re
import zlib
from collections import Counter

import pytest

from revlens.llm import spelling
from revlens.llm.fm_index import BidirectionalIndex, near_words
from revlens.llm.oracles import ORACLE_SQL
from revlens.llm.spelling import near_pairs, roots, spelling_variants, word_counts

SF = "/root/testdata/sf0.001"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def vocabulary(seed, n, letters="abé", least=6, most=9):
    rnd = random.Random(seed)
    return sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(least, most))) for _ in range(n)})


@pytest.mark.parametrize("seed", range(6))
def test_searches_find_every_pair_once(seed):
    words = vocabulary(seed, 250) + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "bbbabbb", "日本日本日本", "日本日本日"]
    words = sorted(set(words))
    queries = words + vocabulary(seed + 100, 60, "abc")
    found = [near_words(words, queries, side) for side in (True, False)]
    both = found[0] + found[1]
    assert len(both) == len(set(both))
    assert set(both) == {(q, w) for q, a in enumerate(queries) for w, b in enumerate(words) if one_apart(a, b)}


def test_intervals_of_both_directions_agree():
    import numpy as np
    words = vocabulary(3, 80)
    index = BidirectionalIndex(words, sorted(set("".join(words))))
    text = "$" + "$".join(words)
    cyclic = text * 2
    rnd = random.Random(1)
    for _ in range(200):
        at, n = rnd.randrange(len(text)), rnd.randint(1, 6)
        pattern = cyclic[at:at + n]
        cut = rnd.randint(0, n)
        codes = [index.codes.get(c, 0) for c in pattern]
        low = other = np.zeros(1, np.int64)
        size = np.array([index.length])
        for c in codes[cut:]:  # to the right from the cut, then to the left
            new, size, smaller = index.right.step(other, size, np.array([c]))
            low, other = low + smaller, new
        for c in reversed(codes[:cut]):
            new, size, smaller = index.left.step(low, size, np.array([c]))
            low, other = new, other + smaller
        starts = {i for i in range(len(text)) if cyclic[i:i + n] == pattern}
        assert set(index.left.starts[low[0]:low[0] + size[0]].tolist()) == starts
        ends = {(len(text) - 1 - (i + n - 1)) % len(text) for i in starts}
        assert set(index.right.starts[other[0]:other[0] + size[0]].tolist()) == ends


def test_hot_beginnings_are_cut_into_blocks(spark):
    words = [f"abc{w}" for w in vocabulary(1, 300, "abc", 3, 6)] + [f"{w}xyz" for w in vocabulary(2, 200, "abc", 3, 5)]
    words = sorted(set(words))
    df = spark.createDataFrame([(w, 1 + k) for k, w in enumerate(words)], "word string, n long")
    got = [(r.word, r.near, r.n, r.near_n) for r in near_pairs(df, bin_words=20).collect()]
    n = {w: 1 + k for k, w in enumerate(words)}
    want = {(a, b, n[a], n[b]) for a in words for b in words if one_apart(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


def test_roots(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(9)] + [("x", "y")]
    got = dict(roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert got == {f"w{i}": "w9" for i in range(9)} | {"x": "y"}


def plain(rows, least, least_n, every, ratio):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= least and k >= least_n}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MEMORY", 50)
    rnd = random.Random(5)
    words = vocabulary(9, 60, "abÉé", 5, 8)
    rows = [(i if i % 9 else None, " ".join(rnd.choice(words[:1 + rnd.randrange(len(words))]).upper() for _ in range(80)) + "×÷ ß1aĀb")
            for i in range(60)] + [(1, None), (2, ""), (3, "abcdefg " * 2000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n long")
    got = spelling_variants(df.repartition(3), every=7)
    assert got.columns == COLUMNS
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(rows, 6, 5, 7, 5)))


def test_query_equals_sql(spark, queries, oracle):
    got = queries["op13_spelling_variants"](spark, SF).select(COLUMNS).collect()
    want = oracle(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE_SQL['op13_spelling_variants']})")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_edges(spark, edges, nothing):
    assert spelling_variants(nothing).collect() == []
    assert spelling_variants(edges.where("doc_id < 4")).collect() == []
    assert word_counts(edges, least_n=1).where("n < 1").isEmpty()
    with pytest.raises(ValueError):
        spelling_variants(nothing, least=5)
