"""Importance resampling against the formula, its SQL and a full sort."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from revlens.llm import resampling
from revlens.llm.oracles import ORACLE_SQL
from revlens.llm.resampling import cutoff, importance_resample, words_of

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def plain(docs, target, percent, least, buckets, runs, seed):
    def features(text):
        w = plain_words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, runs + 1) for i in range(len(w) - n + 1)]
    own, other = Counter(), Counter()
    for _, t in docs:
        own.update(features(t))
    for t in target:
        other.update(features(t))
    s_all, t_all = sum(own.values()), sum(other.values())
    gain = [math.floor(1000 * math.log((other[b] + 1.0) * (s_all + buckets) / ((own[b] + 1.0) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for i, t in docs:
        f = features(t)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(t))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def test_words():
    for text in (None, "", "A1 b_c-D", "é日本 X\x7fy", "ÀB  z"):
        assert [w.decode() for w in words_of(text)] == plain_words(text)


def test_query_equals_sql(spark, queries):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE_SQL['op12_importance_resampling']})").fetchall()
    got = queries["op12_importance_resampling"](spark, SF).select(COLUMNS).collect()
    assert sorted(map(key, got)) == sorted(map(key, want))


@pytest.mark.parametrize("runs, percent", [(1, 10), (2, 50), (3, 100)])
def test_edges_equal_the_formula(spark, edges, runs, percent):
    target = [None, "one two", "The Of and"]
    df = edges.select("doc_id", "text", "score", "rep", edges.lang.alias("rank"))
    got = importance_resample(df, spark.createDataFrame([(t,) for t in target], "text string"),
                              percent=percent, min_words=2, buckets=97, runs=runs)
    want = plain([(r.doc_id, r.text) for r in edges.collect()], target, percent, 2, 97, runs, 2024)
    assert sorted(map(key, got.select(COLUMNS).collect())) == sorted(map(key, want))


def test_empty_tables(spark, nothing, edges):
    target = nothing.select("text")
    assert importance_resample(nothing, target).collect() == []
    got = importance_resample(edges, target, min_words=1, percent=50)
    want = plain([(r.doc_id, r.text) for r in edges.collect()], [], 50, 1, 10_000, 1, 2024)
    assert sorted(map(key, got.select(COLUMNS).collect())) == sorted(map(key, want))


@pytest.mark.parametrize("spread", [1, 3, 40, 10**6])
def test_cutoff_equals_a_full_sort(spark, spread):
    """Few scores make brackets of one score, which are cut by id."""
    rnd = random.Random(spread)
    rows = [(rnd.randrange(spread), i) for i in rnd.sample(range(10**6), 3000)]
    df = spark.createDataFrame(rows, "score long, doc_id long").repartition(5).cache()
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    for take in (1, 2, 299, 1500, 2999, 3000):
        assert cutoff(df, take, 3000, sorted_rows=20) == order[take - 1]
    df.unpersist()


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    rows = [(i % 50, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "score long, doc_id long")
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    calls = []

    def wrong(rows, by, rank, n, error):
        calls.append(error)
        return -10**9, -10**9 + 1
    monkeypatch.setattr(resampling, "_sketched", wrong)
    assert cutoff(df, 700, 2000, sorted_rows=20) == order[699]
    assert len(set(calls)) > 1  # each bracket is widened before it is halved


def test_repeated_rows_at_the_cutoff(spark):
    df = spark.createDataFrame([(5, 1)] * 60 + [(9, 2)], "score long, doc_id long")
    assert cutoff(df, 30, 61, sorted_rows=10) == (5, 1)
    docs = spark.createDataFrame([(1, "same words here")] * 40, "doc_id long, text string")
    got = importance_resample(docs, docs.select("text"), percent=25, min_words=1)
    assert sorted(r.rank for r in got.where("rank is not null").collect()) == list(range(1, 11))
    assert got.count() == 40
