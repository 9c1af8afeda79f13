"""Classifiers, language model, search and fingerprints."""

import gc
import math
import tracemalloc
import weakref
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from revlens.llm import attention, attention_lm, simhash, topk
from revlens.llm.attention_lm import lm_scores, words_of
from revlens.llm.bpe import cached_ids
from revlens.llm.oracles import ORACLE_SQL
from revlens.llm.registry import BYTE_BPE
from revlens.llm.toxicity import label_model, toxicity_scores
from revlens.llm.zstd_quality import quality_scores

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,column,folds,out,least", [
    ("op4_toxicity", "toxic", 5, 0, 0.6), ("op5_quality", "quality", 4, 2, 0.97)])
def test_held_out_accuracy(spark, queries, name, column, folds, out, least):
    got = queries[name](spark, SF).cache()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in got.take(50):
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == out) and 0 <= r.score <= 1
    seen = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    hits = [r for r in seen if r[column] == 1]
    assert sum(r.predicted for r in hits) / len(hits) >= least
    assert sum(r.predicted == r[column] for r in seen) / len(seen) >= 0.9


@pytest.mark.parametrize("scores", [toxicity_scores, quality_scores])
def test_classifier_edges(spark, edges, nothing, scores):
    labelled = spark.createDataFrame([(7, 1), (8, 0), (10, 0), (4, None), (None, 1)], "doc_id long, label int")
    got = edges.withColumn("found", scores(edges, labelled)).select("found", "text").collect()
    # Two labelled rows are too few for quality's pairs of dictionaries: null.
    assert len(got) == edges.count() and all(0 <= r.found <= 1 if scores is toxicity_scores else r.found is None for r in got)
    assert len({r.found for r in got if r.text == "one"}) == 1
    assert nothing.withColumn("found", scores(nothing, labelled)).collect() == []


def test_equal_texts_count_once_with_the_majority(spark):
    rows = [(i, "you are a vile fool" if i % 3 else f"calm words {i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = df.select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("label"))
    known = known.withColumn("label", F.when(F.col("doc_id") == 1, 0).otherwise(F.col("label")))  # one dissent
    a, b = ([r.found for r in d.withColumn("found", toxicity_scores(d, known)).orderBy("doc_id").collect()]
            for d in (df.coalesce(1), df.orderBy("text").repartition(5)))
    assert a == b


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.2
    voter = lambda right, cover: np.where(rng.random(4000) < cover, np.where(rng.random(4000) < right, 2 * y - 1, 1 - 2 * y), 0)
    copied = voter(0.7, 0.9)
    votes = np.stack([voter(0.9, 0.8), voter(0.85, 0.7), copied, copied, copied, voter(0.95, 0.9)], 1).astype(float)
    post = label_model(votes, np.where(votes.sum(1) > 0, 0.7, 0.1), 0.2)
    assert ((post > 0.5) == y).mean() > 0.95


def brute_base(rows, n):
    train = [words_of(t) for i, t in rows if zlib.crc32(str(i).encode()) % 10 != 0]
    c = Counter(w for ws in train for w in ws)
    total, distinct = sum(c.values()) + len(train), len(c) + 1
    p = lambda k: math.log10((k + 0.1) / (total + 0.1 * (distinct + 1)))
    return total, {i: (len(words_of(t)) + 1, sum(w in c for w in words_of(t)) + 1,
                       sum(p(c[w]) for w in words_of(t)) + p(len(train))) for i, t in rows}


def test_lm_query(spark, queries):
    got = queries["op7_lm_scoring"](spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    total, want = brute_base(rows, 10)
    assert len(got) == len(rows)
    for r in got:
        n, known, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_edges(edges, nothing):
    from revlens.llm.registry import BYTE_BPE
    import public_tokenizers
    path = public_tokenizers.path(BYTE_BPE)
    got = lm_scores(edges, path, F.lit(False)).collect()
    assert len(got) == edges.count() and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_scores(nothing, path, F.lit(False)).collect() == []
    assert all(math.isfinite(r.score) for r in lm_scores(edges, path, F.lit(True)).collect())


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_lm_layout_and_joined_counts(spark, docs, monkeypatch):
    """Scores depend neither on how rows are split nor on which counts are joined."""
    path = public_tokenizers.path(BYTE_BPE)
    some = docs.where("doc_id < 60").select("doc_id", "text")
    held = F.col("doc_id") % 5 == 0
    monkeypatch.setattr(attention_lm, "SHARD_BYTES", 20_000)  # several shards
    whole = by_id(lm_scores(some.repartition(1), path, held))
    monkeypatch.setattr(attention_lm, "HEAD_WORDS", 30)
    split = by_id(lm_scores(some.repartition(7), path, held))
    for i, r in whole.items():
        assert split[i].score == pytest.approx(r.score, rel=1e-5) and split[i].n_known == r.n_known
        assert split[i].base_score == pytest.approx(r.base_score)


def test_lm_subword_counts(spark, docs):
    path = public_tokenizers.path(BYTE_BPE)
    some = docs.where("doc_id < 60").select("text", (F.col("doc_id") % 5 == 0).alias("held_out"))
    got = attention_lm.subword_counts(attention_lm.count_words(some), path)
    encode, want = cached_ids(path), Counter()
    for r in some.where("not held_out").collect():
        want.update(int(i) for w in words_of(r.text) for i in encode.ordinary(" " + w.decode()))
    assert {int(i): int(got[i]) for i in np.flatnonzero(got)} == dict(want)


def test_shards_grow_with_the_text():
    assert [attention_lm.shard_count(n << 20) for n in (0, 1, 33, 2048, 16384, 1 << 20)] == [1, 1, 2, 64, 64, 4096]


def tables_of(counts, head=(), head_counts=()):
    return attention_lm.Tables(public_tokenizers.path(BYTE_BPE), np.arange(len(counts)), counts, attention.class_edges(counts),
                               np.array(head, np.int64), np.array(head_counts, np.int64))


def test_a_worker_keeps_the_words_of_one_query():
    made = [type("B", (), {"value": tables_of(np.zeros(attention_lm.END_ID + 1))})() for _ in range(2)]
    first = weakref.ref(attention_lm._words_for(made[0]))
    attention_lm._words_for(made[1])
    gc.collect()
    assert first() is None
    attention_lm._words_for.cache_clear()


def test_texts_are_not_held_as_words(monkeypatch):
    """Learning holds the ids of a batch of texts and bounded words."""
    monkeypatch.setattr(attention_lm, "gradient", lambda m, e, ids, want: (0, []))
    words, texts = attention_lm.Words(tables_of(np.zeros(attention_lm.END_ID + 1))), ["some of many more words " * 200] * 500
    steps = type("S", (), {"step": lambda self, parts, n: None})()
    attention_lm._train(None, steps, words, texts[:1])
    tracemalloc.start()
    attention_lm._train(None, steps, words, texts)  # 500,000 words
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 18 << 20


def test_words_are_forgotten_and_learnt_again(monkeypatch):
    """Small memories, runs within a text and unknown words give the same ids, counts and hashes."""
    texts = [None, "", " the cat ", "the dog the\u2003 \u00e9t\u00e9 " * 30, "x" * 500, *(f"w{i} the w{i + 1}" for i in range(50))]
    held = sorted((int(np.uint64(xxhash.xxh3_64_intdigest(w)).astype(np.int64)), n) for w, n in ((b"the", 7), (b"w3", 0)))
    counts = np.zeros(attention_lm.END_ID + 1)
    counts[attention_lm.END_ID] = 9
    tables = tables_of(counts, *zip(*held))
    large = attention_lm.Words(tables).sequences(texts, counted=True)
    monkeypatch.setattr(attention_lm, "RUN", 7)
    monkeypatch.setattr(attention_lm, "MEMORY", 12)
    small = attention_lm.Words(tables)
    for a, b in zip(large, small.sequences(texts, counted=True)):
        assert a.tolist() == b.tolist()
    assert len(small.places) <= 12
    monkeypatch.setattr(attention_lm, "MEMORY_IDS", 3)
    for a, b in zip(large, small.sequences(texts, counted=True)):
        assert a.tolist() == b.tolist()
    encode, own = cached_ids(tables.tokenizer), [words_of(t) for t in texts]
    assert large.words.tolist() == [len(w) + 1 for w in own]
    assert large.tokens.tolist() == [int(i) for ws in own for i in (
        *(i for w in ws for i in encode.ordinary(" " + w.decode())), attention_lm.END_ID)]
    assert large.counts.tolist() == [n for ws in own for n in (*({b"the": 7, b"w3": 0}.get(w, -1) for w in ws), 9)]
    assert all(len(a) == 0 for a in small.sequences([], counted=True))


def test_every_training_token_is_learnt_from(monkeypatch):
    """Whole texts, short and empty ones too, each place wanted once."""
    seen = Counter()
    monkeypatch.setattr(attention_lm, "gradient", lambda m, e, ids, want: seen.update(want[want >= 0].tolist()) or (0, []))
    counts = np.zeros(attention_lm.END_ID + 1)
    number = np.arange(len(counts))
    tables = attention_lm.Tables(public_tokenizers.path(BYTE_BPE), number, counts, attention.class_edges(counts),
                                 np.zeros(0, np.int64), np.zeros(0, np.int64))
    words, texts = attention_lm.Words(tables), [None, "", "one", "a few more words " * 400, "x y " * 20]
    steps = type("S", (), {"step": lambda self, parts, n: None})()
    attention_lm._train(None, steps, words, texts)
    encode = cached_ids(tables.tokenizer)
    want = Counter(int(i) for t in texts for w in words_of(t) for i in encode.ordinary(" " + w.decode()))
    assert seen == want + Counter({attention_lm.END_ID: len(texts)})


def test_tree_average(spark, monkeypatch):
    """Weighted by what each shard gathered; rows that none moved stay away."""
    monkeypatch.setattr(attention_lm, "FAN", 2)
    rng = np.random.default_rng(3)
    rows, total, weights = [], np.zeros((9, 4)), np.zeros(9)
    for shard in range(7):
        at = np.sort(rng.choice(8, 3, replace=False))
        w, v = rng.random(3), rng.random((3, 4))
        total[at] += v
        weights[at] += w
        rows.append((shard, 2, 0, 4, at.astype(np.int32).tobytes(), w.tobytes(), v.tobytes()))
    (got,) = attention_lm.average(spark.createDataFrame(rows, attention_lm._PART), 7)
    at = np.frombuffer(got["rows"], np.int32)
    assert at.tolist() == np.flatnonzero(weights).tolist()
    assert np.allclose(np.frombuffer(got["weight"]), weights[at])
    assert np.allclose(np.frombuffer(got["value"]).reshape(-1, 4), total[at])


def small_model(seed=0):
    rng = np.random.default_rng(seed)
    counts = np.r_[np.arange(100, 0, -1), 0, 0, 0].astype(float)
    edges = attention.class_edges(counts)
    model = attention.Attention.fresh(counts, edges)
    for a in model.arrays():
        a += rng.standard_normal(a.shape).astype(np.float32) * 0.2
    return rng, model, edges


def test_attention_gradient():
    rng, model, edges = small_model()
    lengths = np.array([5, 40, 1])
    tokens, shown = rng.integers(0, 103, (2, 46))
    ids, want = attention.batch_of(tokens, shown, *attention.windows(lengths))
    _, parts = attention.gradient(model, edges, ids, want)
    for a, own in zip(model.arrays(), parts):
        g = np.zeros_like(a)
        for rows, part in own:
            g[rows] += part
        for k in rng.choice(np.flatnonzero(np.abs(g).ravel() > 0.05), 4):
            at, keep = np.unravel_index(k, a.shape), a.ravel()[k]
            a[at] = keep + 1e-2
            up = attention.gradient(model, edges, ids, want)[0]
            a[at] = keep - 1e-2
            down = attention.gradient(model, edges, ids, want)[0]
            a[at] = keep
            assert (up - down) / 2e-2 == pytest.approx(g[at], rel=0.05, abs=0.02)


def test_neighbouring_classes_step_together():
    """Every run once, in rows from its first class to its last; a gap or a
    class much larger than those before it starts rows of its own."""
    edges = np.array([0, 1, 5, 9, 12, 20, 50_000])
    runs = [(1, 0, 3), (2, 3, 4), (4, 4, 9), (5, 9, 10)]
    assert attention._joined(edges, runs) == [
        (slice(1, 9), runs[:2]), (slice(12, 20), [runs[2]]), (slice(20, 50_000), [runs[3]])]
    assert attention._joined(edges, []) == []


def test_attention_scores_are_masked_probabilities():
    """The softmax in two steps sums to one, later tokens don't count, and a
    token's score is the same however texts are batched."""
    rng, model, edges = small_model(1)
    tokens, shown = rng.integers(0, 103, (2, 60))
    scorer = attention.Scorer(model, edges)
    whole = scorer.score(tokens, shown, np.array([60]))
    later = shown.copy()
    later[41:] = 3
    assert np.allclose(whole[:41], scorer.score(tokens, later, np.array([60]))[:41], atol=1e-5)
    total = 0
    for t in range(103):
        last = tokens.copy()
        last[50] = t
        total += math.exp(scorer.score(last, shown, np.array([60]))[50])
    assert total == pytest.approx(1, abs=1e-4)
    pair = scorer.score(np.r_[tokens, tokens[:30]], np.r_[shown, shown[:30]], np.array([60, 30]))
    assert np.allclose(pair, np.r_[whole, whole[:30]], atol=1e-5)
    ids, want = attention.batch_of(tokens, shown, *attention.windows(np.array([60])))
    assert -attention.gradient(model, edges, ids, want)[0] == pytest.approx(whole.sum(), rel=1e-4)


@pytest.mark.parametrize("n", [1, 23, 24, 25, 48, 200])
def test_windows_score_each_token_once(n):
    lengths = np.array([n, 3, n])
    tokens = np.arange(lengths.sum())
    ids, want = attention.batch_of(tokens, tokens, *attention.windows(lengths))
    assert sorted(want[want >= 0].tolist()) == tokens.tolist()
    text = np.repeat(np.arange(3), lengths)
    for row, wanted in zip(ids, want):  # no window shows another text
        assert len({*text[row[row >= 0]], *text[wanted[wanted >= 0]]}) == 1


def test_top_k_query_equals_sql(spark, queries, oracle):
    got = queries["op3_exact_top_k"](spark, "/root/testdata/sf0.001")
    names = ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(oracle(ORACLE_SQL["op3_exact_top_k"]))


def test_top_k_edges_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-3, 4, 6) / 4).tolist()) for i in range(150)]
    rows += [(200, None), (201, []), (202, [1.0, None]), (203, [float("nan")]), (204, [float("inf")]), (5, rows[5][1]),
             (None, [1.0]), (300, [0.0] * 6), (206, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    sound = [(i, np.floor(1024 * np.array(v + [0.0] * (6 - len(v)), float))) for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    got = topk.top_k(df, F.col("vec_id") % 100 == 0, k=10).collect()
    for q in {i for i, _ in sound if i % 100 == 0}:
        v = dict(sound)[q]
        best = sorted((-int(v @ w), i) for i, w in sound if i != q)[:10]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [(r, i, s) for r, i, s in own] == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert topk.top_k(df.limit(0), F.lit(True)).collect() == []


def test_simhash_query(spark, docs, queries):
    import hashlib
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in queries["op10_simhash"](spark, "/root/testdata/sf0.001").collect()}
    by_text = {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[1][:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint and len(r.fingerprint) == 32
        far = lambda a, b: 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 128
        assert r.near_next == pytest.approx(far(r.fingerprint, got[after[0]].fingerprint))
        assert r.near_edited == pytest.approx(far(r.fingerprint, r.edited_fingerprint))
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()]) + 0.08


def test_simhash_runs_stretches_and_edges(spark, edges, nothing, monkeypatch):
    rows = [(i, f"alpha beta {i % 7} gamma") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, simhash.document_fingerprints(df).collect()))
    monkeypatch.setattr(simhash, "RUN_ROWS", 9)
    monkeypatch.setattr(simhash, "STRETCH", 2)
    assert sorted(map(tuple, simhash.document_fingerprints(df).collect())) == whole
    got = simhash.document_fingerprints(edges).collect()
    assert len(got) == edges.count()
    assert {r.fingerprint for r in got if r.n_chars == 0} == {"0" * 32}
    assert simhash.document_fingerprints(nothing).collect() == []


def test_near_pairs_finds_all_within_radius(spark):
    rng = np.random.default_rng(4)
    base = [int(x) for x in rng.integers(0, 1 << 62, 6)]
    prints = set()
    for b in base:
        for _ in range(15):
            flips = rng.choice(128, rng.integers(0, 6), replace=False)
            own = (b << 64) | b
            for f in flips:
                own ^= 1 << int(f)
            prints.add(f"{own:032x}")
    df = spark.createDataFrame([(p,) for p in prints for _ in range(2)], "fingerprint string")
    want = {(a, b) for a in prints for b in prints if a < b and bin(int(a, 16) ^ int(b, 16)).count("1") <= 3}
    assert {(r.a, r.b) for r in simhash.near_pairs(df, 3).collect()} == want
