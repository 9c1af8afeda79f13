"""Near-duplicate classes and repeated spans against brute force."""

import random
import re
from itertools import combinations

import numpy as np

from revlens.llm import minmax_dedup, span_dedup
from revlens.llm.components import components
from revlens.llm.minmax_dedup import near_duplicates
from revlens.llm.oracles import ORACLE_SQL
from revlens.llm.shingles import shingle_set


def word_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def classes(rows, size, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(word_set(t, size))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: find(i) for i in sets}


def family(rnd, base, n, most):
    words = [f"w{rnd.randint(0, 400)}" for _ in range(base)]
    out = []
    for _ in range(n):
        own = list(words)
        for _ in range(rnd.randint(0, most)):
            own[rnd.randrange(base)] = f"x{rnd.randint(0, 60)}"
        out.append(" ".join(own))
    return out


def test_query_equals_sql(spark, queries, oracle):
    got = queries["op1_minmax_near_dedup"](spark, "/root/testdata/sf0.001")
    names = ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(oracle(ORACLE_SQL["op1_minmax_near_dedup"]))


def test_borderline_families_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minmax_dedup, "BLOCK_MEMBERS", 16)
    monkeypatch.setattr(minmax_dedup, "BLOCK_OTHERS", 4)
    rnd = random.Random(7)
    texts = family(rnd, 60, 70, 12) + family(rnd, 40, 30, 6) + family(rnd, 8, 20, 2) + ["a", "a", "b", ""]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for size in (2, 5):
        got = {r.doc_id: r.component_id for r in near_duplicates(df, size, 80).collect()}
        assert got == classes(rows, size, 80)


def test_edges(edges, nothing):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_duplicates(edges, 2, 80).collect()}
    assert got[1, 0] == (1, True) and got[2, 0] == (2, True) and got[3, 0] == (3, True)
    assert got[4, 1] == (4, True) and got[5, 1] == (4, False)
    assert got[8, 5] == (7, False) and got[None, 3] == (None, True)
    assert near_duplicates(nothing, 2, 80).collect() == []


def test_shingles():
    assert len(shingle_set("A b a  B", 2)) == len(word_set("A b a  B", 2)) == 3
    assert (shingle_set("A B", 2) == shingle_set("a\tb", 2)).all() and len(shingle_set(None, 2)) == 0
    assert (shingle_set("one", 2) != shingle_set("two", 2)).all()


def test_min_and_max_estimate_similarity():
    rng = np.random.default_rng(0)
    both = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    factor, shift = minmax_dedup._permutations(400)
    a, b = minmax_dedup.signature(both[:900], factor, shift), minmax_dedup.signature(both[100:], factor, shift)
    assert abs((a == b).mean() - 0.8) < 0.06 and a.shape == (400, 2)


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 55), (70, 70)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert set(got[i] for i in range(1, 41)) == {1} and {got[50], got[55], got[60]} == {50} and got[70] == 70


def brute_spans(rows):
    first, out = {}, {}
    for i, t in sorted(rows):
        for h, a, b in span_dedup.runs(t or "", 2, 12):
            first.setdefault(h, (i, a))
    for i, t in rows:
        gone = {s for h, a, b in span_dedup.runs(t or "", 2, 12) if first[h] != (i, a) for s in range(a, b)}
        out[i] = (t, gone)
    return out


def test_spans_equal_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute_spans(rows)
    got = {r.doc_id: r for r in span_dedup.span_dedup(docs).collect()}
    assert len(got) == len(rows) and any(g for _, g in want.values())
    for i, (t, gone) in want.items():
        cuts = span_dedup.sentences(t)
        kept = "".join(t[a:b] for s, (a, b) in enumerate(cuts) if s not in gone)
        assert got[i].text == (kept.rstrip() if gone else t)
        assert (got[i].n_removed, got[i].n_sentences) == (len(gone), len(cuts))


def all_runs(rows, least_sentences, least_words):
    """Sentences of each row in a run, of any length, that stands earlier too."""
    first, found, out = {}, [], {}
    for i, t in sorted(rows):
        own = [tuple(t[a:b].lower().split()) for a, b in span_dedup.sentences(t)]
        for a in range(len(own)):
            for b in range(a + least_sentences, len(own) + 1):
                if sum(map(len, own[a:b])) >= least_words:
                    first.setdefault(tuple(own[a:b]), (i, a))
                    found.append((i, a, b, tuple(own[a:b])))
    for i, a, b, run in found:
        if first[run] != (i, a):
            out.setdefault(i, set()).update(range(a, b))
    return out


def test_every_repeated_run_goes_whole(spark):
    rnd = random.Random(5)
    stock = [" ".join(rnd.choice("abcdefghij") * 3 + str(k) for _ in range(rnd.choice([1, 1, 2, 5, 10, 12]))) + ". "
             for k in range(60)]
    passages = [[rnd.choice(stock) for _ in range(rnd.randint(2, 7))] for _ in range(25)]
    rows = []
    for i in range(80):
        parts = [rnd.choice([rnd.choice(passages), [f"Own {i} {k}. "], [rnd.choice(stock)]]) for k in range(4)]
        rows.append((i, "".join(x for part in parts for x in part)))
    for i, tail in ((90, (12, 1, 1)), (92, (10, 5, 5))):
        passage = "".join(" ".join(f"w{i}x{k}x{j}" for j in range(n)) + ". " for k, n in enumerate(tail))
        rows += [(i, passage + "One end."), (i + 1, passage + "Another end.")]
    want = all_runs(rows, 2, 12)
    got = {r.doc_id: r for r in span_dedup.span_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        cuts = span_dedup.sentences(t)
        kept = "".join(t[a:b] for s, (a, b) in enumerate(cuts) if s not in want.get(i, ()))
        assert got[i].text.strip() == kept.strip() and got[i].n_removed == len(want.get(i, ()))
    assert got[91].text == got[93].text == "Another end."


def test_long_sentences_go_in_parts(spark):
    rnd = random.Random(8)
    line = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    whole, inner, tail = line(60), line(120), line(80)
    rows = [(1, whole), (2, whole.upper()), (3, f"Start {line(9)}. {whole}. Other end"), (4, line(40)),
            (5, f"{line(30)} {inner} {line(30)}."), (6, f"{line(45)} {inner} {line(5)}."),
            (7, f"Good whole sentence {line(8)}. {tail}"), (8, f"Good whole sentence {line(8)}. {tail} {line(30)}.")]
    got = {r.doc_id: r.text for r in span_dedup.span_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in (1, 4, 5, 7):
        assert got[i] == rows[i - 1][1]
    assert got[2] == ""
    assert len(set(got[3].split()) & set(whole.split())) <= span_dedup.LONG  # its last word has a full stop here
    assert len(set(got[6].split()) & set(inner.split())) <= 2 * span_dedup.LONG
    assert len(set(got[8].split()) & set(tail.split())) <= span_dedup.LONG
    assert "".join(rows[4][1][a:b] for a, b in span_dedup.sentences(rows[4][1])) == rows[4][1]
    assert max(len(rows[4][1][a:b].split()) for a, b in span_dedup.sentences(rows[4][1])) <= span_dedup.LONG


def test_planted_passage_goes_except_first(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    line = lambda n: " ".join(word() for _ in range(n)) + ". "
    passage = "".join(line(11) for _ in range(6))
    rows = [(i, line(20) + line(9) + (passage if i % 3 == 0 else "") + line(15)) for i in range(12)]
    got = {r.doc_id: r.text for r in span_dedup.span_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        if i and i % 3 == 0:
            assert passage.strip() not in got[i] and t.split(". ")[0] in got[i]
        else:
            assert got[i] == t


def test_span_edges(edges, nothing):
    got = span_dedup.span_dedup(edges)
    assert got.columns == [*edges.columns, "n_sentences", "n_removed"]
    assert got.count() == edges.count()
    assert {r.text for r in got.where("doc_id in (1, 2, 4)").collect()} == {None, "", "one"}
    assert span_dedup.span_dedup(nothing).collect() == []
