import hashlib
import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import sampling


def md5key(i, seed=42):
    return (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i)


def brute_first_k(rows, k_of):
    """rows: (id, group) -> set of ids that are among the first k of their group."""
    by = {}
    for i, g in rows:
        by.setdefault(g, []).append(i)
    chosen = set()
    for g, ids in by.items():
        chosen |= set(sorted(ids, key=md5key)[:k_of(g, len(ids))])
    return chosen


def test_balance_equals_brute_force_with_hot_group(spark):
    rnd = random.Random(7)
    rows = []
    i = 0
    sizes = {("hot", 1): 30000, ("hot", 0): 700, ("cold", 1): 650, ("cold", -1): 900}
    for (c, s), n in sizes.items():
        for _ in range(n):
            rows.append((i, c, s))
            i += rnd.randint(1, 3)
    df = spark.createDataFrame(rows, "id bigint, product_category string, sentiment int")
    out = sampling.balance_by_downsampling(df)
    got = {r.id for r in out.select("id").collect()}
    k = min(sizes.values())
    exp = brute_first_k([(r[0], (r[1], r[2])) for r in rows], lambda g, n: k)
    assert got == exp
    cells = {(r[0], r[1]): r[2] for r in out.groupBy("product_category", "sentiment").count().collect()}
    assert set(cells.values()) == {k}


def test_flag_first_rows_small_buckets_force_boundary_ranking(spark):
    rows = [(i, "g" if i % 5 else "h") for i in range(5000)]
    df = spark.createDataFrame(rows, "id bigint, grp string")
    for digits in (1, 2, 4):
        k = sampling.hash_histogram(df, ["grp"], "id", 42, digits)
        quotas = spark.createDataFrame([("g", 1234), ("h", 7)], "grp string, quota bigint")
        got = {r.id for r in sampling.flag_first_rows(k, quotas).where("_selected").collect()}
        exp = brute_first_k(rows, lambda g, n: 1234 if g == "g" else 7)
        assert got == exp


def test_balance_drops_null_keys_and_handles_empty(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "a", None), (3, "a", 1), (4, "a", 0)],
                               "id bigint, product_category string, sentiment int")
    out = sampling.balance_by_downsampling(df)
    assert sorted(r.id for r in out.collect()) == [3, 4]
    empty = spark.createDataFrame([], "id bigint, product_category string, sentiment int")
    assert sampling.balance_by_downsampling(empty).count() == 0


def sklearn_like_train_counts(counts, test_size):
    import math
    n = sum(counts.values())
    n_train = n - math.ceil(test_size * n)
    labels = sorted(counts)
    cont = [counts[c] / n * n_train for c in labels]
    fl = [math.floor(x) for x in cont]
    need = n_train - sum(fl)
    rem = sorted(range(len(labels)), key=lambda j: (-(cont[j] - fl[j]), labels[j]))
    for j in rem[:need]:
        fl[j] += 1
    return dict(zip(labels, fl))


@pytest.mark.parametrize("counts", [{-1: 58, 0: 42, 1: 299}, {0: 10, 1: 20}, {0: 3, 1: 27, 2: 1000}])
def test_allocation(counts):
    alloc = sampling.allocate_train_quotas(list(counts.items()), 0.1)
    exp = sklearn_like_train_counts(counts, 0.1)
    assert {c: t for c, (t, _) in alloc.items()} == exp
    assert all(t + v == counts[c] for c, (t, v) in alloc.items())


def test_stratified_split_quotas_and_disjoint(spark):
    from revlens.plans.datasets import clean_fixture_reviews
    df = clean_fixture_reviews(spark, "/root/testdata/sf0.01")
    out = sampling.stratified_split(df)
    val = {r.sentiment: r[1] for r in out.where("split = 'validation'").groupBy("sentiment").count().collect()}
    assert val == {-1: 6, 0: 4, 1: 30}
    assert out.count() == df.count() == out.select("id").distinct().count()


def test_split_rejects_tiny_class(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id bigint, sentiment int")
    with pytest.raises(ValueError):
        sampling.stratified_split(df)


def test_balance_fixture_sizes(spark):
    from revlens.plans.datasets import clean_fixture_reviews, clean_order_reviews
    assert sampling.balance_by_downsampling(clean_fixture_reviews(spark, "/root/testdata/sf0.01")).count() == 24
    assert sampling.balance_by_downsampling(clean_order_reviews(spark, "/root/testdata/sf0.01")).count() == 8655


def test_boundary_only_shuffles_one_bucket(spark):
    rows = [(i, "g") for i in range(20000)]
    df = spark.createDataFrame(rows, "id bigint, grp string")
    k = sampling.hash_histogram(df, ["grp"], "id", 42, 2)
    assert k.hist.count() == 256
    biggest = k.hist.agg(F.max("_n")).first()[0]
    assert biggest < 200  # a boundary bucket holds ~1/256 of the group


def test_balance_plan_moves_no_data_rows(spark):
    """The final plan decides each row by broadcast joins against the small
    threshold and boundary tables: no window and no hash exchange over the
    data."""
    from revlens.plans.datasets import clean_order_reviews
    out = sampling.balance_by_downsampling(clean_order_reviews(spark, "/root/testdata/sf0.001"))
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "Exchange hashpartitioning" not in plan
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 2


def test_large_path_equals_small_path(spark):
    """With the local-copy limit forced to 0 every small table is
    checkpointed and joined by shuffle -- the path taken at scale."""
    rows = [(i, "g" if i % 4 else "h") for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, grp string")
    k = sampling.hash_histogram(df, ["grp"], "id", 42, 2)
    quota = F.when(F.col("grp") == "g", F.lit(700)).otherwise(F.lit(31))
    small = {r.id for r in sampling.flag_first_rows(k, quota).where("_selected").collect()}
    large = {r.id for r in sampling.flag_first_rows(k, quota, max_broadcast_rows=0)
             .where("_selected").collect()}
    assert small == large == brute_first_k(rows, lambda g, n: 700 if g == "g" else 31)


@pytest.mark.parametrize("rank_limit,max_rows", [(3, 10**5), (1, 10**5), (3, 0)])
def test_refinement_levels_equal_brute_force(spark, rank_limit, max_rows):
    """A tiny rank limit forces several refinement levels (2 -> 4 -> 6 ...
    hex digits); max_rows=0 also takes the checkpoint/shuffle path."""
    rows = [(i, "g" if i % 3 else "h") for i in range(4000)]
    df = spark.createDataFrame(rows, "id bigint, grp string")
    k = sampling.hash_histogram(df, ["grp"], "id", 42, 1)
    quota = F.when(F.col("grp") == "g", F.lit(1111)).otherwise(F.lit(257))
    got = {r.id for r in sampling.flag_first_rows(k, quota, max_broadcast_rows=max_rows,
                                                  rank_limit=rank_limit)
           .where("_selected").collect()}
    assert got == brute_first_k(rows, lambda g, n: 1111 if g == "g" else 257)
