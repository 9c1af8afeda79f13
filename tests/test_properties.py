"""Property test: the histogram/threshold selection equals a brute-force
row_number() <= quota over md5(id:seed) order, for random inputs."""

import hashlib

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from revlens.operators import sampling


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    ids=st.lists(st.integers(min_value=-10**6, max_value=10**6), min_size=1, max_size=400, unique=True),
    n_groups=st.integers(min_value=1, max_value=4),
    quotas=st.lists(st.integers(min_value=0, max_value=300), min_size=4, max_size=4),
    digits=st.integers(min_value=1, max_value=3),
    seed=st.integers(min_value=0, max_value=1000),
    rank_limit=st.sampled_from([1, 4, 50, 10**6]),
)
def test_flag_first_rows_equals_brute_force(spark, ids, n_groups, quotas, digits, seed, rank_limit):
    rows = [(i, f"g{abs(i) % n_groups}") for i in ids]
    df = spark.createDataFrame(rows, "id bigint, grp string")
    k = sampling.hash_histogram(df, ["grp"], "id", seed, digits)
    quota = None
    for g in range(n_groups):
        cond = F.col("grp") == f"g{g}"
        quota = F.when(cond, F.lit(quotas[g])) if quota is None else quota.when(cond, F.lit(quotas[g]))
    got = {r.id for r in sampling.flag_first_rows(k, quota, rank_limit=rank_limit)
           .where("_selected").collect()}

    def key(i):
        return (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i)
    exp = set()
    for g in range(n_groups):
        members = sorted((i for i, grp in rows if grp == f"g{g}"), key=key)
        exp |= set(members[:quotas[g]])
    assert got == exp
