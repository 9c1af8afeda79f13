"""Exact, seeded, skew-proof selection of the first ``quota`` rows per group.

Rows are ordered inside their group by ``md5(id || ':' || seed)`` (ties by
id), which Spark and DuckDB compute alike.  A plain
``row_number() OVER (PARTITION BY group ...)`` would sort a whole group in
one task; with one group holding a third of all rows that task becomes the
job.  Instead the hash space is cut into ordered buckets (its leading hex
digits sort like the hash):

0. *narrow*: (id, group columns, hash) of every row, written once; callers
   that already have such rows pass them.  All steps but the last read these
   rows, so the data with its texts is read once here and once for the answer;
1. *histogram*: rows per (group, leading ``digits`` hex digits) -- a
   partial aggregation, at most groups x 16**digits small rows, kept as a
   local relation when proved small, else checkpointed;
2. *thresholds*: a running sum over each group's buckets finds the bucket
   holding the quota boundary and how many of its rows are still needed;
3. *refine*: while a boundary bucket holds more than ``rank_limit`` rows,
   only the rows of those buckets are histogrammed again on two more hex
   digits (each level shrinks a bucket 256-fold), so a hot group of any
   size ends with a bounded bucket;
4. *boundary*: the rows of the last boundary bucket per group are ranked,
   which gives each group the (hash, id) of the last row it takes;
5. *flag*: every row is compared with its group's thresholds through
   (size-proved) broadcast joins -- no shuffle of the data itself.

The result equals ``row_number() <= quota`` over the same ordering.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from revlens.functions.hashing import DEFAULT_SEED, hash_bucket, seeded_hash
from revlens.operators.joins import LOCAL_COPY_ROWS, small_local_copy
from revlens.session import ensure_checkpoint_dir

HASH_DIGITS = 2        # first histogram level: 256 buckets per group
STEP_DIGITS = 2        # each refinement: 256 sub-buckets of a boundary bucket
MAX_DIGITS = 32        # md5 hex length
RANK_LIMIT = 1_000_000 # rows of one boundary bucket ranked in one task
_HELPERS = ["_h", "_b"]


@dataclass
class Keyed:
    data: DataFrame        # input rows + _h (hash) + _b (first-level bucket)
    narrow: DataFrame      # id, group cols, _h, written once
    hist: DataFrame        # group cols, _b, _n  (local relation or checkpoint)
    groups: list
    id_col: str
    digits: int = HASH_DIGITS
    rows: list | None = None   # hist, where proved small


def narrow_rows(df: DataFrame, cols, id_col: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """(id, ``cols``, hash) of every row, written to the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.select(id_col, *cols, seeded_hash(id_col, seed).alias("_h")).checkpoint(eager=True)


def hash_histogram(df: DataFrame, groups, id_col: str = "id", seed: int = DEFAULT_SEED,
                   digits: int = HASH_DIGITS, narrow: DataFrame | None = None) -> Keyed:
    groups = list(groups)
    keyed = (df.withColumn("_h", seeded_hash(id_col, seed))
             .withColumn("_b", hash_bucket("_h", digits)))
    if narrow is None:
        narrow = narrow_rows(df, groups, id_col, seed)
    hist, rows = small_local_copy(narrow.groupBy(*groups, hash_bucket("_h", digits).alias("_b"))
                               .agg(F.count(F.lit(1)).alias("_n")))
    return Keyed(keyed, narrow, hist, groups, id_col, digits, rows)


def group_sizes(k: Keyed) -> DataFrame:
    return k.hist.groupBy(*k.groups).agg(F.sum("_n").cast("bigint").alias("group_rows"))


def _local_sizes(k: Keyed) -> dict:
    """Rows per group from a histogram that is at hand."""
    sizes: dict = {}
    for r in k.rows:
        key = tuple(r[c] for c in k.groups)
        sizes[key] = sizes.get(key, 0) + r["_n"]
    return sizes


def _local_thresholds(k: Keyed, quotas: dict):
    """``_thresholds`` of a histogram that is at hand; ``quotas`` by group."""
    fields = ["_b_star", "_r", "_n_star", "_full"]
    types = {f.name: f.dataType.simpleString() for f in k.hist.schema}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in k.groups), f"_b_star {types['_b']}",
                        "_r bigint", "_n_star bigint", "_full boolean"])
    found, before = {}, {}
    for r in sorted(k.rows, key=lambda r: r["_b"]):
        key = tuple(r[c] for c in k.groups)
        start = before.get(key, 0)
        before[key] = start + r["_n"]
        quota = quotas.get(key, 0)
        if start < quota:  # the last bucket that starts under the quota
            taken = min(quota - start, r["_n"])
            found[key] = (r["_b"], taken, r["_n"], taken == r["_n"])
    rows = [dict(zip([*k.groups, *fields], (*key, *v))) for key, v in found.items()]
    spark = k.hist.sparkSession
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema), rows


def _thresholds(hist: DataFrame, g: list, quota, max_rows: int):
    """Per group with a positive quota: boundary bucket ``_b_star``, rows
    still needed from it ``_r``, its size ``_n_star`` and whether it is taken
    whole (``_full``).  Returns (DataFrame, local rows or None)."""
    running = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*g)
    if isinstance(quota, DataFrame):
        h = hist.join(quota.select(*g, "quota"), g, "inner")
    else:
        h = hist.withColumn("quota", quota.cast("bigint"))
    cum = (h.withColumn("_cum", F.sum("_n").over(running))
           .withColumn("_total", F.sum("_n").over(whole))
           .withColumn("_q", F.least(F.col("quota"), F.col("_total")))
           .withColumn("_before", F.col("_cum") - F.col("_n")))
    return small_local_copy(
        cum.where((F.col("_before") < F.col("_q")) & (F.col("_q") <= F.col("_cum")))
        .select(*g, F.col("_b").alias("_b_star"),
                (F.col("_q") - F.col("_before")).alias("_r"),
                F.col("_n").alias("_n_star"),
                ((F.col("_q") - F.col("_before")) == F.col("_n")).alias("_full")),
        max_rows)


def flag_first_rows(k: Keyed, quota, flag: str = "_selected",
                    max_broadcast_rows: int = LOCAL_COPY_ROWS,
                    rank_limit: int = RANK_LIMIT, quotas: dict | None = None) -> DataFrame:
    """Add boolean ``flag``: row is among the first ``quota`` rows of its group.

    ``quota`` is a Column over the group columns (a literal, or a CASE over
    a few labels) or a DataFrame of group columns + ``quota``; groups
    without a quota get none selected.  ``quotas`` says the same by group
    tuple; with it a small histogram needs no job.
    """
    g = k.groups

    def side(df, rows):
        return F.broadcast(df) if rows is not None else df

    levels = []  # (digits, thresholds, local rows)
    if k.rows is not None and quotas is not None and len(k.rows) <= max_broadcast_rows:
        th, rows = _local_thresholds(k, quotas)
    else:
        th, rows = _thresholds(k.hist, g, quota, max_broadcast_rows)
    digits = k.digits
    levels.append((digits, th, rows))
    boundary = None
    while True:
        partial = th.where(~F.col("_full"))
        if rows is not None:
            open_rows = [r for r in rows if not r["_full"]]
            biggest = max((r["_n_star"] for r in open_rows), default=None)
        else:
            biggest = partial.agg(F.max("_n_star")).first()[0]
        if biggest is None:
            break
        cut = side(partial.select(*g, F.col("_b_star").alias("_cut"), "_r"), rows)
        in_cut = (k.narrow.select(k.id_col, *g, "_h")
                  .join(cut, g, "inner")
                  .where(hash_bucket("_h", digits) == F.col("_cut")))
        if biggest <= rank_limit or digits + STEP_DIGITS > MAX_DIGITS:
            rank = Window.partitionBy(*g).orderBy("_h", k.id_col)
            # One row per group: the last one taken of its boundary bucket.
            boundary, b_rows = small_local_copy(
                in_cut.withColumn("_rn", F.row_number().over(rank))
                .where(F.col("_rn") == F.col("_r"))
                .select(*g, F.struct(F.col("_h").alias("h"), F.col(k.id_col).alias("id")).alias("_last")),
                max_broadcast_rows)
            boundary = side(boundary, b_rows)
            break
        # Refine only the rows of the boundary buckets on more hex digits.
        digits += STEP_DIGITS
        sub_hist, _ = small_local_copy(
            in_cut.groupBy(*g, hash_bucket("_h", digits).alias("_b"))
            .agg(F.count(F.lit(1)).alias("_n")), max_broadcast_rows)
        th, rows = _thresholds(sub_hist, g, partial.select(*g, F.col("_r").alias("quota")),
                               max_broadcast_rows)
        levels.append((digits, th, rows))

    out = k.data
    for i, (d, t, r) in enumerate(levels):
        out = out.join(side(t.select(*g, F.col("_b_star").alias(f"_bs{i}"),
                                     F.col("_full").alias(f"_fl{i}")), r), g, "left")
    if boundary is not None:
        out = out.join(boundary, g, "left")
    # Innermost level first: inside the last boundary bucket a row is chosen
    # when the bucket is taken whole or the row was ranked in.
    last = len(levels) - 1
    d_last = levels[last][0]
    at_last = hash_bucket("_h", d_last) == F.col(f"_bs{last}")
    chosen = F.col(f"_fl{last}")
    if boundary is not None:
        own = F.struct(F.col("_h").alias("h"), F.col(k.id_col).alias("id"))
        chosen = chosen | F.coalesce(own <= F.col("_last"), F.lit(False))
    chosen = (hash_bucket("_h", d_last) < F.col(f"_bs{last}")) | (at_last & chosen)
    for i in range(last - 1, -1, -1):
        p = hash_bucket("_h", levels[i][0])
        chosen = (p < F.col(f"_bs{i}")) | ((p == F.col(f"_bs{i}")) & (F.col(f"_fl{i}") | chosen))
    out = out.withColumn(flag, F.coalesce(chosen, F.lit(False)))
    helpers = [f"_bs{i}" for i in range(len(levels))] + [f"_fl{i}" for i in range(len(levels))]
    return out.drop(*helpers, "_last", *_HELPERS)


def _not_null(df: DataFrame, cols) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def balance_by_downsampling(df: DataFrame, groups=("product_category", "sentiment"),
                            id_col: str = "id", seed: int = DEFAULT_SEED,
                            narrow: DataFrame | None = None) -> DataFrame:
    """From every observed group draw (without replacement, seeded) as many
    rows as the smallest group holds.  Rows with a null key are dropped.

    ``narrow``: ``narrow_rows`` of the same rows and seed, if already there."""
    groups = list(groups)
    k = hash_histogram(_not_null(df, groups), groups, id_col, seed,
                       narrow=None if narrow is None else _not_null(narrow, groups))
    quotas = None
    if k.rows is not None:
        sizes = _local_sizes(k)
        smallest = min(sizes.values(), default=None)
        quotas = dict.fromkeys(sizes, smallest)
    else:
        smallest = group_sizes(k).agg(F.min("group_rows")).first()[0]
    if smallest is None:  # empty input
        return k.data.drop(*_HELPERS)
    return (flag_first_rows(k, F.lit(int(smallest)), quotas=quotas).where(F.col("_selected"))
            .drop("_selected"))


def allocate_train_quotas(class_counts: list[tuple], test_size: float = 0.1) -> dict:
    """Per-class train/validation sizes of a stratified split.

    n_test = ceil(test_size * n) (double arithmetic); train sizes are the
    floor of the proportional share of n_train, the remainder going to the
    largest fractional parts (ties: smaller label); validation takes the
    rest of each class.
    """
    labels = sorted(c for c, _ in class_counts)
    counts = dict(class_counts)
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    if n_train <= 0 or n_test <= 0:
        raise ValueError(f"test_size={test_size} leaves an empty part of {n} rows")
    cont = {c: counts[c] / n * n_train for c in labels}
    floor = {c: math.floor(v) for c, v in cont.items()}
    need = n_train - sum(floor.values())
    order = sorted(labels, key=lambda c: (-(cont[c] - floor[c]), c))
    for c in order[:need]:
        floor[c] += 1
    return {c: (floor[c], counts[c] - floor[c]) for c in labels}


def stratified_split(df: DataFrame, label: str = "sentiment", test_size: float = 0.1,
                     id_col: str = "id", seed: int = DEFAULT_SEED, split_col: str = "split",
                     min_class_rows: int = 2, max_classes: int = 1000,
                     narrow: DataFrame | None = None) -> DataFrame:
    """Exact stratified train/validation split; adds ``split_col`` with
    values ``train`` / ``validation``.  Null labels are dropped.

    ``narrow``: ``narrow_rows`` of the same rows and seed, if already there."""
    k = hash_histogram(_not_null(df, [label]), [label], id_col, seed,
                       narrow=None if narrow is None else _not_null(narrow, [label]))
    if k.rows is not None:
        counts = [(key[0], n) for key, n in _local_sizes(k).items()]
    else:
        counts = [(r[label], int(r["group_rows"])) for r in group_sizes(k).limit(max_classes + 1).collect()]
    if len(counts) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label}")
    small = [c for c, n in counts if n < min_class_rows]
    if small:
        raise ValueError(f"classes with fewer than {min_class_rows} rows: {small}")
    if not counts:
        return k.data.drop(*_HELPERS).withColumn(split_col, F.lit(None).cast("string"))
    alloc = allocate_train_quotas(counts, test_size)
    # Validation quota per class as a CASE over the (few, checked) labels.
    quota = None
    for c, (_, v) in alloc.items():
        quota = (F.when(F.col(label) == F.lit(c), F.lit(v)) if quota is None
                 else quota.when(F.col(label) == F.lit(c), F.lit(v)))
    flagged = flag_first_rows(k, quota, "_validation", quotas={(c,): v for c, (_, v) in alloc.items()})
    return (flagged.withColumn(split_col, F.when(F.col("_validation"), F.lit("validation"))
                               .otherwise(F.lit("train")))
            .drop("_validation"))
