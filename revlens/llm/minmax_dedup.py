"""Near-duplicate classes by min-max hashing.

Under each permutation both the smallest and the largest value of a
document's shingle set are kept, so a signature of 2k values costs k hash
evaluations.  Bands of the signature propose pairs; every pair is confirmed
on the full sets, and linked documents form components.

Equal sets are one class from the start and only their smallest document
goes on.  Within a band bucket nothing like all pairs is made: a pivot is
compared with the members, the components are merged, and buckets that still
hold several components get four pivots more.  Pairs whose distances to
their bucket's first pivot differ by more than the allowed distance can't be
linked, by the triangle inequality, and are not made.  In buckets that are
open after that (a large class and documents just beyond its reach) the
members outside the largest component are compared with all members in
bounded blocks.

Defined cases: null or word-less texts have an empty set and stay alone;
repeated rows fall in one class; rows of equal id and different texts are
linked by their own texts each, not with one another; rows without an id link
with nothing and have no component; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.components import components
from revlens.llm.shingles import mix, shingle_set
from revlens.llm.tables import cut, prepare

#: A band is the minima and maxima of three permutations; at a similarity of
#: 0.8 a pair escapes all 48 bands with probability (1 - 0.8**6)**48 = 5e-7.
BANDS, PER_BAND = 48, 3
_CHUNK = 2048
#: Pairs that are sent to the sets instead of the sets to them (16 bytes each).
BROADCAST_PAIRS = 50_000
#: Pivots of the last round of pairs; what is open then is compared in blocks
#: of so many members against so many of the others.
PIVOTS = 4
BLOCK_MEMBERS, BLOCK_OTHERS = 2_048, 512


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    odd = rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return odd[:, None], rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]


def signature(own: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Minimum and maximum of a shingle set under each permutation: (n, 2)."""
    x = (own >> np.uint64(32)).astype(np.uint32)[None, :]
    low = high = None
    for at in range(0, x.shape[1], _CHUNK):
        y = factor * x[:, at:at + _CHUNK]
        y += shift
        a, b = y.min(1), y.max(1)
        low = a if low is None else np.minimum(low, a)
        high = b if high is None else np.maximum(high, b)
    return np.stack([low, high], 1)


def band_keys(sign: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band."""
    rows = sign.reshape(bands, -1).astype(np.uint64)
    keys = np.arange(bands, dtype=np.uint64)
    for j in range(rows.shape[1]):
        keys = mix(keys) + rows[:, j]
    return mix(keys).view(np.int64)


def signatures(df: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text",
               bands: int = BANDS, per_band: int = PER_BAND) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands) of every row."""
    def sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factor, shift = _permutations(bands * per_band)
        for part in parts:
            sizes, keys, found = [], [], []
            for own in part["text"]:
                own = shingle_set(own, words)
                sizes.append(len(own))
                keys.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                found.append(band_keys(signature(own, factor, shift), bands) if len(own) else None)
            yield pd.DataFrame({"doc_id": part["doc_id"], "n_shingles": np.array(sizes, np.int64),
                                "set_key": pd.Series(keys, dtype=object, index=part.index),
                                "bands": pd.Series(found, dtype=object, index=part.index)})

    return (df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text"))
            .mapInPandas(sign, "doc_id long, n_shingles long, set_key binary, bands array<long>"))


def full_sets(df: DataFrame, words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, set_key, shingles) of every row with words."""
    def collect(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            own = [shingle_set(t, words) for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"],
                                "set_key": pd.Series([xxhash.xxh3_128_digest(s.tobytes()) for s in own], dtype=object),
                                "shingles": pd.Series([s.view(np.int64) for s in own], dtype=object)})

    return (df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text"))
            .mapInPandas(collect, "doc_id long, set_key binary, shingles array<long>"))


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with the sizes of their sets' intersection and union."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    if pairs.count() <= BROADCAST_PAIRS:
        # The few pairs go to the sets; only the sets they name are moved.
        pairs = F.broadcast(pairs)
        both = pairs.join(left, "a").join(pairs.join(right, "b"), ["a", "b"])
    else:
        both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return (both.select("a", "b", shared.alias("i"), (F.size("of_a") + F.size("of_b")).alias("n"))
            .select("a", "b", "i", (F.col("n") - F.col("i")).alias("u")))


def _stubborn(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) across the components of buckets that stay open.

    Buckets with the same largest component form one group.  Its members
    outside that component are compared with all its members, block against
    block: no pair becomes a row unless it is a link, and a task holds one
    block of either side.  Places are dealt on narrow rows; sets come last.
    """
    sizes = members.groupBy("band", "component").count()
    largest = sizes.groupBy("band").agg(F.max_by("component", F.struct("count", "component")).alias("largest"))
    own = cut(members.select("band", "rep", "component").join(largest, "band")
              .select("largest", "rep", "component").distinct())
    inside = F.col("component") == F.col("largest")
    facts = own.groupBy("largest").agg(
        F.expr(f"(count(*) - 1) div {BLOCK_MEMBERS}").alias("chunks"),
        F.expr(f"(count_if(component != largest) - 1) div {BLOCK_OTHERS}").alias("blocks"))
    place = F.row_number().over(Window.partitionBy("largest").orderBy("rep")) - 1
    every = lambda last: F.explode(F.sequence(F.lit(0).cast("long"), F.col(last)))
    own = own.join(facts, "largest")
    against = own.withColumn("chunk", F.floor(place / BLOCK_MEMBERS)).withColumn("block", every("blocks")).join(sets, "rep")
    others = (own.where(~inside).withColumn("block", F.floor(place / BLOCK_OTHERS))
              .withColumn("chunk", every("chunks")).join(sets, "rep"))
    columns = ["largest", "block", "chunk", "rep", "component", "shingles"]

    def compare(_, u: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(u) and len(m):
            flat = np.concatenate(m["shingles"].to_list())
            known, flat = np.unique(flat, return_inverse=True)
            n = m["shingles"].map(len).to_numpy()
            starts = np.cumsum(n) - n
            reps, comps = m["rep"].to_numpy(), m["component"].to_numpy()
            for rep, comp, own in zip(u["rep"], u["component"], u["shingles"]):
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                mark = np.zeros(len(known), np.int64)
                mark[at[known[at] == own]] = 1
                both = np.add.reduceat(mark[flat], starts)
                near = (both * 100 >= (len(own) + n - both) * percent) & (comps != comp)
                found += [(min(rep, r), max(rep, r)) for r in reps[near].tolist()]
        return pd.DataFrame(sorted(set(found)), columns=["a", "b"], dtype="int64")

    keys = ("largest", "block", "chunk")
    others = others.select(*(F.col(c).alias(c) for c in columns))  # told apart from the members' columns
    return (others.groupBy(*keys).cogroup(against.select(columns).groupBy(*keys))
            .applyInPandas(compare, "a long, b long").distinct())


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``df``."""
    prepare(df.sparkSession)
    signed = cut(signatures(df, words, doc_id, text))
    # A class of equal sets: its smallest document stands for it.
    classes = cut(signed.where("set_key is not null and doc_id is not null").groupBy("set_key")
                  .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                       F.first("bands").alias("bands")))
    rows = classes.select("rep", "n", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("in_band")).where("in_band > 1").select("band")
    members = cut(rows.join(shared, "band").select("band", "rep", "n"))
    involved = members.select("rep").distinct()
    chosen = classes.join(involved, "rep", "left_semi").select("set_key", F.col("rep").alias("doc_id"))
    text_of = df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text"))
    sets = cut(full_sets(text_of.join(chosen, "doc_id", "left_semi"), words)
               .dropDuplicates(["doc_id", "set_key"]).join(chosen, ["doc_id", "set_key"])
               .select(F.col("doc_id").alias("rep"), "shingles"))

    label = members.select(F.col("rep").alias("node")).distinct().withColumn("component", F.col("node"))
    # What is known of each member's Jaccard distance to its bucket's first pivot.
    members = members.withColumns({"least": F.lit(0.0), "most": F.lit(1.0)})
    reach = 1 - percent / 100 + 1e-9
    tested, pivots = None, 1
    while True:
        labelled = members.join(label.withColumnRenamed("node", "rep"), "rep")
        open_bands = (labelled.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                      .where("x < y").select("band"))
        members = cut(labelled.join(open_bands, "band", "left_semi")
                      .withColumn("place", F.row_number().over(Window.partitionBy("band").orderBy("rep")))
                      .select("band", "rep", "n", "component", "least", "most", "place"))
        if members.isEmpty():
            break
        last = pivots > PIVOTS
        if last:
            new = cut(_stubborn(members, sets, percent))
        else:
            first = members.where(F.col("place") <= pivots).select(
                "band", F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("of_a"),
                F.col("least").alias("least_a"), F.col("most").alias("most_a"), F.col("place").alias("at"))
            alike = F.least("n", "n_a") * 100 >= F.greatest("n", "n_a") * percent
            # Distances obey the triangle inequality.
            close = (F.col("least") - F.col("most_a") <= reach) & (F.col("least_a") - F.col("most") <= reach)
            pairs = (members.join(first, "band")
                     .where((F.col("place") > F.col("at")) & (F.col("component") != F.col("of_a")) & alike & close)
                     .select("a", F.col("rep").alias("b")).distinct())
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            tested = pairs = cut(pairs)
            seen = cut(_compared(pairs, sets))
            new = seen.where(F.col("i") * 100 >= F.col("u") * percent).select("a", "b")
        if not new.isEmpty():
            # Only the new links, between the components so far, are followed.
            ends = label.withColumnRenamed("component", "of")
            edges = (new.join(ends.select(F.col("node").alias("a"), F.col("of").alias("x")), "a")
                     .join(ends.select(F.col("node").alias("b"), F.col("of").alias("y")), "b")
                     .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct())
            found = components(edges).select(F.col("node").alias("component"), F.col("component").alias("better"))
            label = cut(label.join(found, "component", "left")
                        .select("node", F.coalesce("better", "component").alias("component")))
        if last:
            break
        rest = members.where(F.col("place") > pivots)  # a pivot has met every member of its bucket
        if pivots == 1:
            far = 1 - F.col("i") / F.col("u")
            by_size = 1 - F.least("n", "n_a") / F.greatest("n", "n_a")
            rest = (rest.join(first.select("band", "a", "n_a"), "band")
                    .join(seen.withColumnRenamed("b", "rep"), ["a", "rep"], "left")
                    .select("band", "rep", "n", F.coalesce(far, by_size).alias("least"),
                            F.coalesce(far, F.lit(1.0)).alias("most")))
        members = rest.select("band", "rep", "n", "least", "most")
        pivots *= 4

    named = classes.join(label.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_key", F.coalesce("component", "rep").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (signed.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.col("doc_id").eqNullSafe(component).alias("kept")))
