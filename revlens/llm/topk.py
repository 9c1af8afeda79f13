"""Exact top-k inner-product search by the threshold algorithm.

Candidates are dealt over blocks.  Each block keeps one sorted list per
dimension; a query walks all lists in step (from the end that raises its
score), scores every newly met candidate in full, and stops when the score
that an unseen candidate could still reach is below its k-th best.  The
blocks' best are merged per query.

Defined cases: a vector that is null, empty, or holds a null or non-finite
component takes no part; vectors of different lengths are compared as if the
missing components were 0; repeated rows are candidates each, but never of a
query with their id; an empty table gives no rows; ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revlens.llm.tables import cut, prepare

#: Candidates of one block, queries that a task takes at once.
BLOCK_ROWS, QUERY_ROWS = 8_192, 2_048
#: Entries read from each list in one step; doubled step by step.
DEPTH = 16
_SCALE = 1024


def scaled(vec: str) -> F.Column:
    """floor(1024 * x) of every component; null for vectors that take no part."""
    x = F.col(vec).cast("array<double>")
    sound = F.size(x) > 0
    fits = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(sound & fits, F.transform(x, lambda v: F.floor(v * F.lit(float(_SCALE))).cast("double")))


class SortedLists:
    """The lists of one block of candidates."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.down = np.argsort(-self.rows, axis=0, kind="stable")  # list d: candidates by falling component d

    def best(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best candidates, own id left out."""
        n = len(self.ids)
        used = np.flatnonzero(query)
        falling = query[used] > 0
        score = np.full(n, -np.inf)
        seen = self.ids == own
        depth, step = 0, DEPTH
        while depth < n and len(used):
            to = min(n, depth + step)
            met = np.concatenate([self.down[depth:to, used[falling]].ravel(),
                                  self.down[n - to:n - depth, used[~falling]].ravel()])
            fresh = np.unique(met[~seen[met]])
            seen[fresh] = True
            score[fresh] = self.rows[fresh] @ query
            edge = np.where(falling, self.rows[self.down[to - 1, used], used],
                            self.rows[self.down[n - to, used], used])
            if n > k and np.partition(score, n - k)[n - k] > edge @ query[used]:
                break
            depth, step = to, step * 2
        if not len(used):
            score[~seen] = 0
        found = np.flatnonzero(score > -np.inf)
        top = found[np.lexsort((self.ids[found], -score[found]))[:k]]
        return self.ids[top], score[top]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def top_k(df: DataFrame, is_query: F.Column, k: int = 10, vec_id: str = "vec_id",
          vec: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of every query against all other rows."""
    prepare(df.sparkSession)
    own = cut(df.select(df[vec_id].cast("long").alias("id"), scaled(vec).alias("v"),
                        F.coalesce(is_query, F.lit(False)).alias("asks"))
              .where("v is not null and id is not null"))
    n, asked = own.agg(F.count("*"), F.count_if("asks")).first()
    blocks, batches = max(1, -(-n // BLOCK_ROWS)), max(1, -(-asked // QUERY_ROWS))
    # Every candidate block meets every batch of queries once.
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")
    batch = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(batches)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    candidates = own.select(block.alias("block"), "id", "v").withColumn("batch", every(batches))
    queries = own.where("asks").select(batch.alias("batch"), "id", "v").withColumn("block", every(blocks))

    def search(_, asks: pd.DataFrame, against: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asks) and len(against):
            width = max(asks["v"].map(len).max(), against["v"].map(len).max())
            lists = SortedLists(against["id"].to_numpy(), _matrix(against["v"], width))
            for q, v in zip(asks["id"].to_numpy(), _matrix(asks["v"], width)):
                ids, scores = lists.best(q, v, k)
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids, "score": scores.astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    met = (queries.groupBy("block", "batch").cogroup(candidates.groupBy("block", "batch"))
           .applyInPandas(search, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
