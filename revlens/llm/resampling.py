"""Importance resampling of documents towards a target distribution.

Features are runs of words hashed into buckets.  The bucket counts of all
documents and of all target texts give every bucket a gain; a document's
weight is the mean gain of its features, looked up in one array.  Weight plus
Gumbel noise of the id is the score, and the highest scores are a draw
without replacement.

The cutoff is found without a sort of all rows: a quantile sketch gives a
bracket around the wanted rank, an exact count of the rows above and inside
proves that the rank lies in it (else the bracket is widened), and only the
bracket's rows are sorted; a bracket that is still too large is sketched
again, by score and then by id.  The rows above the cutoff are ranked in
ranges.

Defined cases: null and empty texts, and texts without words, have no
features and weight 0; a null id draws its noise as ``null`` and comes after
equal scores; rows of equal id and score are ranked in any order, rows with
equal columns alike; without target texts or documents the gains follow the
same formula with zero counts; an empty table gives no row; other columns
aren't read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.prefix import ranked
from revlens.llm.tables import cut, prepare

#: Rows (two numbers each) that are sorted to locate the cutoff, and the sketch's
#: relative rank error.
BRACKET_ROWS, RANK_ERROR = 20_000, 0.001
#: Remembered words per worker process; emptied when full.
MEMORY = 500_000

# A-Z become a-z; bytes that stand in no word become spaces.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return (text or "").encode().translate(_WORD_BYTES).split()


class _Buckets(dict):
    def __init__(self, buckets: int) -> None:
        self.buckets = buckets

    def __missing__(self, run: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        own = zlib.crc32(run) % self.buckets
        self[run] = own
        return own


def feature_buckets(words: list[bytes], runs: int, memory: _Buckets) -> np.ndarray:
    """Bucket of every run of 1 to ``runs`` words, repeats kept."""
    out = [np.fromiter(map(memory.__getitem__, words), np.int64, len(words))]
    for n in range(2, runs + 1):
        own = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)]
        out.append(np.fromiter(map(memory.__getitem__, own), np.int64, len(own)))
    return np.concatenate(out)


def bucket_counts(df: DataFrame, text: str, buckets: int, runs: int) -> np.ndarray:
    """Features in every bucket, over all rows; one array per task is summed."""
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory, own = _Buckets(buckets), np.zeros(buckets, np.int64)
        for part in parts:
            for words in map(words_of, part["text"]):
                found = feature_buckets(words, runs, memory)
                # Short texts touch few buckets, long ones are counted at once.
                if len(found) < buckets // 8:
                    np.add.at(own, found, 1)
                else:
                    own += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(own)
        yield pd.DataFrame({"bucket": seen, "n": own[seen]})

    rows = (df.select(df[text].alias("text")).mapInPandas(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of smoothed target and own shares."""
    size, s, t = len(own), own.astype(np.float64), target.astype(np.float64)
    return np.array([math.floor(1000 * math.log((b + 1) * (s.sum() + size) / ((a + 1) * (t.sum() + size))))
                     for a, b in zip(s, t)], np.int64)


def noise(doc_id: object, seed: int) -> int:
    """Gumbel noise of an id in whole thousandths."""
    name = "null" if doc_id is None else str(int(doc_id))
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def scored(df: DataFrame, gain: np.ndarray, runs: int, seed: int, doc_id: str, text: str) -> DataFrame:
    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = _Buckets(len(gain))
        for part in parts:
            rows = []
            for own, body in zip(part["doc_id"].astype(object), part["text"]):
                words = words_of(body)
                found = feature_buckets(words, runs, memory)
                weight = int(gain[found].sum()) // len(found) if len(found) else 0
                own = None if pd.isna(own) else int(own)
                rows.append((own, len(words), len(found), weight, weight + noise(own, seed)))
            out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_features", "weight", "score"])
            yield out.astype({"doc_id": "Int64"})

    return (df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text"))
            .mapInPandas(score, SCORED))


def _sketched(rows: DataFrame, by: str, rank: int, n: int, error: float) -> tuple:
    """Values of ``by`` that should stand shortly before and after ``rank`` of
    ``n`` rows, from below."""
    least, most = max(0.0, rank / n - 2 * error), min(1.0, rank / n + 2 * error)
    accuracy = F.lit(min(2**31 - 1, math.ceil(2 / error)))
    return tuple(rows.agg(F.percentile_approx(by, [least, most], accuracy).alias("q")).first()["q"])


def _bracket(rows: DataFrame, by: str, rank: int, n: int) -> tuple:
    """(low, high, rows under low, rows inside) of a bracket proved to hold
    the row of 0-based ``rank`` in the order of ``by``."""
    error = RANK_ERROR
    while True:
        if error < 0.5:
            low, high = _sketched(rows, by, rank, n, error)
        else:
            low, high = rows.agg(F.min(by), F.max(by)).first()
        under, inside = rows.agg(F.count(F.when(F.col(by) < low, 1)),
                                 F.count(F.when(F.col(by).between(low, high), 1))).first()
        if under <= rank < under + inside:
            return low, high, under, inside
        error *= 8


def cutoff(rows: DataFrame, take: int, n: int, score: str = "score", doc_id: str = "doc_id",
           sorted_rows: int | None = None) -> tuple[int, int]:
    """(score, doc_id) of the last of the ``take`` highest of ``n`` rows, ties
    to smaller ids.  ``rows`` is read several times and holds no null id."""
    most = sorted_rows or BRACKET_ROWS
    # Ascending order of (-score, doc_id).
    rows = rows.select((-F.col(score)).alias("down"), F.col(doc_id).alias("id"))
    rank = take - 1
    for by in ("down", "id"):
        while n > most:
            low, high, under, inside = _bracket(rows, by, rank, n)
            if inside == n and low < high:  # a bracket of everything: halved by value
                middle = (low + high) // 2
                first = rows.where(F.col(by) <= middle).count()
                low, high, under, inside = (low, middle, 0, first) if rank < first else (middle + 1, high, first, n - first)
            rows, rank, n = rows.where(F.col(by).between(low, high)), rank - under, inside
            if low == high:
                break
    if n > most:  # one (score, id) repeated
        down, own = rows.first()
    else:
        down, own = sorted(map(tuple, rows.collect()))[rank]
    return -down, own


def importance_resample(df: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20,
                        buckets: int = 10_000, runs: int = 1, seed: int = 2024,
                        doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Every document's features, weight and score, and the rank of those drawn.

    Of the documents with ``min_words`` words the ``percent`` with the highest
    scores are drawn (rounded down); columns: doc_id, n_words, n_features,
    weight, score, rank (from 1; null: not drawn).
    """
    prepare(df.sparkSession)
    gain = gains(bucket_counts(df, text, buckets, runs), bucket_counts(target, target_text, buckets, runs))
    rows = cut(scored(df, gain, runs, seed, doc_id, text))
    # A null id stands behind every other one.
    rows = rows.withColumn("__id", F.coalesce("doc_id", F.lit(2**63 - 1)))
    enough = rows.where(F.col("n_words") >= min_words)
    n = enough.count()
    take = percent * n // 100
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    if not take:
        return rows.select(*names, F.lit(None).cast("long").alias("rank"))
    score, own = cutoff(enough, take, n, doc_id="__id")
    within = (F.col("n_words") >= min_words) & (
        (F.col("score") > score) | ((F.col("score") == score) & (F.col("__id") <= own)))
    order = [F.col("score").desc(), "__id", "n_features", "weight", "n_words"]
    drawn = ranked(rows.where(within), order, "__rank", cut)
    drawn = drawn.withColumn("rank", F.when(F.col("__rank") < take, F.col("__rank") + 1))
    return drawn.select(*names, "rank").unionByName(
        rows.where(~within).select(*names, F.lit(None).cast("long").alias("rank")))
