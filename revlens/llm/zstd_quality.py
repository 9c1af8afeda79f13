"""Quality by compression.

The labelled rows are dealt over two halves, and each half gives a pair of
zstandard dictionaries, one of its good and one of its bad text.  A text is
cut into blocks, every block is compressed with each dictionary, and the
difference of the summed sizes says which text it resembles.  The difference
is normalised twice, by the larger sum and by the text's bytes; the better
sum per byte says how much a text resembles either at all.  A logistic curve
over these three numbers, averaged over the two pairs, and their squares makes
a probability of them; it is fitted on every labelled row's sizes under the
other half's pair.

Defined cases: null and empty texts compress to equal sizes (difference 0)
and get the score of that difference; repeated rows get equal scores; without
labelled rows of both classes (or too few for a pair of dictionaries) every
score is null; other columns aren't read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.linear import fit_logistic, sigmoid
from revlens.llm.tables import cut, prepare

#: Labelled rows that dictionaries and curve are fitted on, at most.
LABELLED_ROWS = 20_000
#: Bytes of text per class that a dictionary is built from, and its size.
DICTIONARY_TEXT, DICTIONARY_BYTES = 4_000_000, 131_072
BLOCK, LEVEL = 1_024, 3


def blocks(raw: bytes) -> list[bytes]:
    return [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]


@functools.lru_cache(maxsize=4)
def compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    """Kept per worker process: a dictionary is digested once."""
    out = []
    for content in (good, bad):
        own = zstandard.ZstdCompressionDict(content)
        own.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=own))
    return out


def features(text: str | None, dictionaries: tuple[bytes, bytes]) -> tuple[float, float, float]:
    """The size difference over the larger sum and over the text's bytes, and
    the better sum over the text's bytes, which bends the curve."""
    raw = (text or "").encode()
    if not raw:
        return 0.0, 0.0, 0.0
    own = blocks(raw)
    good, bad = (sum(len(c.compress(b)) for b in own) for c in compressors(*dictionaries))
    return (bad - good) / max(good, bad), (bad - good) / len(raw), min(good, bad) / len(raw)


class Curve:
    """Calibration: a logistic curve over standardised features and their squares."""

    def __init__(self, x: np.ndarray, target: np.ndarray) -> None:
        self.mean, self.sd = x.mean(0), np.maximum(x.std(0), 1e-9)
        self.weights = fit_logistic(self._terms(x), target)

    def _terms(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.sd, -8, 8)
        return np.hstack([z, z * z])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self._terms(x) @ self.weights[:-1] + self.weights[-1])


def dictionary(texts: list[bytes]) -> bytes:
    """Built from the blocks of ``texts``; small inputs serve as they are."""
    own = [b for t in texts for b in blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, own).as_bytes()
    except zstandard.ZstdError:
        return b"".join(own)[-DICTIONARY_BYTES:]


def _dictionaries(rows: DataFrame) -> tuple[bytes, bytes]:
    """Of the good and of the bad texts, from equally many bytes of both."""
    raw = rows.select("__id", "label", F.encode("text", "utf-8").alias("raw")).where("length(raw) > 0")
    sizes = {r["label"]: r["n"] for r in raw.groupBy("label").agg(F.sum(F.length("raw")).alias("n")).collect()}
    bound = min(DICTIONARY_TEXT, sizes.get(0, 0), sizes.get(1, 0))
    out = []
    for label in (1, 0):
        taken, size = [], 0
        ordered = raw.where(F.col("label") == label).orderBy(F.xxhash64("__id"), "raw")
        for row in ordered.toLocalIterator() if bound else ():
            taken.append(bytes(row["raw"]))
            size += len(taken[-1])
            if size >= bound:
                break
        out.append(dictionary(taken) if taken else b"")
    return tuple(out)


def quality_scores(df: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   rows: int = LABELLED_ROWS) -> Column:
    """Score column for ``df``: probability that a text is good.

    ``labelled`` has columns doc_id and label (1: good); at most ``rows`` of
    them, dealt by a hash of the id, are used.  Null where no curve can be
    fitted.
    """
    prepare(df.sparkSession)
    dealt = F.pmod(F.xxhash64("__id", F.lit(7)), F.lit(2))
    chosen = (labelled.where("label in (0, 1) and doc_id is not null")
              .select(F.col("doc_id").cast("long").alias("__id"), F.col("label").cast("int").alias("label"))
              .orderBy(F.xxhash64("__id"), "__id", "label").limit(rows))
    sample = cut(df.select(df[doc_id].cast("long").alias("__id"), df[text].alias("text"))
                 .join(F.broadcast(chosen), "__id").withColumn("side", dealt))
    sides = [_dictionaries(sample.where(F.col("side") == side)) for side in (0, 1)]
    pairs = [pair for pair in sides if all(pair)]

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"label": part["label"], "x": [
                list(features(t, sides[1 - side])) for t, side in zip(part["text"], part["side"])]})

    curve = None
    if pairs:
        # Every row is measured with the dictionaries that it isn't part of.
        whole = [side for side in (0, 1) if all(sides[1 - side])]
        seen = sample.where(F.col("side").isin(whole)).select("label", "text", "side").mapInPandas(
            measure, "label int, x array<double>").toPandas()
        if seen["label"].nunique() == 2:
            curve = Curve(np.stack(seen["x"].to_list()), seen["label"].to_numpy(float))

    if curve is None:
        return F.lit(None).cast("double")

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        seen = [np.array([features(t, pair) for t in texts]).reshape(-1, 3) for pair in pairs]
        return pd.Series(curve(np.mean(seen, axis=0)))

    return score(F.col(text))
