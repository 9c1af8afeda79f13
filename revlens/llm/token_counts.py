"""Token counts by prefix dynamic programming.

For every character prefix of a text the exact number of byte-level BPE
tokens is stored, so that totals, truncation points and budgets are read off
the stored counts without encoding anything again.

Defined cases: a null text counts as empty; an empty text has one (empty)
prefix of 0 tokens; repeated rows are counted each; other columns, whatever
their names, stay untouched (``with_prefix_counts``) or are left out
(``token_counts``).  Special strings inside texts are one token, as the
library takes them by default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from revlens.llm.bpe import prefix_counts
from revlens.llm.tables import prepare


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def with_prefix_counts(df: DataFrame, tokenizer: str, text: str = "text",
                       into: str = "prefix_counts") -> DataFrame:
    """Add the stored counts: little-endian uint32, one per prefix, the empty one first."""
    @F.pandas_udf(BinaryType())
    def stored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = prefix_counts(tokenizer)
        for texts in parts:
            yield pd.Series([counter(t or "").astype("<u4").tobytes() for t in texts], dtype=object)

    return df.withColumn(into, stored(df[text]))


def token_counts(df: DataFrame, tokenizer: str, limit: int, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row: n_bytes, n_tokens, over_limit and cut_chars, the characters
    of the longest prefix that holds at most ``limit`` tokens."""
    prepare(df.sparkSession)
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = prefix_counts(tokenizer)
        for part in parts:
            rows = []
            for own in part["text"]:
                own = own or ""
                counts = counter(own)
                rows.append((len(own.encode()), int(counts[-1]), longest_within(counts, limit)))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_tokens", "cut_chars"], dtype="int64")
            out.insert(0, "doc_id", part["doc_id"].to_numpy())
            out["over_limit"] = out["n_tokens"] > limit
            yield out

    return (df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text"))
            .mapInPandas(count, "doc_id long, n_bytes long, n_tokens long, cut_chars long, over_limit boolean"))
