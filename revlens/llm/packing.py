"""Best-fit packing of token sequences.

Documents become id sequences; only those longer than a sequence are cut.
Pieces are dealt at random over packing tasks, and each task packs its
stream online into a fixed number of open bins: a bitset keyed by free space
says which free sizes are open, the tightest one that holds the piece takes
it, and when all bins are open and none holds it the fullest one closes.

Defined cases: a null text is empty (one piece with the end id alone);
repeated rows are packed each; an empty table gives no rows; only the id and
text columns are read, so clashing names can't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.bpe import cached_ids
from revlens.llm.tables import prepare

#: Open bins of one packing task.
OPEN_BINS = 256
#: Documents per packing task; each task leaves at most OPEN_BINS part-filled
#: sequences, so this bounds the share of waste at any table size.
DOCS_PER_TASK = 50_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


class OpenBins:
    """Bounded-space online best-fit."""

    def __init__(self, capacity: int, bins: int) -> None:
        self.capacity, self.bins = capacity, bins
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]  # open sequences by free space
        self.bits = 0
        self.open = self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of ``size`` tokens."""
        fits = self.bits >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            sequence = self._take(space)
        else:
            if self.open == self.bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
            sequence, space = self.made, self.capacity
            self.made += 1
        left = space - size
        if left:
            self.free[left].append(sequence)
            self.bits |= 1 << left
            self.open += 1
        return sequence, self.capacity - space

    def _take(self, space: int) -> int:
        own = self.free[space]
        sequence = own.pop()
        if not own:
            self.bits &= ~(1 << space)
        self.open -= 1
        return sequence


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first may be shorter."""
    first = n % capacity or capacity
    return [(0, min(first, n)), *((s, capacity) for s in range(first, n, capacity))]


def pieces(df: DataFrame, tokenizer: str, capacity: int, end_id: int,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of every document, without their ids."""
    def tokenise(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = cached_ids(tokenizer)
        for part in parts:
            rows = []
            for own, words in zip(part["doc_id"], part["text"]):
                ids = encode(words or "").astype("<u4")
                raw = ids.tobytes() + int(end_id).to_bytes(4, "little")
                rows += [(own, k, start, size, zlib.crc32(raw[4 * start:4 * (start + size)]))
                         for k, (start, size) in enumerate(cut_points(len(ids) + 1, capacity))]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return (df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text"))
            .mapInPandas(tokenise, PIECES))


def pack(df: DataFrame, capacity: int, tasks: int, bins: int = OPEN_BINS) -> DataFrame:
    """Place every piece (columns of ``PIECES``) in a sequence."""
    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bin_set, own = OpenBins(capacity, bins), TaskContext.get().partitionId() << 40
        for part in parts:
            at = [bin_set.place(size) for size in part["length"].tolist()]
            part["sequence_id"] = np.array([s for s, _ in at], np.int64) + own
            part["offset"] = np.array([o for _, o in at], np.int64)
            yield part

    mixed = F.xxhash64("doc_id", "piece")
    return (df.repartition(tasks, mixed)
            .sortWithinPartitions(mixed, "doc_id", "piece", "ids_crc32", "length")
            .mapInPandas(place, PACKED))


def best_fit_packing(df: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
                     bins: int = OPEN_BINS, docs_per_task: int = DOCS_PER_TASK) -> DataFrame:
    """Cut, deal and pack; the number of packing tasks follows the table."""
    prepare(df.sparkSession)
    tasks = max(1, -(-df.count() // docs_per_task))
    return pack(pieces(df, tokenizer, capacity, end_id), capacity, tasks, bins)
