"""One large quoted CSV file, read by many tasks.

A CSV whose quoted cells hold newlines is usually read by one task per file
(``multiLine``), since a task that starts in the middle can't tell whether it
stands inside quotes.  Here the files are read as splittable lines:

1. Every split counts its quotes and notes whether a line would begin a record
   if the split began inside a cell: one narrow row per split.
2. The quotes before a split, added up along its file, tell whether it begins
   inside a cell, and which split holds the beginning of that record.
3. Every split cuts its own lines into records.  A record over a split's edge
   leaves fragments, at most two per split, joined again by (file, split of
   its beginning); whole records are never shuffled.

``from_csv`` parses the records in the JVM.  Files are read three times (1,
whole records, fragments).  What goes to the driver and the tasks is one row of
33 bytes per split, far less than the driver's own list of splits.

Defined cases: a quote must open a cell or be doubled inside one; an even
number of stray quotes in one line does no harm.  Empty lines outside quotes
are skipped; ``\\r`` before a record's end isn't part of it.  An empty file or
one with a header alone gives no rows; rows too short get nulls.  A last record whose quotes
never close reaches to the end of its file.  If the files' splits change
between the passes (files rewritten meanwhile, another default parallelism)
the read fails and says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from revlens.session import ship_package

SPLIT = "file long, start long, length long"
PIECE = "file long, owner long, place long, first boolean, value string"
#: Splits of one read; more means that files should be read in parts.
MAX_SPLITS = 20_000_000


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, int], pa.Array, np.ndarray]]:
    """Per stretch of one split in a batch: its key, the lines and their quotes' parity."""
    if not batch.num_rows:
        return
    keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
    odd = (pc.count_substring(batch.column(3), '"').to_numpy(zero_copy_only=False) & 1).astype(bool)
    edges = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0), True])
    for a, b in zip(edges[:-1], edges[1:]):
        yield tuple(keys[:, a].tolist()), batch.column(3).slice(a, b - a), odd[a:b]


def _before(odd: np.ndarray, inside: bool) -> np.ndarray:
    """Whether each line begins inside a cell."""
    return np.logical_xor.accumulate(np.r_[inside, odd[:-1]])


def split_states(lines: DataFrame) -> DataFrame:
    """file, start, length, odd (quotes of the split), begins (whether a record
    would begin in it, had it begun inside a cell): one row per split."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, odd, begins = None, False, False

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (*now, bool(odd), bool(begins))], ["file", "start", "length", "odd", "begins"])

        for batch in batches:
            for key, _, parity in _runs(batch):
                if key != now:
                    if now is not None:
                        yield row()
                    now, odd, begins = key, False, False
                begins = begins or bool((~_before(parity, not odd)).any())
                odd = odd ^ bool(parity.sum() & 1)
        if now is not None:
            yield row()

    return lines.mapInArrow(count, SPLIT + ", odd boolean, begins boolean")


def split_table(states: DataFrame, max_splits: int = MAX_SPLITS) -> dict[str, np.ndarray]:
    """Sorted arrays of every split: whether it begins inside a cell, and the
    start of the split where the record at its beginning, and that at its end, begins."""
    along = Window.partitionBy("file").orderBy("start")
    placed = (states.withColumn("inside", (F.sum(F.col("odd").cast("int")).over(
                  along.rowsBetween(Window.unboundedPreceding, -1)) % 2) == 1)
              .withColumn("inside", F.coalesce("inside", F.lit(False)))
              .withColumn("own", F.when(~F.col("inside") | F.col("begins"), F.col("start")))
              .withColumn("owner", F.last("own", ignorenulls=True).over(
                  along.rowsBetween(Window.unboundedPreceding, -1))))
    found = placed.select("file", "start", "length", "inside", F.coalesce("owner", "start").alias("owner")).limit(
        max_splits + 1).toArrow()
    if found.num_rows > max_splits:
        raise ValueError(f"more than {max_splits} splits: read the files in parts")
    own = {c: found.column(c).to_numpy() for c in found.column_names}
    order = np.lexsort((own["start"], own["file"]))
    return {c: v[order] for c, v in own.items()}


def _find(table: dict[str, np.ndarray], key: tuple[int, int, int]) -> tuple[bool, int]:
    """Whether a split begins inside a cell, and where that record begins."""
    a, b = np.searchsorted(table["file"], key[0], "left"), np.searchsorted(table["file"], key[0], "right")
    i = a + np.searchsorted(table["start"][a:b], key[1])
    if i >= b or table["start"][i] != key[1] or table["length"][i] != key[2]:
        raise RuntimeError("the files' splits changed between two passes: read again")
    return bool(table["inside"][i]), int(table["owner"][i])


def pieces(lines: DataFrame, table, whole: bool) -> DataFrame:
    """Records that lie in one split (``whole``), else the fragments of the
    others: file, owner (start of the split where the record begins), place
    (start of the fragment's split), first (the file's first record), value.

    A split's last record counts as a fragment, since only the next split tells
    whether it goes on: one row per split is joined with nothing."""
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head, inside, owner, held, first = None, False, False, 0, [], False

        def rows(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              ["file", "owner", "place", "first", "value"])

        def flush() -> list[tuple]:
            """What is held at a split's end: its last record, or the end of an earlier split's."""
            return [] if whole or not held else [(now[0], owner if head else now[1], now[1],
                                                  first and not head, "\n".join(held))]

        for batch in batches:
            out: list[tuple] = []
            for key, values, odd in _runs(batch):
                if key != now:
                    out += flush()
                    inside, owner = _find(table.value, key)
                    now, head, held, first = key, inside, [], key[1] == 0
                in_cell = _before(odd, inside)
                inside = bool(in_cell[-1] ^ odd[-1])
                for line, goes_on in zip(values.to_pylist(), in_cell.tolist()):
                    if goes_on:
                        held.append(line)
                        continue
                    if held and head and not whole:
                        out.append((now[0], owner, now[1], False, "\n".join(held)))
                    elif held and not head and whole:
                        out.append((now[0], now[1], now[1], first, "\n".join(held)))
                    if held and not head:
                        first = False
                    head, held = False, [line] if line not in ("", "\r") else []
            if out:
                yield rows(out)
        last = flush()
        if last:
            yield rows(last)

    return lines.mapInArrow(of_task, PIECE)


def read_records(spark: SparkSession, path) -> DataFrame:
    """first (a file's first record, the header), value: every CSV record of the files."""
    ship_package(spark)
    lines = _lines(spark, path)
    table = spark.sparkContext.broadcast(split_table(split_states(lines)))
    inner = pieces(lines, table, True).select("first", "value")
    # A group holds one record's fragments, so it is as large as that record.
    edges = (pieces(lines, table, False).groupBy("file", "owner")
             .agg(F.array_sort(F.collect_list(F.struct("place", "first", "value"))).alias("parts"))
             .select(F.exists("parts", lambda p: p["first"]).alias("first"),
                     F.concat_ws("\n", F.transform("parts", lambda p: p["value"])).alias("value")))
    return inner.unionByName(edges).select("first", F.regexp_replace("value", "\r\\z", "").alias("value"))


def read_quoted_csv(spark: SparkSession, path, columns: list[str], sep: str = ",") -> DataFrame:
    """Headed CSV as strings, one column per name of ``columns`` by position."""
    names = [f"c{i}" for i in range(len(columns))]
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    parsed = read_records(spark, path).where(~F.col("first")).select(
        F.from_csv("value", ", ".join(f"{n} string" for n in names), options).alias("r"))
    return parsed.select(*[F.col(f"r.{n}").alias(c) for n, c in zip(names, columns)])
