"""Mixing sources to target weights.

The words of a source, its documents in a pseudorandom order, form one stream
that is packed into blocks of a fixed number of words (the last may be
shorter).  The mix is a number of slots, each holding one block, dealt over
output shards.  Every shard draws how many of its slots each source gets from
a multinomial; slots that a source draws beyond its target go to the sources
that drew too few.  A source's slots are numbered over the shards, and slot
``i`` takes the block that pseudorandom permutation ``i // blocks`` of the
source's block numbers gives for ``i % blocks``, so a block returns only
after all others.  Slots and documents meet by a join on the block.

Sources are ranked by the code points of their name, null last; weights
repeat along that order.  A target is the weight's share of all words asked
for, at most ``times`` the source's own; what is above is shared again by
weight until no target is above.  The words taken of a source are its target
rounded to a whole word: its last slot is cut.

Defined cases: null, empty and blank texts have size 0 and nothing is taken
of them; a source without words has target 0; rows of equal id are documents
of their own, and equal rows count each; an empty table gives no row; other
columns aren't read.  Everything drawn depends on ``seed`` and the rows alone,
not on their order or partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.prefix import ranked, running_sums
from revlens.llm.shingles import mix as spread
from revlens.llm.tables import cut, prepare
from revlens.operators.joins import lookup_join

#: Words of a block, slots of an output shard.
BLOCK_WORDS, SHARD_SLOTS = 256, 256
#: Documents of one bucket of a source's stream (on average), sources drawn
#: together, and shards whose counts are accumulated together.
BUCKET_DOCS, SOURCE_CHUNK, SHARD_CHUNK = 20_000, 1_000, 1_000
ROUNDS = 4


def n_words(text: str | None) -> int:
    """Runs of ``[^\\x20\\x09-\\x0D]+``."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    word = (raw != 32) & ((raw < 9) | (raw > 13))
    return int(word[:1].sum()) + int(np.count_nonzero(word[1:] & ~word[:-1]))


def _sizes(texts: pd.Series) -> pd.Series:
    return pd.Series([n_words(t) for t in texts], dtype="int64")


def _cut_words(texts: pd.Series, first: pd.Series, size: pd.Series) -> pd.Series:
    return pd.Series([b" ".join(t.encode().split()[a:a + n]).decode() for t, a, n in zip(texts, first, size)])


def _halves(n: np.ndarray) -> np.ndarray:
    """Bits of one half of the smallest even width that holds 0..n-1."""
    bits = np.frexp(np.maximum(n.astype(np.float64) - 1, 1))[1]
    return ((bits + 1) // 2).astype(np.uint64)


def _round(right: np.ndarray, key: np.ndarray, r: int, mask: np.ndarray) -> np.ndarray:
    return spread(right + key * np.uint64(2 * r + 1)) & mask


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """Place of index ``i`` under the permutation of 0..n-1 that ``key`` names.

    A Feistel network over the smallest even number of bits, repeated where
    it leaves the range; ``back`` gives the index of a place.
    """
    i, n, key = (np.asarray(x).astype(np.uint64) for x in (i, n, key))
    half = _halves(n)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = i.copy(), np.arange(len(i))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ _round(left, k, r, m), left
            else:
                left, right = right, left ^ _round(right, k, r, m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _key(source: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    return spread(spread(np.asarray(source).astype(np.uint64) + np.uint64(seed)) + np.asarray(turn).astype(np.uint64))


def goals(sources: pd.DataFrame, block: int, seed: int) -> pd.DataFrame:
    """Whole words, blocks, slots and the words of the last slot per source.

    The slots of the last, incomplete permutation are counted so that their
    blocks just reach the goal, the shorter last block included.
    """
    size = sources["source_size"].to_numpy(np.int64)
    words = np.floor(sources["target"].to_numpy(np.float64) + 0.5).astype(np.int64)
    blocks = -(-size // block)
    short = np.where(size > 0, blocks * block - size, 0)  # words that the last block lacks
    turns, rest = np.divmod(words, np.maximum(size, 1))
    some = np.maximum(blocks, 1)
    place = permuted(some - 1, some, _key(sources["source_no"], turns, seed), back=True)
    more = -(-rest // block)
    met = place < more
    more = np.where(met, -(-(rest + short) // block), more)
    before = (more - 1) * block - np.where(place < more - 1, short, 0)
    return sources.assign(n_blocks=blocks, words=words, n_slots=turns * blocks + np.where(rest > 0, more, 0),
                          last_words=np.where(rest > 0, rest - before, 0))


GOALS = ("source_no long, source string, source_size long, target double, "
         "n_blocks long, words long, n_slots long, last_words long")


def targets(sources: DataFrame, percent: float, times: int) -> DataFrame:
    """Adds ``target`` to (source_size, weight): shares by weight, the excess
    over ``times`` the size shared again until none is above."""
    own = F.col("source_size") * times
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    asked = min(total * percent / 100, total * times)
    level = 0.0
    while True:
        above = F.col("weight") * F.lit(level) > own
        full, weight = sources.agg(F.coalesce(F.sum(F.when(above, own)), F.lit(0)),
                                   F.sum(F.when(~above, F.col("weight")))).first()
        if not weight:
            break
        before, level = level, (asked - full) / weight
        if level <= before:
            break
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), own.cast("double")))


@dataclass
class Mix:
    """The plan of a mix.

    ``documents``: one row per document row: doc_id, source_no, text, size,
    and its place (bucket, n) and first word (start) in its source's stream.
    ``sources``: one row per source (columns of ``GOALS``).
    ``slots``: one row per slot: shard, source_no, slot, block, words.
    """
    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    block_words: int

    def pieces(self) -> DataFrame:
        """The documents' parts of every block: block, at (first word in the
        block), first (in the document), length; documents without words have
        one row without a block."""
        b = F.lit(self.block_words)
        last = F.floor((F.col("start") + F.col("size") - 1) / b)
        held = self.documents.withColumn("block", F.explode_outer(
            F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / b), last))))
        low = F.greatest("start", F.col("block") * b)
        high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b)
        return (held.withColumn("at", low - F.col("block") * b).withColumn("first", low - F.col("start"))
                .withColumn("length", high - low))

    def spans(self) -> DataFrame:
        """What every slot holds: shard, source_no, slot, at, doc_id, first, length, text (of the whole document)."""
        slots = self.slots.select("shard", "source_no", "slot", "block", "words")
        return (self.pieces().join(slots, ["source_no", "block"])
                .withColumn("length", F.least("length", F.col("words") - F.col("at"))).where("length > 0")
                .select("shard", "source_no", "slot", "at", "doc_id", "first", "length", "text"))

    def texts(self) -> DataFrame:
        """The mixed text: one row per slot, its words joined by spaces, in a
        pseudorandom place of its shard."""
        part = self.spans().withColumn("part", F.pandas_udf(_cut_words, "string")("text", "first", "length"))
        return (part.groupBy("shard", "source_no", "slot")
                .agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts"))
                .select("shard", F.xxhash64("shard", "source_no", "slot").alias("place"), "source_no", "slot",
                        F.array_join("parts.part", " ").alias("text")))

    def shares(self) -> DataFrame:
        """One row per document row: doc_id, size, source_size, target, taken."""
        b = self.block_words
        full = F.least(F.lit(b), F.col("source_size") - F.col("block") * b)
        held = lookup_join(self.slots, self.sources.select("source_no", "source_size"), "source_no", "slot", "inner")
        uses = held.groupBy("source_no", "block").agg(
            F.count(F.when(F.col("words") >= full, 1)).alias("times"),
            F.coalesce(F.max(F.when(F.col("words") < full, F.col("words"))), F.lit(0)).alias("part"))
        cut_part = F.greatest(F.lit(0), F.least(F.col("length"), F.col("part") - F.col("at")))
        taken = (self.pieces().join(uses, ["source_no", "block"], "left")
                 .withColumn("own", F.coalesce(F.col("times") * F.col("length") + cut_part, F.lit(0)))
                 .groupBy("source_no", "bucket", "n")
                 .agg(F.first("doc_id").alias("doc_id"), F.first("size").alias("size"), F.sum("own").alias("taken")))
        return (lookup_join(taken, self.sources.select("source_no", "source_size", "target"), "source_no", "n", "inner")
                .select("doc_id", "size", "source_size", "target", "taken"))


def _streams(docs: DataFrame, rows: int) -> DataFrame:
    """Every document's first word in the stream of its source."""
    buckets = max(1, -(-rows // BUCKET_DOCS))
    known = docs.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(buckets)))
    inside = Window.partitionBy("source_no", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "tie")
    return running_sums(known.withColumn("n", F.row_number().over(inside)), "size",
                        ["source_no"], "bucket", ["n"], "start")


def _draws(spark: SparkSession, totals: list[int], chunks: DataFrame, slots: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, source_no, drawn): multinomial counts of every shard's slots.

    Chunks of sources are drawn first, then the sources of a chunk, which is
    the same distribution as one draw over all sources.
    """
    share = np.array(totals, np.float64) / max(1, sum(totals))

    def by_chunk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for shard in part["id"].tolist():
                n = min(shard_slots, slots - shard * shard_slots)
                own = np.random.default_rng([seed, shard]).multinomial(n, share)
                rows += [(shard, int(c), int(own[c])) for c in np.flatnonzero(own)]
            yield pd.DataFrame(rows, columns=["shard", "chunk", "n"])

    def by_source(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for shard, c, n, nos, want in zip(*(part[k] for k in ("shard", "chunk", "n", "nos", "want"))):
                p = np.asarray(want, np.float64)
                own = np.random.default_rng([seed, shard, c + 1]).multinomial(n, p / p.sum())
                rows += [(shard, int(nos[j]), int(own[j])) for j in np.flatnonzero(own)]
            yield pd.DataFrame(rows, columns=["shard", "source_no", "drawn"])

    shards = spark.range(-(-slots // shard_slots)).mapInPandas(by_chunk, "shard long, chunk long, n long")
    return lookup_join(shards, chunks, "chunk", "shard", "inner").mapInPandas(
        by_source, "shard long, source_no long, drawn long")


def _slots(draws: DataFrame, sources: DataFrame, block: int, seed: int) -> DataFrame:
    """One row per slot: what was drawn beyond a goal fills what was missed."""
    drawn = draws.groupBy("source_no").agg(F.sum("drawn").alias("drawn"))
    level = (sources.select("source_no", "n_slots").join(drawn, "source_no", "left")
             .withColumn("drawn", F.coalesce("drawn", F.lit(0)))
             .withColumn("over", F.greatest(F.lit(0), F.col("drawn") - F.col("n_slots")))
             .withColumn("miss", F.greatest(F.lit(0), F.col("n_slots") - F.col("drawn")))
             .withColumn("chunk", F.floor(F.col("source_no") / SOURCE_CHUNK)))
    level = running_sums(level, "over", [], "chunk", ["source_no"], "over_from")
    level = cut(running_sums(level, "miss", [], "chunk", ["source_no"], "miss_from"))
    numbered = running_sums(draws.withColumn("group", F.floor(F.col("shard") / SHARD_CHUNK)),
                            "drawn", ["source_no"], "group", ["shard"], "from")
    numbered = numbered.select("shard", "source_no", F.explode(
        F.sequence(F.col("from"), F.col("from") + F.col("drawn") - 1)).alias("slot"))
    numbered = lookup_join(numbered, level.select("source_no", "n_slots", "over_from"), "source_no", "slot", "inner")
    free = numbered.where("slot >= n_slots").select("shard", (F.col("over_from") + F.col("slot") - F.col("n_slots")).alias("f"))
    missed = level.where("miss > 0").select("source_no", F.posexplode(
        F.sequence(F.col("miss_from"), F.col("miss_from") + F.col("miss") - 1)).alias("j", "f"), "drawn")
    moved = free.join(missed, "f").select("shard", "source_no", (F.col("drawn") + F.col("j")).alias("slot"))
    kept = numbered.where("slot < n_slots").select("shard", "source_no", "slot").unionByName(moved)

    def take(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            turn, j = np.divmod(part["slot"].to_numpy(), part["n_blocks"].to_numpy())
            own = permuted(j, part["n_blocks"].to_numpy(), _key(part["source_no"], turn, seed))
            whole = np.minimum(block, part["source_size"].to_numpy() - own * block)
            last = (part["slot"] == part["n_slots"] - 1).to_numpy() & (part["last_words"].to_numpy() > 0)
            yield part[["shard", "source_no", "slot"]].assign(
                block=own, words=np.where(last, part["last_words"], whole))

    facts = sources.select("source_no", "source_size", "n_blocks", "n_slots", "last_words")
    return lookup_join(kept, facts, "source_no", "slot", "inner").mapInPandas(
        take, "shard long, source_no long, slot long, block long, words long")


def mix_sources(df: DataFrame, weights: tuple[int, ...] = (5, 2, 1), percent: float = 100, times: int = 3,
                block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 42,
                doc_id: str = "doc_id", source: str = "source", text: str = "text") -> Mix:
    """Plan a mix of ``percent`` of all words (see the module's docstring)."""
    spark = df.sparkSession
    prepare(spark)
    docs = df.select(df[doc_id].cast("long").alias("doc_id"), df[source].alias("source"), df[text].alias("text"),
                     F.xxhash64(df[text]).alias("tie"), F.pandas_udf(_sizes, "long")(df[text]).alias("size"))
    # A null source is told from any name by the first character.
    docs = docs.withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")))
    sums = docs.groupBy("source_key").agg(F.first("source").alias("source"), F.count("*").alias("rows"),
                                          F.sum("size").alias("source_size"))
    known = ranked(sums, [F.col("source").asc_nulls_last()], "source_no", cut)
    each = F.array([F.lit(w) for w in weights])
    known = known.withColumn("weight", F.element_at(each, (F.col("source_no") % len(weights) + 1).cast("int")))
    known = cut(targets(cut(known), percent, times))
    plans = cut(known.select("source_no", "source", "source_size", "target").mapInPandas(
        lambda parts: (goals(part, block_words, seed) for part in parts), GOALS))
    rows = known.agg(F.sum("rows")).first()[0] or 0

    chunk = F.floor(F.col("source_no") / SOURCE_CHUNK).alias("chunk")
    asked = plans.where("n_slots > 0").groupBy(chunk)
    by_chunk = {r["chunk"]: r["n"] for r in asked.agg(F.sum("n_slots").alias("n")).collect()}
    totals = [by_chunk.get(c, 0) for c in range(max(by_chunk, default=-1) + 1)]
    pairs = F.array_sort(F.collect_list(F.struct("source_no", "n_slots")))
    chunks = cut(asked.agg(pairs.alias("p")).select("chunk", F.col("p.source_no").alias("nos"), F.col("p.n_slots").alias("want")))
    draws = cut(_draws(spark, totals, chunks, sum(totals), shard_slots, seed))

    streams = _streams(lookup_join(docs, known.select("source_key", "source_no"), "source_key", "tie", "inner"), rows)
    return Mix(streams.select("doc_id", "source_no", "text", "size", "bucket", "n", "start"),
               plans, _slots(draws, plans, block_words, seed), block_words)
