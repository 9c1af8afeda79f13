"""Spelling variants: frequent words one code point apart, and their forms.

Words are counted over all texts (batches, then tasks, then the whole table).
Two words one edit apart share either half of each, so every word is sent to
the bin of its first and to the bin of its last ``HALF`` code points; a bin is
one bidirectional FM-index, searched for all its words.  Beginnings are
binned in sorted order up to a number of words; what one beginning holds
beyond that is cut into index blocks and query chunks, each pair of them one
task, so no task holds more than a bound.

A word's form is its most frequent near word (ties: the smallest in
code-point order) if that is ``ratio`` times as frequent; its root is the end
of the chain of forms.

Defined cases: null, empty and wordless texts give no words; a null id counts
as an empty name in the hash; repeated rows are counted again; an empty table
gives no row; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.fm_index import near_words
from revlens.llm.prefix import running_sums
from revlens.llm.tables import cut, prepare
from revlens.operators.joins import lookup_join

#: Words of one index and of one batch of queries, about; code points of the
#: beginnings and endings that tell a bin (at most the shorter half).
BIN_WORDS, HALF = 10_000, 3
#: Distinct words that a task counts before it hands them on.
MEMORY = 300_000

# A-Z become a-z, code points that stand in no run become spaces.
_RUN_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs_of(text: str | None) -> list[bytes]:
    """``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lower-cased, one byte a code point."""
    return (text or "").encode("latin-1", "replace").translate(_RUN_BYTES).split()


def text_words(doc_id: object, text: str | None, least: int, every: int) -> Counter:
    """Words of a text; of a run whose hash with the id is a multiple of
    ``every``, one code point is deleted."""
    out: Counter = Counter()
    name = zlib.crc32(f"{'' if doc_id is None else int(doc_id)}:".encode())
    for run, n in Counter(runs_of(text)).items():
        if len(run) < least:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), name)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= least:
            out[run] += n
    return out


def word_counts(df: DataFrame, least: int = 6, least_n: int = 5, every: int = 199,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of words with ``least`` code points and ``least_n`` occurrences."""
    def frame(held: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": [w.decode("latin-1") for w in held], "n": list(held.values())})

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for part in parts:
            for own, body in zip(part["doc_id"].astype(object), part["text"]):
                for w, n in text_words(None if pd.isna(own) else own, body, least, every).items():
                    held[w] += n
                if len(held) >= MEMORY:
                    yield frame(held)
                    held.clear()
        if held:
            yield frame(held)

    return (df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text"))
            .mapInPandas(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n))


PAIRS = "word string, n long, near string, near_n long"


def near_pairs(words: DataFrame, bin_words: int = BIN_WORDS) -> DataFrame:
    """Both orders of every pair of words one edit apart.

    ``words``: distinct ``word`` of at least ``2 * HALF`` code points, and
    ``n``; it is read twice.
    """
    sides = F.array(F.struct(F.lit(True).alias("prefix"), F.substring("word", 1, HALF).alias("edge")),
                    F.struct(F.lit(False).alias("prefix"), F.substring("word", -HALF, HALF).alias("edge")))
    held = words.select("word", "n", F.inline(sides))
    edges = (held.groupBy("prefix", "edge").agg(F.count("*").alias("held"))
             .withColumn("head", F.substring("edge", 1, 1)))
    edges = (running_sums(edges, "held", ["prefix"], "head", ["edge"], "before")
             .withColumn("bin", F.floor(F.col("before") / bin_words)))
    sizes = edges.groupBy("prefix", "bin").agg(F.ceil(F.sum("held") / (2 * bin_words)).alias("blocks"))
    edges = cut(edges.join(sizes, ["prefix", "bin"])
                .select(F.concat(F.col("prefix").cast("string"), F.lit(":"), "edge").alias("key"), "bin", "blocks"))
    held = held.withColumn("key", F.concat(F.col("prefix").cast("string"), F.lit(":"), "edge"))
    held = lookup_join(held, edges, "key", "word", "inner")
    own = F.pmod(F.xxhash64("word"), F.col("blocks"))
    each = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    # In the pair of its own block and chunk a word is indexed and asked for.
    places = F.concat(
        F.transform(each, lambda c: F.struct(own.alias("block"), c.alias("chunk"), F.lit(True).alias("index"),
                                             (c == own).alias("ask"))),
        F.transform(F.filter(each, lambda b: b != own), lambda b: F.struct(
            b.alias("block"), own.alias("chunk"), F.lit(False).alias("index"), F.lit(True).alias("ask"))))
    dealt = held.select("word", "n", "prefix", "bin", F.inline(places))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        index, ask = part[part["index"]], part[part["ask"]]
        words, asked = index["word"].tolist(), ask["word"].tolist()
        found = near_words(words, asked, bool(part["prefix"].iloc[0])) if words and asked else []
        n, m = index["n"].tolist(), ask["n"].tolist()
        return pd.DataFrame([(asked[q], m[q], words[w], n[w]) for q, w in found],
                            columns=["word", "n", "near", "near_n"])

    return dealt.groupBy("prefix", "bin", "block", "chunk").applyInPandas(search, PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: chains are halved each round."""
    held = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = held.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        held = cut(held.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"),
                                                        F.col("beyond").isNotNull().alias("moved")))
        if held.where("moved").isEmpty():
            return held.select("word", "root")
        held = held.drop("moved")


def spelling_variants(df: DataFrame, least: int = 6, least_n: int = 5, every: int = 199, ratio: int = 5,
                      doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every frequent word of ``df``."""
    prepare(df.sparkSession)
    if least < 2 * HALF:
        raise ValueError(f"words need at least {2 * HALF} code points")
    words = cut(word_counts(df, least, least_n, every, doc_id, text))
    best = F.min(F.struct((-F.col("near_n")).alias("down"), F.col("near").alias("near"))).alias("best")
    near = near_pairs(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    strong = -F.col("best.down") >= ratio * F.col("n")
    near = cut(near.select("word", "n_near", F.when(strong, F.col("best.near")).alias("form"),
                           F.when(strong, -F.col("best.down")).alias("form_n")))
    chains = roots(near.where("form is not null"))
    return (words.join(near, "word", "left").join(chains, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_n").cast("long").alias("form_n")))
