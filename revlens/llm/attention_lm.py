"""Language-model scores of whole texts.

A text is its lower-cased words, each with a space before it, and an end, as
subword ids.  Every subword and the end is predicted once by the causal
self-attention model (``attention``) from the subwords before it in its
window; the sum is the log probability of the text's subword sequence.

Training documents are dealt by a hash of id and text to shards of bounded
text.  The model starts from a bounded sample; then every shard trains it, in
an order by the hash, on all windows of all its documents.  The shards' rows
are averaged, weighted by the squared gradients that each gathered there, in
a tree.  So a score does not depend on how the files are split.

Word counts (for the base score) and subword counts cover all training
documents.

Defined cases: a null or empty text is the end alone; repeated rows are
scored each; an empty table gives no rows; without training documents the
base counts are 0 and both scores are those of uniform guesses; other
columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.attention import Attention, RowSteps, Scorer, batch_of, class_edges, gradient, windows
from revlens.llm.bpe import CachedIds, cached_ids
from revlens.llm.tables import cut, prepare

#: Most frequent words whose counts every task holds; those of others are joined.
HEAD_WORDS = 300_000
#: Documents that the model starts from, the windows of a step there, and the
#: steps, as a share of which the step size falls.
START_ROWS, START_BATCH, START_STEPS = 1_500, 24, 3_000
START_RATE, RATE, STEP_WINDOWS = 0.2, 0.05, 256
#: Bytes of training text per shard: at least so many shards of the lower
#: size as FEW, beyond them shards grow up to the upper size.
SHARD_BYTES, LARGE_SHARD, FEW = 32 << 20, 256 << 20, 64
#: Shards added up by one task of the averaging tree, and rows of a block there.
FAN, BLOCK = 32, 8192
#: Remembered words per worker process, and their ids; emptied when full.
MEMORY, MEMORY_IDS = 400_000, 4_000_000
#: Words looked up together.
RUN = 1 << 16
#: The vocabulary's special id, used for the end of a text; other ids are smaller.
END_ID = 50256
#: The word that stands for the end; words hold no space.
END = b" "


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


@dataclass
class Tables:
    """Bounded tables sent to every task."""

    tokenizer: str
    number: np.ndarray  # id -> place by falling frequency
    counts: np.ndarray  # of the places, in training
    edges: np.ndarray  # classes of the places
    head: np.ndarray  # sorted hashes of the most frequent words
    head_counts: np.ndarray


class Sequences(NamedTuple):
    """Subwords of texts behind each other, what is shown at each place (the
    subword before it; the end before a text), subwords and words (its end
    counts as one) per text; and, if asked for, counts and hashes of these words."""

    tokens: np.ndarray
    shown: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    hashed: np.ndarray


class _Places(dict):
    """Place of every remembered word, -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Words:
    """Words remembered as places in arrays of their ids, counts (-1 unless a
    head word) and hashes.  The end of a text is the word of place 0."""

    def __init__(self, tables: Tables) -> None:
        self.tables = tables
        self.encode = cached_ids(tables.tokenizer)
        self.end_count = int(tables.counts[tables.number[END_ID]])
        self.forget()

    def forget(self) -> None:
        self.places = _Places({END: 0})
        self.held = 1  # ids in use
        self.ids = np.full(1, self.tables.number[END_ID], np.uint16)  # END_ID is the largest
        self.size, self.start = np.ones(1, np.int32), np.zeros(1, np.int64)
        self.count, self.hashed = np.full(1, self.end_count), np.zeros(1, np.int64)

    def learn(self, new: list[bytes]) -> None:
        t = self.tables
        flat, size = flat_ids(self.encode, new)
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new)).view(np.int64)
        count = np.full(len(new), -1)
        if len(t.head):
            i = np.minimum(np.searchsorted(t.head, hashed), len(t.head) - 1)
            count = np.where(t.head[i] == hashed, t.head_counts[i], -1)
        known, end = len(self.places), self.held
        self.ids = _longer(self.ids, end, t.number[flat])
        self.size, self.start = _longer(self.size, known, size), _longer(self.start, known, end + np.cumsum(size) - size)
        self.count, self.hashed = _longer(self.count, known, count), _longer(self.hashed, known, hashed)
        self.held += len(flat)
        self.places.update(zip(new, range(known, known + len(new))))

    def _at(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def run(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words' subwords behind each other, and the words' places."""
        at = self._at(words)
        new = np.flatnonzero(at < 0)
        if len(new):
            unknown = {words[i] for i in new.tolist()}
            if len(self.places) + len(unknown) > MEMORY or self.held > MEMORY_IDS:
                self.forget()
                new, unknown = np.arange(len(words)), set(words) - {END}
            self.learn(list(unknown))
            at[new] = self._at([words[i] for i in new.tolist()])
        size = self.size[at]
        past = np.cumsum(size, dtype=np.int64)
        from_ = np.repeat(self.start[at] - (past - size), size)
        from_ += np.arange(len(from_))
        return self.ids[from_], at

    def sequences(self, texts: list[str | None], counted: bool = False) -> Sequences:
        """The texts' subwords and words; at most RUN words are looked up at a time."""
        none = np.zeros(0, np.int64)
        tokens, sizes, counts, hashed, each = [], [], [], [], []

        def flush(words: list[bytes]) -> None:
            flat, at = self.run(words)
            tokens.append(flat)
            sizes.append(self.size[at])
            if counted:
                counts.append(self.count[at])
                hashed.append(self.hashed[at])

        pending: list[bytes] = []
        for text in texts:
            own = words_of(text)
            own.append(END)
            each.append(len(own))
            pending.extend(own)
            whole = len(pending) // RUN * RUN
            for i in range(0, whole, RUN):
                flush(pending[i:i + RUN])
            del pending[:whole]
        if not each:
            return Sequences(none, none, none, none, none, none)
        if pending:
            flush(pending)
        each = np.array(each)
        lengths = np.add.reduceat(np.concatenate(sizes), np.cumsum(each) - each, dtype=np.int64)
        flat = np.concatenate(tokens).astype(np.int32)
        shown = np.empty_like(flat)
        shown[1:] = flat[:-1]
        shown[np.cumsum(lengths) - lengths] = self.tables.number[END_ID]
        return Sequences(flat, shown, lengths, each, *((np.concatenate(counts), np.concatenate(hashed)) if counted else (none, none)))


def _longer(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """The first ``used`` elements and then ``more``; grows by half at least."""
    if used + len(more) > len(held):
        grown = np.empty(max(used + len(more), len(held) * 3 // 2), held.dtype)
        grown[:used] = held[:used]
        held = grown
    held[used:used + len(more)] = more
    return held


def flat_ids(encode: CachedIds, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words, each with a space before it, behind each other, and
    how many each word has."""
    texts = [w.decode() for w in words]
    alone = [not _odd(t) for t in texts]
    raw = iter(encode.pieces([t for t, a in zip(texts, alone) if a]))
    flat = [next(raw) if a else encode.ordinary(" " + t).tobytes() for t, a in zip(texts, alone)]
    size = np.fromiter(map(len, flat), np.int32, len(flat)) // encode.kind().itemsize
    return np.frombuffer(b"".join(flat), encode.kind), size


def _odd(word: str) -> bool:
    """Whether some white space beyond ASCII makes the word's pieces depend on each other."""
    return word[:1].isspace() or word[-1:].isspace()


@functools.lru_cache(maxsize=1)  # a worker outlives the queries whose words it holds
def _words_for(broadcast) -> Words:
    return Words(broadcast.value)


def count_words(docs: DataFrame) -> DataFrame:
    """(h, word, n) of every distinct word of the column text; n counts the
    rows that aren't held_out, and may be 0."""
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            seen: Counter = Counter()
            for text, out in zip(part["text"], part["held_out"]):
                own = words_of(text)
                seen.update(dict.fromkeys(own, 0) if out else own)
            own = list(seen)
            yield pd.DataFrame({"h": np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own)).view(np.int64),
                                "word": pd.Series(own, dtype=object), "n": np.fromiter(seen.values(), np.int64, len(own))})

    return (docs.select("text", "held_out").mapInPandas(count, "h long, word binary, n long")
            .groupBy("h", "word").agg(F.sum("n").alias("n")))


def _largest(df: DataFrame, count: str, bound: int) -> DataFrame:
    """The rows of at most ``bound`` with the largest counts: whole levels of
    halving counts, found from a histogram."""
    levels = {r["level"]: r["count"] for r in
              df.groupBy(F.floor(F.log2(count)).alias("level")).count().collect()}
    kept, least = 0, None
    for level in sorted(levels, reverse=True):
        if kept + levels[level] > bound:
            break
        kept, least = kept + levels[level], level
    return df.where(F.lit(False) if least is None else F.col(count) >= float(2 ** least))


def subword_counts(words: DataFrame, tokenizer: str) -> np.ndarray:
    """Training count of every id, from the counts of all distinct words."""
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = cached_ids(tokenizer)
        for part in parts:
            flat, size = flat_ids(encode, part["word"].tolist())
            times = np.repeat(part["n"].to_numpy(), size)
            ids, at = np.unique(flat.astype(np.int64), return_inverse=True)
            yield pd.DataFrame({"id": ids, "n": np.bincount(at, weights=times, minlength=len(ids)).astype(np.int64)})

    found = (words.where("n > 0").select("word", "n").mapInPandas(count, "id long, n long")
             .groupBy("id").agg(F.sum("n").alias("n")).toPandas())  # at most the vocabulary
    out = np.zeros(END_ID + 1)
    out[found["id"].to_numpy(np.int64)] = found["n"].to_numpy()
    return out


def build_tables(words: DataFrame, documents: int, tokenizer: str) -> Tables:
    """Bounded tables from the counts of all training words."""
    counts = subword_counts(words, tokenizer)
    counts[END_ID] = documents
    order = np.argsort(-counts, kind="stable")
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order))
    head = _largest(words.where("n > 0").select("h", "n"), "n", HEAD_WORDS).toPandas().sort_values("h")
    return Tables(tokenizer, number, counts[order], class_edges(counts[order]),
                  head["h"].to_numpy(np.int64), head["n"].to_numpy(np.int64))


def shard_count(size: int) -> int:
    """Shards for so many bytes of training text, whatever their files."""
    return max(1, min(FEW, -(-size // SHARD_BYTES)), -(-size // LARGE_SHARD))


def _train(model: Attention, steps: RowSteps, words: Words, texts: list[str | None]) -> None:
    """Steps over all windows of the texts, in order."""
    edges = words.tables.edges
    tokens, shown, lengths, *_ = words.sequences(texts)
    places = windows(lengths)
    for i in range(0, len(places[0]), STEP_WINDOWS):
        ids, want = batch_of(tokens, shown, *(p[i:i + STEP_WINDOWS] for p in places))
        steps.step(gradient(model, edges, ids, want)[1], int((want >= 0).sum()))


def _begin(model: Attention, words: Words, texts: list[str | None]) -> RowSteps:
    """Falling steps over drawn windows of a bounded sample of texts: as many
    turns as START_STEPS allow, ten at most."""
    edges = words.tables.edges
    tokens, shown, lengths, *_ = words.sequences(texts)
    places = windows(lengths)
    steps = RowSteps(model)
    each = -(-len(places[0]) // START_BATCH)
    total, done = min(START_STEPS, 10 * each), 0
    for turn in range(10):
        drawn = np.random.default_rng(turn).permutation(len(places[0]))
        for i in range(0, len(drawn), START_BATCH):
            if done >= total:
                return steps
            ids, want = batch_of(tokens, shown, *(p[drawn[i:i + START_BATCH]] for p in places))
            steps.rate = START_RATE * (1 - done / total) + 1e-3
            steps.step(gradient(model, edges, ids, want)[1], int((want >= 0).sum()))
            done += 1
    return steps


def _added(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that any part of a block holds, their weights and weighted sums."""
    group = group.sort_values("shard")
    parts = [(np.frombuffer(r, np.int32), np.frombuffer(w, np.float64), np.frombuffer(v, np.float64).reshape(-1, width))
             for r, w, v, width in zip(group["rows"], group["weight"], group["value"], group["width"])]
    rows = np.unique(np.concatenate([p[0] for p in parts]))
    weight, value = np.zeros(len(rows)), np.zeros((len(rows), parts[0][2].shape[1]))
    for own, w, v in parts:
        at = np.searchsorted(rows, own)
        weight[at] += w
        value[at] += v
    return rows, weight, value


_PART = "shard long, array int, block int, width int, rows binary, weight binary, value binary"


def average(parts: DataFrame, shards: int) -> list:
    """Sums of all shards' parts, FAN of them a task and level."""
    def add(group: pd.DataFrame) -> pd.DataFrame:
        rows, weight, value = _added(group)
        first = group[["array", "block", "width"]].iloc[:1].reset_index(drop=True)
        return first.assign(shard=group["shard"].iloc[0] // FAN, rows=[rows.astype(np.int32).tobytes()],
                            weight=[weight.tobytes()], value=[value.tobytes()])[[c.split()[0] for c in _PART.split(", ")]]

    while True:
        parts = parts.withColumn("__to", F.floor(F.col("shard") / FAN)).groupBy("array", "block", "__to").applyInPandas(add, _PART)
        shards = -(-shards // FAN)
        if shards <= 1:
            return parts.collect()  # one model, in blocks


def fit_attention(train: DataFrame, sent, size: int) -> Attention:
    """Start on a bounded sample, then train on all windows of all shards and
    average.  ``size`` is the training text's bytes."""
    tables = sent.value
    model = Attention.fresh(tables.counts, tables.edges)
    dealt = train.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("deal"))
    begin = dealt.select("deal", "text").orderBy("deal", "text").limit(START_ROWS)

    def start(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = [t for part in parts for t in part["text"]]
        if texts:
            own = model.copy()
            steps = _begin(own, _words_for(sent), texts)
            yield pd.DataFrame({"model": [b"".join(a.tobytes() for a in own.arrays())],
                                "squares": [b"".join(a.tobytes() for a in steps.squares)]})

    begun = begin.repartition(1).sortWithinPartitions("deal", "text").select("text").mapInPandas(
        start, "model binary, squares binary").collect()
    if not begun:
        return model
    shapes = [a.shape for a in model.arrays()]
    cuts = np.cumsum([0, *(a * b for a, b in shapes)])
    flat = np.frombuffer(begun[0]["model"], np.float32)
    begun_model = Attention(*(flat[i:j].reshape(shape) for i, j, shape in zip(cuts, cuts[1:], shapes)))
    begun_squares = np.split(np.frombuffer(begun[0]["squares"], np.float32), np.cumsum([a for a, _ in shapes])[:-1])
    held = train.sparkSession.sparkContext.broadcast((begun_model, begun_squares))
    shards = shard_count(size)

    def refine(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, before = held.value
        words, shard, own, steps = _words_for(sent), None, None, None
        for part in parts:
            for number, texts in part.groupby("shard", sort=True)["text"]:
                if number != shard:
                    if own is not None:
                        yield from _emit(int(shard), own, steps, before)
                    shard, own = number, first.copy()
                    steps = RowSteps(own, [s.copy() for s in before], RATE)
                _train(own, steps, words, texts.tolist())
        if own is not None:
            yield from _emit(int(shard), own, steps, before)

    numbered = dealt.select(F.pmod("deal", F.lit(shards)).cast("int").alias("shard"), "deal", "text")
    parts = (numbered.repartitionById(shards, "shard").sortWithinPartitions("shard", "deal", "text")
             .select("shard", "text").mapInPandas(refine, _PART))
    arrays = [a.copy() for a in begun_model.arrays()]
    for r in average(cut(parts), shards):
        rows = np.frombuffer(r["rows"], np.int32)
        value = np.frombuffer(r["value"], np.float64).reshape(-1, r["width"])
        arrays[r["array"]][rows] = value / np.frombuffer(r["weight"], np.float64)[:, None]
    return Attention(*arrays)


def _emit(shard: int, model: Attention, steps: RowSteps, before: list[np.ndarray]) -> Iterator[pd.DataFrame]:
    """Rows that the shard has moved, weighted by what it added to their squares."""
    for number, (a, now, old) in enumerate(zip(model.arrays(), steps.squares, before)):
        weight = now.astype(np.float64) - old
        moved = np.flatnonzero(weight > 0)
        for block in np.unique(moved // BLOCK):
            rows = moved[moved // BLOCK == block]
            w = weight[rows]
            yield pd.DataFrame({"shard": [shard], "array": number, "block": int(block), "width": a.shape[1],
                                "rows": [rows.astype(np.int32).tobytes()], "weight": [w.tobytes()],
                                "value": [(a[rows] * w[:, None]).tobytes()]})


def lm_scores(df: DataFrame, tokenizer: str, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    prepare(df.sparkSession)
    spark = df.sparkSession
    docs = df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text"), held_out.alias("held_out"))
    train = docs.where("not held_out")
    words = cut(count_words(docs))
    documents, size = train.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    learnt = words.where("n > 0").agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    total, distinct = learnt["n"] + documents, learnt["v"] + (documents > 0)
    below = 0.1 * (distinct + 1) + total
    sent = spark.sparkContext.broadcast(build_tables(words, documents, tokenizer))
    fitted = spark.sparkContext.broadcast(fit_attention(train, sent, size))
    log_base = lambda c: np.log10((c + 0.1) / below)

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _words_for(sent)
        scorer = Scorer(fitted.value, known.tables.edges)
        for part in parts:
            if not len(part):
                continue
            tokens, shown, lengths, each, counts, hashed = known.sequences(part["text"].tolist(), counted=True)
            first = np.cumsum(each) - each
            head = counts >= 0
            out = part[["doc_id", "held_out"]].reset_index(drop=True)
            out["n_tokens"] = each
            # the end is known where there are training documents
            out["head_known"] = np.add.reduceat(head, first, dtype=np.int64) - (documents == 0)
            out["head_base"] = np.add.reduceat(np.where(head, log_base(np.maximum(counts, 0)), 0), first)
            out["score"] = np.add.reduceat(scorer.score(tokens, shown, lengths), np.cumsum(lengths) - lengths) / math.log(10)
            tails = [np.unique(h[~k], return_counts=True) for h, k in zip(np.split(hashed, first[1:]), np.split(head, first[1:]))]
            out["tail_h"] = pd.Series([h for h, _ in tails], dtype=object)
            out["tail_n"] = pd.Series([c for _, c in tails], dtype=object)
            yield out

    scored = cut(docs.mapInPandas(score, "doc_id long, held_out boolean, n_tokens long, head_known long, "
                                         "head_base double, score double, tail_h array<long>, tail_n array<long>")
                 .withColumn("row", F.monotonically_increasing_id()))
    tail = (scored.select("row", F.explode(F.arrays_zip("tail_h", "tail_n")).alias("t"))
            .select("row", F.col("t.tail_h").alias("h"), F.col("t.tail_n").alias("times")))
    met = tail.join(words.select("h", "n"), "h").groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * F.log10((F.col("n") + 0.1) / F.lit(float(below)))).alias("tail_base"))
    return scored.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
        "score")
