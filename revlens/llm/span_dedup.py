"""Removal of repeated runs of sentences.

From every sentence a run goes on, and back, until it holds several sentences
and enough words; the hashes of all runs of all texts are joined globally.
Every longer run is covered by such runs inside it.  The first occurrence of a
run (smallest document id, then position) stays, and the sentences covered by
any other occurrence are removed, also by a later one in the same document.

A sentence of more than LONG words counts as several: it ends after words
chosen by their own letters and the word before, or by ; and :, so
that two copies are cut at the same places whatever stands around them.  What
stays of a repeated passage: at either edge, the part of a sentence up to the
first such place; whole, a lone sentence of at most LONG words.

Defined cases: null texts stay null and empty texts empty; a text whose
sentences are all repeated becomes empty and its row stays; rows repeated
with equal id and text count once and get equal results; other columns pass
through (names starting with ``__span`` are reserved; earlier n_sentences and
n_removed are replaced).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.tables import cut, prepare

#: A run holds at least this many sentences and words.
SENTENCES, WORDS = 2, 12
#: A sentence of more words is cut, on average after CHANCE words, at the latest after LONG.
LONG, CHANCE = 24, 8
_END = re.compile(r"(?<=[.!?])\s+|\n+")
_WORD = re.compile(r"\S+\s*")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, next start) of each sentence, or part of a long one; the text
    between is covered whole."""
    starts = [0, *(m.end() for m in _END.finditer(text))]
    out = []
    for a, b in zip(starts, [*starts[1:], len(text)]):
        if b - a > 2 * LONG and len(text[a:b].split()) > LONG:
            out += _parts(text, a, b)
        elif b > a:
            out.append((a, b))
    return out


def _parts(text: str, start: int, stop: int) -> list[tuple[int, int]]:
    """Parts of a long sentence, cut behind words chosen by the two words before the cut."""
    out, before, held = [], "", 0
    for m in _WORD.finditer(text, start, stop):
        word = m[0].rstrip().lower()
        held += 1
        if m.end() < stop and (held == LONG or word[-1] in ";:" or
                               zlib.crc32(f"{before} {word}".encode()) % CHANCE == 0):
            out.append((start, m.end()))
            start, held = m.end(), 0
        before = word
    return [*out, (start, stop)]


def runs(text: str, least_sentences: int, least_words: int) -> list[tuple[int, int, int]]:
    """(hash, first sentence, sentence after the last) of the shortest run from
    and the shortest run up to every sentence of ``text``, in order.

    Case and the kind of white space don't count.
    """
    words = [text[a:b].lower().split() for a, b in sentences(text)]
    if len(words) < least_sentences:
        return []
    totals = np.cumsum([0, *map(len, words)])
    flat = [" ".join(w) for w in words]
    places = np.arange(len(words) + 1)
    ends = np.maximum(places + least_sentences, np.searchsorted(totals, totals + least_words))
    starts = np.minimum(places - least_sentences, np.searchsorted(totals, totals - least_words, side="right") - 1)
    found = {(a, b) for a, b in zip(places.tolist(), ends.tolist()) if b < len(totals)}
    found.update((a, b) for a, b in zip(starts.tolist(), places.tolist()) if a >= 0)
    return [(xxhash.xxh3_64_intdigest("\n".join(flat[a:b])), a, b) for a, b in sorted(found)]


def span_dedup(df: DataFrame, least_sentences: int = SENTENCES, least_words: int = WORDS,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``text`` cleaned, and its n_sentences and n_removed."""
    prepare(df.sparkSession)
    keyed = df.withColumn("__span_key", F.xxhash64(df[doc_id], df[text]))

    def hashes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            own = [np.array([h for h, _, _ in runs(t, least_sentences, least_words)], np.uint64).view(np.int64)
                   for t in part["text"]]
            yield pd.DataFrame({"key": part["key"], "doc": part["doc"], "spans": pd.Series(own, dtype=object)})

    spans = cut(keyed.select(F.col("__span_key").alias("key"), df[doc_id].cast("long").alias("doc"),
                             df[text].alias("text")).where("text is not null")
                .mapInPandas(hashes, "key long, doc long, spans array<long>"))
    each = spans.select("key", "doc", F.posexplode("spans").alias("at", "span"))
    first = (each.groupBy("span").agg(F.count("*").alias("n"), F.min(F.struct("doc", "key", "at")).alias("first"))
             .where("n > 1").select("span", "first"))
    again = (each.join(first, "span")
             .where("not (key <=> first.key and at = first.at)")
             .groupBy("key").agg(F.collect_set("at").alias("__span_at")))
    marked = keyed.join(again.withColumnRenamed("key", "__span_key"), "__span_key", "left")

    @F.pandas_udf("text string, n_sentences long, n_removed long")
    def clean(texts: pd.Series, marks: pd.Series) -> pd.DataFrame:
        out = []
        for own, at in zip(texts, marks):
            cuts = sentences(own or "")
            gone: set[int] = set()
            if at is not None and len(at):
                found = runs(own, least_sentences, least_words)
                gone = {s for i in at for s in range(found[i][1], found[i][2])}
                own = "".join(own[a:b] for s, (a, b) in enumerate(cuts) if s not in gone).rstrip()
            out.append((own, len(cuts), len(gone)))
        return pd.DataFrame(out, columns=["text", "n_sentences", "n_removed"])

    kept = [F.col("__span_out.text").alias(c) if c == text else F.col(f"`{c}`")
            for c in df.columns if c not in ("n_sentences", "n_removed")]
    return (marked.withColumn("__span_out", clean(F.col(text), F.col("__span_at")))
            .select(*kept, "__span_out.n_sentences", "__span_out.n_removed"))
