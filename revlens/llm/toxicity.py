"""Toxicity by weak supervision.

Lexicons are induced from a bounded sample of labelled rows, and each, with
fixed text patterns, is a voter that says toxic, clean or nothing.  A
generative label model estimates by expectation maximisation how each voter
behaves on toxic and clean texts (the marking is one voter among them);
voters that stay correlated given the class are modelled jointly.  A linear
classifier over the lexicon entries and patterns is then trained on the
posterior labels and scores every whole text.

Defined cases: null and empty texts get the score of a text without any
entry; repeated rows get equal scores; equal texts labelled differently count
as one row with the majority's label (ties: not toxic); without labelled rows
of both classes every score is 0.25 (not toxic); other columns aren't read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.linear import fit_logistic, sigmoid
from revlens.llm.tables import cut, prepare

#: Labelled rows that the classifier is fitted on, at most.
LABELLED_ROWS = 20_000
#: Lexicon entries kept, at most, the toxic rows that each must be seen in,
#: the least log ratio of its shares in toxic and clean rows, and the least
#: evidence: minus the log (bound) of the chance of so many toxic rows.
ENTRIES, LEAST_ROWS, LEAST_RATIO, LEAST_EVIDENCE = 2_000, 4, 2.0, 15.0
#: Beginnings of words that are entries too.
STEMS = (4, 5, 6, 7)
#: Lexicon voters of each kind; entries are dealt over them by strength.
LEXICONS = 4

_WORD = re.compile(r"[^\W\d_]+")
# Pattern voters.
PATTERNS = {
    "shouting": re.compile(r"\b[^\W\d_a-zà-ÿ]{4,}\b(?:\W+[^\W\d_a-zà-ÿ]{4,}\b)+"),
    "exclaiming": re.compile(r"!{2,}"),
    "addressed": re.compile(r"\byou(?:'re| are)\b", re.IGNORECASE),
    "masked": re.compile(r"\b\w+[*#$%&@]{2,}"),
}


def terms(text: str) -> set[str]:
    """Distinct words, and stems written with a trailing hyphen."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "-" for w in words for n in STEMS if len(w) >= n}


class Lexicon:
    """Entries found in a text by one automaton."""

    def __init__(self, entries: list[str]) -> None:
        self.entries = entries
        self.find = ahocorasick.Automaton()
        by_key: dict[str, list[tuple[int, bool]]] = {}
        for i, e in enumerate(entries):
            by_key.setdefault(e.rstrip("-"), []).append((i, e.endswith("-")))
        for key, own in by_key.items():
            self.find.add_word(key, (len(key), own))
        if entries:
            self.find.make_automaton()

    def __call__(self, text: str) -> list[int]:
        """Places of the entries in ``text``, then those of the patterns."""
        low, found = text.lower(), set()
        letter = lambda at: 0 <= at < len(low) and low[at].isalpha()
        if self.entries:
            for end, (size, own) in self.find.iter(low):
                if not letter(end - size):
                    whole = not letter(end + 1)
                    found.update(i for i, stem in own if stem or whole)
        n = len(self.entries)
        return sorted(found) + [n + k for k, p in enumerate(PATTERNS.values()) if p.search(text)]


def _classes(votes: np.ndarray, start: np.ndarray, prior: float, rounds: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Two-class mixture of independent categorical voters: posterior of the
    positive class, and the log ratios of every voter's categories."""
    kinds = [np.unique(v, return_inverse=True) for v in votes.T]
    one_hot = [np.eye(len(k))[inverse] for k, inverse in kinds]
    post = start
    for _ in range(rounds):
        ratios = []
        for own in one_hot:
            yes, no = post @ own, (1 - post) @ own
            ratios.append(np.log((yes + 0.5) / (yes.sum() + 0.5 * len(yes)))
                          - np.log((no + 0.5) / (no.sum() + 0.5 * len(no))))
        post = sigmoid(np.log(prior / (1 - prior)) + sum(own @ r for own, r in zip(one_hot, ratios)))
    return post, ratios


def cliques(votes: np.ndarray, post: np.ndarray, least: float = 0.2, largest: int = 5) -> list[list[int]]:
    """Groups of voters that stay correlated given the class."""
    together = np.zeros((votes.shape[1],) * 2)
    for p in (post, 1 - post):
        total = max(p.sum(), 1e-9)
        centred = votes - (p @ votes) / total
        cov = (centred * p[:, None]).T @ centred / total
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        together = np.maximum(together, np.abs(cov / np.outer(sd, sd)))
    groups = [[i] for i in range(votes.shape[1])]
    strong = sorted(((together[i, j], i, j) for i in range(len(together)) for j in range(i)), reverse=True)
    for size, i, j in strong:
        if size < least:
            break
        a, b = (next(g for g in groups if x in g) for x in (i, j))
        if a is not b and len(a) + len(b) <= largest:
            groups.remove(b)
            a += b
    return groups


def label_model(votes: np.ndarray, start: np.ndarray, prior: float) -> np.ndarray:
    """Posterior of the positive class from a table of votes (1, 0 for
    nothing, -1).

    Expectation maximisation estimates how often every voter says what in
    each class, that is its accuracy and coverage.  Voters that are then
    found correlated within the classes become one voter whose category is
    their joint vote, and the model is estimated again.  The last voter
    (the marking) stays by itself.
    """
    post, _ = _classes(votes, start, prior)
    joint = [votes[:, -1]]
    for group in cliques(votes[:, :-1], post):
        joint.append(((votes[:, group] + 1) * 3.0 ** np.arange(len(group))).sum(1))
    return _classes(np.stack(joint, 1), start, prior)[0]


def chance_evidence(hits: int, n: int, share: float) -> float:
    """Chernoff: the chance of ``hits`` or more in ``n`` is at most exp(-result)."""
    p = hits / n
    return n * (p * np.log(p / share) + (1 - p) * np.log(max(1 - p, 1e-12) / (1 - share)))


def voters(entries: list[str]) -> list[np.ndarray]:
    """Places of each lexicon voter: tiers of the words and of the stems, surest first."""
    out = []
    for stem in (False, True):
        own = np.array([i for i, e in enumerate(entries) if e.endswith("-") == stem], int)
        out += [tier for tier in np.array_split(own, LEXICONS) if len(tier)]
    return out


def _dense(found: list, width: int) -> np.ndarray:
    x = np.zeros((len(found), width))
    for row, own in zip(x, found):
        row[np.asarray(own, int)] = 1
    return x


def fit(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """Entries and classifier weights (the last is the constant) from a
    bounded labelled sample with columns text and label."""
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            seen = {0: Counter(), 1: Counter()}
            for own, label in zip(part["text"], part["label"]):
                seen[int(label)].update(terms(own or ""))
            yield pd.DataFrame([(t, n, seen[0][t]) for t, n in seen[1].items()], columns=["term", "toxic", "clean"])

    def count_clean(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            seen: Counter = Counter()
            for own in part["text"]:
                seen.update(wanted & terms(own or ""))
            yield pd.DataFrame(list(seen.items()), columns=["term", "clean"])

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return [], np.append(np.zeros(len(PATTERNS)), np.log(0.25 / 0.75))
    often = (sample.where("label = 1").mapInPandas(count, "term string, toxic long, clean long")
             .groupBy("term").agg(F.sum("toxic").alias("toxic")).where(F.col("toxic") >= LEAST_ROWS)
             .orderBy(F.desc("toxic"), "term").limit(50 * ENTRIES).collect())
    wanted = {r["term"] for r in often}
    against = {r["term"]: r["n"] for r in sample.where("label = 0")
               .mapInPandas(count_clean, "term string, clean long")
               .groupBy("term").agg(F.sum("clean").alias("n")).collect()}
    evidence = {}
    for r in often:
        yes, no = r["toxic"], against.get(r["term"], 0)
        if np.log((yes + 0.5) / (toxic + 1)) - np.log((no + 0.5) / (clean + 1)) >= LEAST_RATIO:
            evidence[r["term"]] = chance_evidence(yes, yes + no, toxic / (toxic + clean))
    entries = sorted((t for t, v in evidence.items() if v >= LEAST_EVIDENCE), key=lambda t: (-evidence[t], t))[:ENTRIES]
    width = len(entries) + len(PATTERNS)

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(entries)
        for part in parts:
            yield pd.DataFrame({"label": part["label"], "found": [lexicon(t or "") for t in part["text"]]})

    seen = sample.mapInPandas(find, "label int, found array<int>").toPandas()
    # Most texts hold no entry: rows of equal entries are one row of x.
    places: dict[tuple, int] = {}
    row = np.array([places.setdefault(tuple(f), len(places)) for f in seen["found"]])
    x = _dense(list(places), width)
    said = [np.where(x[:, own].any(1), 1, 0) for own in voters(entries)]
    said += [x[:, len(entries) + k] for k in range(len(PATTERNS))]
    said.append(np.where(x[:, :len(entries)].any(1), 0, -1))  # no entry of any lexicon: clean
    marked = (seen["label"] == 1).to_numpy()
    votes = np.column_stack([np.stack(said, 1)[row], np.where(marked, 1, -1)])  # the marking, as one voter among many
    post = label_model(votes.astype(float), np.where(marked, 0.9, 0.02), toxic / (toxic + clean))
    times = np.bincount(row, minlength=len(x))
    return entries, fit_logistic(x, np.bincount(row, weights=post, minlength=len(x)) / times, 0.2, times=times)


def toxicity_scores(df: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    rows: int = LABELLED_ROWS) -> Column:
    """Score column for ``df``: probability that a text is toxic.

    ``labelled`` has columns doc_id and label (0 or 1); at most ``rows`` of
    them, dealt by a hash of the id, are used.
    """
    prepare(df.sparkSession)
    chosen = (labelled.where("label in (0, 1) and doc_id is not null")
              .select(F.col("doc_id").cast("long").alias("__id"), F.col("label").cast("int").alias("label"))
              .orderBy(F.xxhash64("__id"), "__id", "label").limit(rows))
    sample = cut(df.select(df[doc_id].cast("long").alias("__id"), df[text].alias("text"))
                 .join(F.broadcast(chosen), "__id").groupBy("text")
                 .agg((F.avg("label") > 0.5).cast("int").alias("label")))
    entries, weights = fit(sample)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = Lexicon(entries)
        for texts in parts:
            yield pd.Series([float(sigmoid(weights[-1] + weights[lexicon(t or "")].sum())) for t in texts], dtype=float)

    return score(F.col(text))
