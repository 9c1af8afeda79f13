"""Bidirectional FM-index over a delimited vocabulary, and one-error search.

The vocabulary is one cyclic text, ``$`` before every word.  The index holds
the sorted rotations of the text and of its reverse.  A pattern is a pair of
intervals of equal size, of the rotations that begin with it and of the
reversed ones that begin with its reverse, so it can be extended by a
character at either end.  All queries of a batch are extended at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _rotations(text: np.ndarray) -> np.ndarray:
    """Starts of the cyclic rotations in sorted order, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        pair = rank * n + np.roll(rank, -width)
        order = np.argsort(pair, kind="stable")
        sorted_pairs = pair[order]
        fresh = np.concatenate(([0], np.cumsum(sorted_pairs[1:] != sorted_pairs[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        width *= 2
        if fresh[-1] == n - 1 or width >= 2 * n:
            return order


class _Side:
    """Counts of one direction: ``under[i, c]`` of the first ``i`` last
    characters are smaller than ``c``."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        self.starts = _rotations(text)
        last = text[self.starts - 1]
        n = len(text)
        under = np.zeros((n + 1, symbols + 1), np.int32)
        under[np.arange(1, n + 1), last + 1] = 1
        np.cumsum(under, axis=0, out=under)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))[:symbols]
        np.cumsum(under, axis=1, out=under)
        self.under = under

    def step(self, low: np.ndarray, size: np.ndarray, c: np.ndarray) -> tuple:
        """Start and size of the interval one character on, and how many rows
        of the old one are followed by a smaller character."""
        a0, a1 = self.under[low, c], self.under[low, c + 1]
        b0, b1 = self.under[low + size, c], self.under[low + size, c + 1]
        return self.first[c] + a1 - a0, (b1 - b0) - (a1 - a0), b0 - a0

    def followers(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, character) of every character that extends an interval."""
        held = np.diff(self.under[low + size] - self.under[low], axis=1)
        return np.nonzero(held)


@dataclass
class _States:
    """Partial matches: their query, both intervals and their size."""
    query: np.ndarray
    low: np.ndarray       # in the direction of extension
    other: np.ndarray
    size: np.ndarray

    def pick(self, which: np.ndarray) -> "_States":
        return _States(self.query[which], self.low[which], self.other[which], self.size[which])


def _join(a: _States, b: _States) -> _States:
    return _States(*(np.concatenate(p) for p in zip(vars(a).values(), vars(b).values())))


class BidirectionalIndex:
    """Index of distinct non-empty words."""

    def __init__(self, words: list[str], alphabet: list[str]) -> None:
        """``alphabet``: every code point of words and queries, sorted."""
        self.words = words
        self.codes = {c: k + 1 for k, c in enumerate(alphabet)}
        parts = [np.concatenate(([0], self.encode(w))) for w in words]
        text = np.concatenate(parts) if parts else np.zeros(1, np.int64)
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        self.left = _Side(text, len(alphabet) + 1)          # extends to the left
        self.right = _Side(text[::-1].copy(), len(alphabet) + 1)  # extends to the right
        self.length = len(text)
        self.word_at = owner[self.left.starts] if parts else owner

    def encode(self, word: str) -> np.ndarray:
        return np.fromiter((self.codes[c] for c in word), np.int64, len(word))

    def _extend(self, states: _States, c: np.ndarray, side: _Side) -> _States:
        low, size, smaller = side.step(states.low, states.size, c)
        grown = _States(states.query, low, states.other + smaller, size)
        return grown.pick(size > 0)

    def one_error(self, exact: list[np.ndarray], other: list[np.ndarray], rightwards: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) where the word is the query with one inserted,
        deleted or replaced code point, none of it in the exact half.

        ``exact`` and ``other`` hold each query's halves in the order of
        extension, ``exact`` behind the delimiter; the other half ends with it.
        A run of equal characters is changed at its last one only, so each
        word is found once.
        """
        side = self.right if rightwards else self.left
        n = len(exact)
        whole = np.zeros(n, np.int64)
        states = _States(np.arange(n), whole, whole, np.full(n, self.length, np.int64))
        states = self._extend(states, np.zeros(n, np.int64), side)
        lengths = np.array([len(e) for e in exact], np.int64)
        begin = _padded(exact, 1)
        finished = states.pick(np.zeros(0, np.int64))
        for t in range(int(lengths.max(initial=0))):
            ends = lengths[states.query] == t
            finished = _join(finished, states.pick(ends))
            states = states.pick(~ends)
            states = self._extend(states, begin[states.query, t], side)
        clean = _join(finished, states)

        lengths = np.array([len(e) for e in other], np.int64)
        rest = _padded(other, 2)  # the delimiter (0) ends every half
        changed = clean.pick(np.zeros(0, np.int64))
        done: list[_States] = []
        for t in range(int(lengths.max(initial=0)) + 1):
            here, ahead = rest[:, t], rest[:, t + 1]
            row, c = side.followers(clean.low, clean.size)
            want = here[clean.query]
            useful = (c != 0) & (c != want[row])
            row, c = row[useful], c[useful]
            grown = self._extend(clean.pick(row), c, side)
            inserted = grown
            replaced = grown.pick(here[grown.query] != 0)
            gone = clean.pick((want != 0) & (want != ahead[clean.query]))
            changed = self._extend(_join(changed, inserted), here[np.concatenate((changed.query, inserted.query))], side)
            over = lengths[changed.query] == t  # the delimiter is matched
            done.append(changed.pick(over))
            changed = _join(changed.pick(~over), _join(replaced, gone))
            clean = clean.pick(want != 0)
            clean = self._extend(clean, here[clean.query], side)
        found = done[0]
        for d in done[1:]:
            found = _join(found, d)
        # The matched text is $word$: one row, whose start tells the word.
        start = found.other if rightwards else found.low
        return found.query, self.word_at[start] if len(start) else start


def _padded(parts: list[np.ndarray], more: int) -> np.ndarray:
    longest = max(map(len, parts), default=0) + more
    out = np.zeros((len(parts), longest), np.int64)
    for k, p in enumerate(parts):
        out[k, :len(p)] = p
    return out


def near_words(words: list[str], queries: list[str], prefix_side: bool) -> list[tuple[int, int]]:
    """(query, word) one inserted, deleted or replaced code point apart.

    With ``prefix_side`` the first half of the query is matched exactly and
    extended to the right.  Otherwise the second half is matched and extended
    to the left, and words that begin with the first half are left to the
    other search; both together give every pair once.
    """
    alphabet = sorted(set().union(*map(set, words), *map(set, queries)))
    index = BidirectionalIndex(words, alphabet)
    coded = [index.encode(q) for q in queries]
    half = [len(q) // 2 for q in queries]
    if prefix_side:
        found = index.one_error([q[:h] for q, h in zip(coded, half)], [q[h:] for q, h in zip(coded, half)], True)
    else:
        found = index.one_error([q[:h - 1 if h else None:-1] for q, h in zip(coded, half)],
                                [q[:h][::-1] for q, h in zip(coded, half)], False)
    pairs = zip(*(f.tolist() for f in found))
    if prefix_side:
        return list(pairs)
    return [(q, w) for q, w in pairs if not words[w].startswith(queries[q][:half[q]])]
