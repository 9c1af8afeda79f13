"""Byte-level BPE on whole texts: exact prefix counts and cached ids.

Both classes split a text at its single spaces.  A pretoken never continues
across a space that follows a non-space, so the piece between two spaces,
with the space before it, is tokenised on its own and remembered; a text is
the concatenation of remembered pieces.  Texts where a space touches other
white space, or that hold the special string, take the general path.
"""

from __future__ import annotations

import functools
import json
from array import array

import numpy as np
import public_tokenizers
import regex

#: Remembered pieces per worker process; the memory is emptied when full.
MEMORY = 1_000_000
#: Longest piece worth remembering, in characters.
REMEMBERED_CHARS = 64
_SPACES = regex.compile(r"\s{2,}(?=\S)")


def _alphabet() -> dict[str, int]:
    """Printable stand-in character -> byte, the byte-level BPE convention."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Remembered:
    """Space-separated pieces looked up in a bounded memory."""

    def __init__(self) -> None:
        self.memory: dict[str, object] = {}

    def piece(self, piece: str):
        """Value of ``' ' + piece``; None where it isn't independent of its neighbours."""
        raise NotImplementedError

    def pieces(self, pieces: list[str]) -> list:
        """Values of several pieces."""
        return [self.piece(p) for p in pieces]

    def values(self, parts: list[str]) -> list:
        memory = self.memory
        found = list(map(memory.get, parts))
        if None in found:
            new = {p for p, v in zip(parts, found) if v is None}
            apart = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
            own = dict.fromkeys(new, False) | dict(zip(apart, self.pieces(apart)))
            if len(memory) >= MEMORY:
                memory.clear()
            memory.update((p, v) for p, v in own.items() if len(p) <= REMEMBERED_CHARS)
            found = [own[p] if v is None else v for p, v in zip(parts, found)]
        return found


class ByteBpe:
    """Vocabulary, merges and pretoken pattern of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _alphabet()
        model = spec["model"]
        spell = {t: bytes(alphabet[c] for c in t) for t in model["vocab"] if all(c in alphabet for c in t)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {b: model["vocab"][t] for t, b in spell.items() if t not in self.special}
        self.longest = max(map(len, self.ids))
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, whole = model["vocab"][left], model["vocab"][right], model["vocab"][left + right]
            self.rank[a, b] = rank
            self.parts[whole] = (rank, a, b)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self._edge: dict[int, bool] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Symbols that touch one edge of ``token`` while it is built, with
        the merge rank that consumes each (infinite for the token itself)."""
        out, consumed = [], float("inf")
        while True:
            out.append((token, consumed))
            if token not in self.parts:
                return out
            consumed, *both = self.parts[token]
            token = both[side]

    def adjacent(self, left: int, right: int) -> bool:
        """Whether BPE leaves the border between two neighbouring tokens.

        Merges run in rank order, so a merge across the border fires when
        its rank comes before those that consume its two symbols; of equal
        merges the leftmost goes first.
        """
        key = left << 20 | right
        kept = self._edge.get(key)
        if kept is None:
            kept = not any(
                (m := self.rank.get((x, y))) is not None and m < used_x and m <= used_y
                for x, used_x in self._spine(left, 1) for y, used_y in self._spine(right, 0))
            if len(self._edge) >= 2_000_000:
                self._edge.clear()
            self._edge[key] = kept
        return kept

    def prefix_dp(self, word: bytes) -> list[int]:
        """Token count of every byte prefix of one pretoken.

        The last token of a prefix is the only vocabulary entry ending there
        that may follow the last token of the prefix before it.
        """
        n, longest, token_of, kept = len(word), self.longest, self.ids.get, self._edge.get
        last, count, begin = [0] * (n + 1), [0] * (n + 1), 0
        for end in range(1, n + 1):
            # Most often the last token grows by a byte or the byte stands alone.
            start = begin
            token = token_of(word[start:end])
            if token is None or start and not (
                    kept(last[start] << 20 | token) or self.adjacent(last[start], token)):
                for start in range(end - 1, max(end - longest, 0) - 1, -1):
                    token = token_of(word[start:end])
                    if token is not None and (start == 0 or kept(last[start] << 20 | token)
                                              or self.adjacent(last[start], token)):
                        break
            last[end], count[end], begin = token, count[start] + 1, start
        return count


class PrefixCounts(Remembered):
    """Exact token count of the text up to every character."""

    #: Contractions that the pattern takes whole; cut after the first letter,
    #: the apostrophe and the letter are pretokens of their own.
    _CUT = ("'re", "'ve", "'ll")

    def __init__(self, path: str) -> None:
        super().__init__()
        self.bpe = ByteBpe(path)
        self.words: dict[str, np.ndarray] = {}

    def word(self, word: str) -> list[int]:
        kept = self.words.get(word)
        if kept is None:
            kept = self.bpe.prefix_dp(word.encode())
            if len(kept) > len(word) + 1:
                at = 0
                kept = [kept[at := at + (1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4)]
                        for c in word]
            else:
                del kept[0]
            if word in self._CUT:
                kept[1] = 2
            if len(word) <= REMEMBERED_CHARS:
                if len(self.words) >= MEMORY // 4:
                    self.words.clear()
                self.words[word] = kept
        return kept

    def ordinary(self, text: str) -> array:
        """Counts by the pattern alone, without the memory of pieces."""
        out, base = array("I"), 0
        for own in map(self.word, self.bpe.pattern.findall(text)):
            out.extend([c + base for c in own] if base else own)
            base += own[-1]
        # A prefix that ends inside white space holds the run so far as one pretoken.
        for m in _SPACES.finditer(text):
            before = out[m.start() - 1] if m.start() else 0
            out[m.end() - 1] = before + self.word(m.group())[-1]
        return out

    def piece(self, piece: str) -> bytes:
        return self.ordinary(" " + piece).tobytes()

    def general(self, text: str) -> np.ndarray:
        out, base = [], 0
        marks = list(self.bpe.special)
        cuts = regex.split("(" + "|".join(map(regex.escape, marks)) + ")", text)
        for k in range(0, len(cuts), 2):
            own, mark = cuts[k], cuts[k + 1] if k + 1 < len(cuts) else ""
            counts = np.array(self.ordinary(own + mark), np.uint32)
            if mark:
                counts[-1] = (counts[len(own) - 1] if own else 0) + 1
            if len(counts):
                out.append(counts + base)
                base = int(out[-1][-1])
        return np.concatenate([np.zeros(1, np.uint32), *out])

    def __call__(self, text: str) -> np.ndarray:
        """Element i is the token count of ``text[:i]``, as the library gives it."""
        if not text:
            return np.zeros(1, np.uint32)
        if any(mark in text for mark in self.bpe.special):
            return self.general(text)
        first, *rest = text.split(" ")
        found = self.values(rest)
        if False in found or first[-1:].isspace() or (not first and rest):
            return self.general(text)
        head = self.ordinary(first)
        flat = np.frombuffer(b"".join([head.tobytes(), *found]), np.uint32)
        sizes = np.array([len(head), *map(len, found)], np.int64)
        sizes[1:] //= 4
        ends = np.cumsum(sizes)
        totals = np.where(sizes > 0, flat[np.maximum(ends, 1) - 1], 0)
        out = np.empty(len(text) + 1, np.uint32)
        out[0] = 0
        out[1:] = flat + np.repeat(np.cumsum(totals) - totals, sizes).astype(np.uint32)
        return out


class CachedIds(Remembered):
    """Token ids of whole texts (uint16 or uint32), equal to the library's."""

    def __init__(self, path: str) -> None:
        super().__init__()
        import tiktoken
        bpe = ByteBpe(path)
        self.special = bpe.special
        self.kind = np.uint16 if max([*bpe.ids.values(), *bpe.special.values()]) < 1 << 16 else np.uint32
        # The engine wants tokens in merge order, single bytes first.
        spell = {i: b for b, i in bpe.ids.items()}
        order = sorted(spell, key=lambda i: (i in bpe.parts, bpe.parts.get(i, (0,))[0]))
        self.engine = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                        mergeable_ranks={spell[i]: n for n, i in enumerate(order)})
        self.final = np.array(order, self.kind)
        self.spaced = np.array([spell[i][:1] == b" " for i in order])

    def ordinary(self, text: str) -> np.ndarray:
        return self.final[self.engine.encode_ordinary(text)]

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """All at once: only the first token of a piece starts with a space."""
        if not pieces:
            return []
        own = self.engine.encode_ordinary(" " + " ".join(pieces))
        starts = np.flatnonzero(self.spaced[own])
        size = self.kind().itemsize
        raw = self.final[own].tobytes()
        ends = [*(starts[1:] * size).tolist(), len(raw)]
        return [raw[a:b] for a, b in zip((starts * size).tolist(), ends)]

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, self.kind)
        for mark, own in self.special.items():
            if mark in text:
                cuts = [self(x) for x in text.split(mark)]
                return np.concatenate([cuts[0], *(x for c in cuts[1:] for x in (np.array([own], self.kind), c))])
        first, *rest = text.split(" ")
        found = self.values(rest)
        if False in found or first[-1:].isspace() or (not first and rest):
            return self.ordinary(text)
        return np.frombuffer(b"".join([self.ordinary(first).tobytes(), *found]), self.kind)


@functools.lru_cache(maxsize=2)
def prefix_counts(path: str) -> PrefixCounts:
    """One per worker process."""
    return PrefixCounts(path)


@functools.lru_cache(maxsize=2)
def cached_ids(path: str) -> CachedIds:
    """One per worker process."""
    return CachedIds(path)
