"""SentencePiece encoding and decoding by weighted paths.

A model file gives a normaliser (a leading meta space, spaces to meta
spaces), its pieces, and bytes for characters that no piece covers.  Over an
input they make a lattice whose arcs are pieces between character positions.

Unigram models weigh an arc by the piece's negative score; the shortest path
of the tropical semiring is found by relaxing the arcs from left to right, in
single precision and with the library's preference among equal paths.

Models that segment by merges have no sum of piece scores.  Their weights sit
on pairs of following arcs: 0 where merging the two pieces' text leaves their
border, infinite where it merges across.  The only path of finite weight is
the library's segmentation; it is followed from position to position, taking
at each the one arc that may come there.  The lattice is walked directly: no
machine is built and composed beforehand.  Other kinds of models, and unigram
models with user-defined pieces, without byte pieces or with scores below
-10^6, are refused.

Defined cases: a null text counts as empty; an empty text has no ids;
repeated rows are encoded each; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.bpe import Remembered
from revlens.llm.tables import prepare

META = "▁"
_SEGMENT = regex.compile(f"{META}+[^{META}]*|[^{META}]+")


#: Fields of a model file: its training settings, and in them the kind of model.
_SETTINGS, _KIND, UNIGRAM, MERGES = 2, 3, 1, 2
#: Of a piece: the field of its type, and the types of normal and user-defined ones.
_TYPE, _NORMAL, _USER = 3, 1, 4
#: How far below the lowest score a character without a piece stands (fixed by the library).
UNKNOWN_PENALTY = 10.0


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields; fixed-width values as their bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = message[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = number() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, message[at:at + size]
            at += size


def model_kind(model: bytes) -> int:
    """1 for unigram (also where none is given), 2 for merges, 3 words, 4 characters."""
    settings = b"".join(v for n, v in _fields(model) if n == _SETTINGS)
    return next((v for n, v in reversed(list(_fields(settings))) if n == _KIND), 1)


class PieceTransducer(Remembered):
    """Compiled machines of one model, with a bounded memory of words."""

    def __init__(self, path: str) -> None:
        super().__init__()
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.encode("a ﬁ  b ", out_type=str) and model.decode(model.encode(" ﬁ  b ")) != " ﬁ  b ":
            raise ValueError("only models whose normaliser keeps characters and spaces are supported")
        self.check(model.serialized_model_proto())
        size = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.kind = np.uint16 if size < 1 << 16 else np.uint32
        self.bytes = {int(n[1:-1], 16): i for i, n in enumerate(names) if model.is_byte(i)}
        self.pieces_ids = {n: i for i, n in enumerate(names) if not special[i] and not model.is_byte(i)}
        if any(META in n.lstrip(META) for n in self.pieces_ids):
            raise ValueError("pieces across words are not supported")
        self.names = names
        self.score = {n: model.get_score(i) for n, i in self.pieces_ids.items()}
        self.longest = max(map(len, self.pieces_ids))
        spelled = {i: bytes([b]) for b, i in self.bytes.items()}
        self.spell = [spelled.get(i, b"" if special[i] else n.replace(META, " ").encode()) for i, n in enumerate(names)]
        self._weight: dict[int, bool] = {}

    def check(self, model: bytes) -> None:
        """Refuse models whose segmentation isn't this one."""
        if model_kind(model) != MERGES:
            raise ValueError("only models that segment by merges are supported here")

    def merged(self, text: str) -> list[str]:
        """Merging by hand: the best-scored neighbours first, leftmost of equals."""
        own = list(text)
        while True:
            best = max(((self.score.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(own, own[1:]))),
                       default=(-np.inf, 0))
            if best[0] == -np.inf:
                return own
            at = -best[1]
            own[at:at + 2] = [own[at] + own[at + 1]]

    def follows(self, left: int, right: int) -> bool:
        """Whether the weight between two following arcs is finite."""
        key = left << 20 | right
        finite = self._weight.get(key)
        if finite is None:
            a, b = self.names[left], self.names[right]
            finite = self.merged(a + b) == [a, b]
            if len(self._weight) >= 2_000_000:
                self._weight.clear()
            self._weight[key] = finite
        return finite

    def shortest_path(self, segment: str) -> list[int]:
        """Ids of the finite path through the lattice of ``segment``."""
        n, piece_of, finite = len(segment), self.pieces_ids.get, self._weight.get
        last, begin = [-1] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            if piece_of(segment[end - 1]) is None:
                begin[end] = end - 1  # byte fallback: a state that any arc may follow
                continue
            for start in (begin[end - 1], *range(end - 1, max(end - self.longest, 0) - 1, -1)):
                piece = piece_of(segment[start:end])
                if piece is not None and (last[start] < 0 or finite(last[start] << 20 | piece)
                                          or self.follows(last[start], piece)):
                    last[end], begin[end] = piece, start
                    break
        out: list[int] = []
        end = n
        while end:
            if last[end] < 0:
                out.extend(self.bytes[b] for b in reversed(segment[end - 1].encode()))
            else:
                out.append(last[end])
            end = begin[end]
        return out[::-1]

    def piece(self, piece: str):
        if META in piece:
            return False
        return np.array(self.shortest_path(META + piece), self.kind).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as the library gives them."""
        if not text:
            return np.zeros(0, self.kind)
        found = self.values(text.split(" "))
        if False in found:
            normal = META + text.replace(" ", META)
            found = [np.array(self.shortest_path(s), self.kind).tobytes() for s in _SEGMENT.findall(normal)]
        return np.frombuffer(b"".join(found), self.kind)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ``ids``: pieces spelled out, bytes joined, the leading space dropped."""
        spelled = b"".join(map(self.spell.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return spelled.removeprefix(" ")


class UnigramTransducer(PieceTransducer):
    """Pieces weighed one by one: the path of the largest sum of scores."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.weights = {n: np.float32(v) for n, v in self.score.items()}
        self.unknown = np.float32(min(self.weights.values())) - np.float32(UNKNOWN_PENALTY)
        if len(self.bytes) < 256:
            raise ValueError("unigram models without byte pieces are not supported")
        if self.unknown < -1e6:  # sums of singles would lose the other scores
            raise ValueError("unigram scores below a million are not supported")

    def check(self, model: bytes) -> None:
        if model_kind(model) != UNIGRAM:
            raise ValueError("only unigram models are supported here")
        kinds = {next((v for n, v in _fields(piece) if n == _TYPE), _NORMAL) for n, piece in _fields(model) if n == 1}
        if _USER in kinds:
            raise ValueError("unigram models with user-defined pieces are not supported")

    def shortest_path(self, segment: str) -> list[int]:
        """Ids of the shortest path: every arc relaxes its end, equal sums keep the first."""
        n, weight_of, longest = len(segment), self.weights.get, self.longest
        best: list = [None] * (n + 1)
        begin, best[0] = [0] * (n + 1), np.float32(0)
        for start in range(n):
            so_far = best[start]
            for end in range(start + 1, min(n, start + longest) + 1):
                weight = weight_of(segment[start:end])
                if weight is None:
                    if end > start + 1:
                        continue
                    weight = self.unknown  # byte fallback
                if best[end] is None or so_far + weight > best[end]:
                    best[end], begin[end] = so_far + weight, start
        out: list[int] = []
        end = n
        while end:
            piece = self.pieces_ids.get(segment[begin[end]:end])
            out.extend([piece] if piece is not None else [self.bytes[b] for b in reversed(segment[end - 1].encode())])
            end = begin[end]
        return out[::-1]


@functools.lru_cache(maxsize=2)
def transducer(path: str) -> PieceTransducer:
    """One per worker process, by the model's kind."""
    with open(path, "rb") as file:
        kind = model_kind(file.read())
    return UnigramTransducer(path) if kind == UNIGRAM else PieceTransducer(path)


def encode_documents(df: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding the ids gives the text back."""
    prepare(df.sparkSession)
    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fst = transducer(model)
        for part in parts:
            texts = [t or "" for t in part["text"]]
            ids = [fst.encode(t) for t in texts]
            same = [fst.decode(i) == t.replace(META, " ") for i, t in zip(ids, texts)]
            yield pd.DataFrame({"doc_id": part["doc_id"], "n_tokens": np.array(list(map(len, ids)), np.int64),
                                "ids": pd.Series([i.astype(np.int32) for i in ids], dtype=object, index=part.index),
                                "round_trip": np.array(same, bool)})

    return (df.select(df[doc_id].cast("long").alias("doc_id"), df[text].alias("text"))
            .mapInPandas(encode, "doc_id long, n_tokens long, ids array<int>, round_trip boolean"))


def decode_documents(df: DataFrame, model: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the decoded text of an array of ids."""
    @F.pandas_udf("string")
    def decode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fst = transducer(model)
        for part in parts:
            yield pd.Series([None if i is None else fst.decode(np.asarray(i, int)) for i in part], dtype=object)

    return df.withColumn(into, decode(df[ids]))
