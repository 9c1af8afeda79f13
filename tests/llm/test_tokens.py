"""Prefix counts, packing and the transducer against the libraries."""

import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from revlens.llm import packing
from revlens.llm.bpe import ByteBpe, cached_ids, prefix_counts
from revlens.llm.sentencepiece_fst import (
    MERGES, UNIGRAM, PieceTransducer, UnigramTransducer, _fields, decode_documents, encode_documents, model_kind, transducer,
)
from revlens.llm.token_counts import longest_within, token_counts, with_prefix_counts

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "\t", "\r\n", "'s", "'re", "'ll", "'r", "a", "the", "Thé", "é", "日本", "\U0001f642", "!", "'",
         "123", "<|endoftext|>", "<|endo", " ", "　", "\x85", "re", "ve", "aaaa", "ing", "½", "▁", "<s>", "\x00", "ﬁ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE)


def texts(n, most=14, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, most))) for _ in range(n)]


def test_every_prefix_equals_the_library(library):
    count = prefix_counts(BYTE)
    for t in texts(250):
        want = [len(library.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert count(t).tolist() == want, repr(t)


def test_cached_ids_equal_the_library(library):
    ids = cached_ids(BYTE)
    for t in texts(600):
        assert ids(t).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_prefix_dp_is_the_full_encoding_of_words(library):
    bpe = ByteBpe(BYTE)
    rnd = random.Random(5)
    for _ in range(200):
        w = "".join(rnd.choice("thearingouslyed") for _ in range(rnd.randint(1, 25)))
        assert bpe.prefix_dp(w.encode())[-1] == len(library.encode(w, add_special_tokens=False).ids)


def test_token_counts_query(spark, docs, library, queries):
    got = {r.doc_id: r for r in queries["op9_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        n = len(library.encode(r.text, add_special_tokens=False).ids)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (n, n > 1024)
        assert got[r.doc_id].n_bytes == len(r.text.encode())
        cut = r.text[:got[r.doc_id].cut_chars]
        assert len(library.encode(cut, add_special_tokens=False).ids) <= 1024


def test_stored_counts_and_edges(edges, nothing, library):
    for r in with_prefix_counts(edges, BYTE).select("text", "prefix_counts").collect():
        counts = np.frombuffer(r.prefix_counts, "<u4")
        assert len(counts) == len(r.text or "") + 1
        assert counts[-1] == len(library.encode(r.text or "", add_special_tokens=False).ids)
    assert token_counts(edges, BYTE, 10).count() == edges.count()
    assert token_counts(nothing, BYTE, 10).collect() == []
    assert longest_within(np.array([0, 1, 2, 1, 3]), 1) == 3


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        assert 0 < r.length <= capacity
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_query(spark, docs, library, queries):
    rows = queries["op6_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    total = 0
    for d in docs.select("doc_id", "text").collect():
        ids = np.array(library.encode(d.text, add_special_tokens=False).ids + [2], "<u4")
        own = sorted(by_doc.pop(d.doc_id), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids) and len(own) == -(-len(ids) // 1024)
        assert all(r.length == 1024 for r in own[1:])
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        total += len(ids)
    assert not by_doc
    assert check_packing(rows, 1024) <= 1.05 * (total / 1024) + 1


def test_best_fit_against_a_plain_search():
    rnd = random.Random(1)
    for bins in (1, 3, 8):
        own, open_bins, made = packing.OpenBins(100, bins), {}, 0
        for _ in range(400):
            size = rnd.randint(1, 100)
            fits = [f for f in open_bins.values() if f >= size]
            if fits:
                space = min(fits)
            else:
                if len(open_bins) == bins:
                    fullest = min(open_bins, key=lambda s: (open_bins[s], -s))
                    closed = [s for s in open_bins if open_bins[s] == open_bins[fullest]]
                    del open_bins[closed[-1]]
                space = 100
            sequence, offset = own.place(size)
            assert offset == 100 - space
            if not fits:
                assert sequence == made
                made += 1
            open_bins.pop(sequence, None)
            if space > size:
                open_bins[sequence] = space - size
            assert len(open_bins) <= bins


def test_packing_edges(edges, nothing):
    rows = packing.best_fit_packing(edges, BYTE, capacity=64).collect()
    assert len({(r.doc_id, r.ids_crc32) for r in rows if r.piece == 0}) >= 8
    check_packing(rows, 64)
    assert packing.best_fit_packing(nothing, BYTE).collect() == []
    assert packing.cut_points(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]


def test_transducer_equals_the_library():
    fst, model = transducer(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    for t in texts(800, 16, 9):
        want = model.encode(t)
        assert fst.encode(t).tolist() == want, repr(t)
        assert fst.decode(np.array(want, int)) == model.decode(want), repr(t)


def number(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(fields):
    """The other direction of _fields."""
    return b"".join(number(n << 3) + number(v) if isinstance(v, int) else
                    number(n << 3 | (5 if n == 2 and len(v) == 4 else 2)) + (b"" if n == 2 and len(v) == 4 else number(len(v))) + v
                    for n, v in fields)


def unigram_model(path, change=lambda piece, score: score, kind=UNIGRAM):
    """The given pieces as a model of another kind, with other scores."""
    with open(PIECE, "rb") as file:
        whole = list(_fields(file.read()))
    out = []
    for n, v in whole:
        if n == 1:
            piece = dict(_fields(v))
            if piece.get(3, 1) == 1:
                piece[2] = struct.pack("<f", change(piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0]))
            v = message(piece.items())
        elif n == 2:
            v += number(3 << 3) + number(kind)  # the last value counts
        out.append((n, v))
    with open(path, "wb") as file:
        file.write(message(out))
    return str(path)


@pytest.mark.parametrize("change", [
    lambda piece, score: max(score, -40_000.0) / 1000, lambda piece, score: -1.0,
    lambda piece, score: -(zlib.crc32(piece.encode()) % 4096) / 256, lambda piece, score: -float(len(piece) ** 2)],
    ids=["ranks", "equal", "hashed", "short"])
def test_unigram_paths_equal_the_library(tmp_path, change):
    path = unigram_model(tmp_path / "own.model", change)
    fst, model = UnigramTransducer(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for t in texts(300, 16, 11):
        want = model.encode(t)
        assert fst.encode(t).tolist() == want, repr(t)
        assert fst.decode(np.array(want, int)) == model.decode(want), repr(t)


def test_models_of_other_kinds_are_refused(tmp_path):
    with open(PIECE, "rb") as file:
        assert model_kind(file.read()) == MERGES
    path = unigram_model(tmp_path / "own.model")
    even = unigram_model(tmp_path / "even.model", lambda piece, score: -1.0)
    assert isinstance(transducer(even), UnigramTransducer) and type(transducer(PIECE)) is PieceTransducer
    for wrong in (lambda: PieceTransducer(even), lambda: UnigramTransducer(path), lambda: UnigramTransducer(PIECE),
                  lambda: transducer(unigram_model(tmp_path / "words.model", kind=3))):
        with pytest.raises(ValueError):
            wrong()


def test_sentencepiece_query_round_trip(spark, docs, queries, edges, nothing):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = {r.doc_id: r for r in queries["op8_sentencepiece_fst"](spark, "/root/testdata/sf0.001").collect()}
    for r in docs.select("doc_id", "text").collect():
        assert got[r.doc_id].ids == model.encode(r.text) and got[r.doc_id].round_trip
    small = encode_documents(edges, PIECE)
    assert small.where("not round_trip").isEmpty()
    back = decode_documents(small, PIECE).select("doc_id", "decoded")
    assert sorted((r.decoded for r in back.collect()), key=str) == sorted(
        ((r.text or "") for r in edges.select("text").collect()), key=str)
    assert encode_documents(nothing, PIECE).collect() == []
